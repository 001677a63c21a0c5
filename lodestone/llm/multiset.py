"""Document fingerprints (operator 8): a homomorphic multiset hash of paragraphs, in DataFrame functions.

A text is the multiset of its paragraphs: lines, cut after sentence ends too, so that a long line is many. Three
64-bit hashes of a paragraph give 180 bits; the bits are laid out in 60 words of three 20-bit fields, and words are
added modulo 2^60. With the number of paragraphs this is the fingerprint: sums do not depend on order, equal multisets
have equal fingerprints, and a paragraph is inserted or deleted by adding or subtracting its own words (`plus`,
`minus`). Read as signs (2 * field - count), the 180 lanes estimate inner products of multisets, so `likeness` is an
estimate of their Tanimoto similarity with a standard error near 1 / sqrt(180); equal fingerprints give exactly 1.

The next document is found within buckets of neighbouring doc_ids (one shuffle of the texts); a bucket's last row gets
the next bucket's first row by a join.

Defined cases: null and empty texts have no paragraphs: the zero fingerprint, likeness 1 to each other and 0 to any
other; rows that repeat a doc_id are ordered by a hash of the text; a null doc_id comes first; a single document is
its own next; an empty table gives an empty result. From 2^20 paragraphs in one text on, fields carry into each other:
equality stays right, likeness does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm._shared import quantile_buckets, read, text_of, written

FIELD = 20
HASHES = 3
MASK = (1 << 60) - 1
ONES = 1 | 1 << FIELD | 1 << 2 * FIELD
WORDS = HASHES * FIELD
ROWS_PER_BUCKET = 500
BROADCAST_ROWS = 200_000
PARAGRAPH = r"\n+|(?<=[.!?])[ \t]+"


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, PARAGRAPH), lambda p: p != "")


def fingerprint(text: Column) -> Column:
    """array<long>: the number of paragraphs, then the words."""
    hashed = F.transform(paragraphs(text), lambda p: F.array(*[F.xxhash64(p, F.lit(i)) for i in range(HASHES)]))
    words = lambda h: F.array(F.lit(1).cast("long"), *[F.shiftright(h[i], j).bitwiseAND(F.lit(ONES)) for i in range(HASHES) for j in range(FIELD)])
    zero = F.array_repeat(F.lit(0).cast("long"), WORDS + 1)
    return F.aggregate(hashed, zero, lambda total, h: F.zip_with(total, words(h), lambda a, b: (a + b).bitwiseAND(F.lit(MASK))))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def as_text(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 15, "0")), "")


def inner(a: Column, b: Column) -> Column:
    """180 times the estimated inner product of the two multisets."""
    n, m = a[0].cast("double"), b[0].cast("double")
    field = lambda w, k: F.shiftright(w, k * FIELD).bitwiseAND(F.lit((1 << FIELD) - 1)).cast("double") * 2
    pairs = F.arrays_zip(F.slice(a, 2, WORDS).alias("x"), F.slice(b, 2, WORDS).alias("y"))
    return F.aggregate(pairs, F.lit(0.0), lambda t, w: t + sum(((field(w["x"], k) - n) * (field(w["y"], k) - m) for k in range(1, 3)), (field(w["x"], 0) - n) * (field(w["y"], 0) - m)))


def likeness(a: Column, b: Column, aa: Column, bb: Column) -> Column:
    """0 to 1; aa and bb are inner(a, a) and inner(b, b)."""
    ab = inner(a, b)
    value = ab / (aa + bb - ab)
    none = (a[0] == 0) | (b[0] == 0)
    return F.when(a == b, 1.0).when(none, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def _next_buckets(sizes: DataFrame) -> DataFrame:
    """(_b, _after): each bucket that has rows and the next one; the last one's is the first."""
    wide = sizes.withColumn("_top", F.floor(F.col("_b") / 1024))
    tops = wide.groupBy("_top").agg(F.min("_b").alias("_low"))
    tops = tops.select("_top", F.lead("_low").over(Window.orderBy("_top")).alias("_next"), F.min("_low").over(Window.partitionBy(F.lit(0))).alias("_wrap"))
    after = F.lead("_b").over(Window.partitionBy("_top").orderBy("_b"))
    return wide.withColumn("_follow", after).join(tops, "_top").select("_b", F.coalesce("_follow", "_next", "_wrap").alias("_after"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words (the fingerprint) and next_text, next_words of the following document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("_tie", F.xxhash64("text"))
    n = rows.count()
    placed = quantile_buckets(rows, "doc_id", "_b", n, ROWS_PER_BUCKET)
    firsts = placed.groupBy("_b").agg(F.min(F.struct("doc_id", "_tie")).alias("_f"))
    heads = written(firsts.select("_b", F.col("_f.doc_id").alias("_id"), F.col("_f._tie").alias("_t")), "heads")
    following = _next_buckets(heads.select("_b"))
    if heads.count() <= BROADCAST_ROWS:
        heads = F.broadcast(heads)
    same = placed["doc_id"].eqNullSafe(heads["_id"]) & (placed["_tie"] == heads["_t"])
    head_rows = placed.drop("_b").join(heads, same).groupBy("_b").agg(F.first("text").alias("_head"))
    head_rows = head_rows.join(following.select(F.col("_b").alias("_from"), F.col("_after").alias("_b")), "_b").select(F.col("_from").alias("_b"), F.struct(F.col("_head").alias("text"), fingerprint(F.col("_head")).alias("words")).alias("_head"))
    order = Window.partitionBy("_b").orderBy("doc_id", "_tie")
    led = placed.repartition("_b").withColumn("words", fingerprint(F.col("text"))).withColumn("_lead", F.lead(F.struct("text", "words")).over(order))
    out = led.join(head_rows, "_b", "left").withColumn("_next", F.coalesce("_lead", "_head"))
    return out.select("doc_id", "text", "words", F.col("_next.text").alias("next_text"), F.col("_next.words").alias("next_words"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(read(spark, sf_dir, "documents"))
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))).drop("text", "next_text")
    rows = rows.withColumn("edited_words", fingerprint(F.col("edited")))
    norms = rows.select("*", *[inner(F.col(c), F.col(c)).alias(a) for c, a in (("words", "aa"), ("edited_words", "ee"), ("next_words", "nn"))])
    return norms.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("words")).alias("fingerprint"), as_text(F.col("edited_words")).alias("edited_fingerprint"),
        likeness(F.col("words"), F.col("edited_words"), F.col("aa"), F.col("ee")).alias("near_edited"),
        likeness(F.col("words"), F.col("next_words"), F.col("aa"), F.col("nn")).alias("near_next"),
    )
