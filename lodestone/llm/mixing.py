"""Mixing sources to target weights (operator 9): temperature mixing, in DataFrame functions.

A source's weight is its token share to the power alpha, normalised: alpha 1 keeps the natural shares, alpha 0 makes
them equal. alpha is bisected (in 32 sections at a time, one small aggregation each, so any number of sources will do)
to the largest value with the wanted entropy or the smallest with no source repeated more than `repetition` times.
The budget is the smallest that uses every source whole: the relatively most plentiful source passes once, another
one weight / share (relative to it) times, so no document is dropped. A source's documents stand in a keyed
permutation; the last, partial repeat takes documents from its beginning while their tokens fit its budget. Each copy
has a place in 0..1 of its source's run; equal slices of all runs make a block, and copies are permuted within blocks,
so every block has the wanted weights. Tokens are words: runs of characters that are not ASCII white space, one at least.

Defined cases: a null or empty text counts one token; a null source is the source "" ; repeated rows are documents of
their own, with a null doc_id or the same one too; ties in the permutation are broken by doc_id and by a hash of the row; an
empty table gives an empty result. Other columns pass through `mix`, which tells rows apart by a 128-bit hash of all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm._shared import read, running_sum, text_of, written

#: Passes over a source; up to four are worth nearly as much as new text (Muennighoff et al. 2023).
REPETITION = 4.0
BLOCK_TOKENS = 1_000_000
SEED = 17
SECTIONS = 32


def tokens(text_col: str = "text") -> Column:
    return F.greatest(F.lit(1), F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def measures(totals: DataFrame, low: float, high: float) -> list[tuple[float, float, float]]:
    """(alpha, entropy, most repeats) for SECTIONS + 1 values of alpha from low to high."""
    steps = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
    per = totals.withColumn("alpha", F.explode(F.array(*[F.lit(s) for s in steps])))
    power = F.exp(F.col("alpha") * F.log("share"))
    rows = per.groupBy("alpha").agg(F.sum(power).alias("z"), F.sum(power * F.col("alpha") * F.log("share")).alias("e"), F.max(F.exp((F.col("alpha") - 1) * F.log("share"))).alias("most"), F.min(F.exp((F.col("alpha") - 1) * F.log("share"))).alias("least"))
    rows = rows.select("alpha", (F.log("z") - F.col("e") / F.col("z")).alias("entropy"), (F.col("most") / F.col("least")).alias("repeats"))
    return sorted((r["alpha"], r["entropy"], r["repeats"]) for r in rows.collect())


def solve(totals: DataFrame, entropy: float | None = None, repetition: float | None = REPETITION, rounds: int = 5) -> float:
    """alpha in 0..1. entropy (nats): the largest alpha that reaches it (0 if none does); repetition: then the smallest alpha from there on within it."""
    alpha = 0.0
    if entropy is not None:
        low, high = 0.0, 1.0
        for _ in range(rounds):
            good = [a for a, e, _ in measures(totals, low, high) if e >= entropy - 1e-12]
            step, low = (high - low) / SECTIONS, max(good, default=low)
            high = min(high, low + step)
        alpha = low
    if repetition is not None:
        low, high = alpha, 1.0
        for _ in range(rounds):
            good = [a for a, _, r in measures(totals, low, high) if r <= repetition * (1 + 1e-12)]
            step, high = (high - low) / SECTIONS, min(good, default=high)
            low = max(low, high - step)
        alpha = high
    return alpha


def row_hash(docs: DataFrame, at: int) -> Column:
    """A 64-bit hash of all columns, nulls told from other values; `at` gives hashes of their own."""
    plain = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    return F.xxhash64(F.lit(at), *[c.isNull() for c in plain], *plain)


def _copies(docs: DataFrame, entropy: float | None, repetition: float | None, block_tokens: int, seed: int) -> DataFrame:
    """One row per copy: doc_id, source, n_tokens, epoch, weight, alpha, block, slot and the row's hashes _h1 and _h2."""
    narrow = docs.select(F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), tokens().alias("n_tokens"), row_hash(docs, 1).alias("_h1"), row_hash(docs, 2).alias("_h2"))
    narrow = written(narrow.withColumn("_key", F.xxhash64("doc_id", "source", F.lit(seed))), "mix")
    sums = narrow.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("rows"))
    sums = written(sums, "sources")
    whole = sums.agg(F.sum("total").alias("t"), F.sum("rows").alias("n")).first()
    if not whole["n"]:
        return narrow.select("doc_id", "source", "n_tokens", F.lit(0).alias("epoch"), F.lit(0.0).alias("weight"), F.lit(1.0).alias("alpha"), *[F.lit(0).cast("long").alias(c) for c in ("block", "slot")], "_h1", "_h2")
    totals = sums.withColumn("share", F.col("total") / F.lit(float(whole["t"])))
    alpha = solve(totals, entropy, repetition)
    power = F.exp(F.lit(alpha) * F.log("share"))
    scale = totals.agg(F.sum(power).alias("z"), F.min(power / F.col("share")).alias("least")).first()
    totals = totals.select("source", "total", (power / F.lit(scale["z"])).alias("weight"), (power / F.col("share") / F.lit(scale["least"])).alias("epochs"))
    budget = float(whole["t"]) * scale["z"] / scale["least"]
    blocks = max(1, round(budget / block_tokens))
    cuts = max(1, 1 << max(0, (whole["n"] // 1000).bit_length()))
    placed = narrow.withColumn("_b", F.pmod(F.shiftright("_key", 8), F.lit(cuts)))
    ordered = running_sum(placed, ["source"], "_b", ["_key", "doc_id", "n_tokens", "_h1", "_h2"], F.col("n_tokens"), "before")
    sized = ordered.join(totals, "source")
    full = F.floor(F.col("epochs") + 1e-9).cast("int")
    last = F.when(F.col("before") + F.col("n_tokens") <= (F.col("epochs") - full) * F.col("total"), 1).otherwise(0)
    copies = sized.withColumn("epoch", F.explode(F.sequence(F.lit(0), full + last - 1)))
    run = (F.col("epoch") * F.col("total") + F.col("before")) / (F.col("epochs") * F.col("total"))
    copies = copies.withColumn("block", F.least(F.lit(blocks - 1), F.floor(run * blocks)).cast("long"))
    slot = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("_key", "epoch", F.lit(seed)), "doc_id", "epoch", "_h1", "_h2"))
    return copies.select("doc_id", "source", "n_tokens", "epoch", "weight", F.lit(alpha).alias("alpha"), "block", (slot - 1).cast("long").alias("slot"), "_h1", "_h2")


def plan(docs: DataFrame, entropy: float | None = None, repetition: float | None = REPETITION, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per copy: doc_id, source, n_tokens, epoch, weight, alpha, block and slot (its place in the block). A block
    holds about block_tokens tokens, so its permutation is one task's work."""
    return _copies(docs, entropy, repetition, block_tokens, seed).drop("_h1", "_h2")


def mix(docs: DataFrame, entropy: float | None = None, repetition: float | None = REPETITION, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """The rows of docs, each as often as the mixture takes it, with all their columns and no others, in the order of block and slot."""
    copies = written(_copies(docs, entropy, repetition, block_tokens, seed).select("epoch", "block", "slot", "_h1", "_h2"), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_hash(docs, 1).alias("_h1"), row_hash(docs, 2).alias("_h2"))
    if not copies.filter("epoch = 0").groupBy("_h1", "_h2").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(["_h1", "_h2"])  # equal rows: any of them will do for all their copies
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.join(copies, ["_h1", "_h2"]).repartitionByRange(parts, "block", "slot").sortWithinPartitions("block", "slot")
    return ordered.select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plan(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "n_tokens", "epoch", F.round("weight", 6).alias("weight"), F.round("alpha", 6).alias("alpha"), "block", "slot")
