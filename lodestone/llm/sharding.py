"""Sharding (operator 6): a Feistel permutation with cycle walking over global row numbers, in DataFrame functions.

Rows get a global number 0..n-1: first by a hash bucket of doc_id, then by doc_id within the bucket. Bucket sizes are
summed once and the running sums joined back, so no task ever orders more than one bucket. The permutation is an
alternating-modulus Feistel network on Z_a x Z_b with a * b just above n; a number that lands at n or beyond walks
on until it is below n. With place = permutation(number): shard = place mod shards, slot = place div shards. The law
is `rows`: shard sizes differ by one row at most, and shard and slot follow from the number, n and the seed alone.

Defined cases: a null text has size 1 and the checksum of no bytes; a null doc_id is numbered as its own bucket's
first; repeated rows get numbers of their own, and rows alike in doc_id, size and checksum are interchangeable; an
empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import read, running_sum, written

ROUNDS = 6
SHARDS = 16
SEED = 20_240_611
ROWS_PER_BUCKET = 1000
#: Steps of a walk; beyond them the query fails rather than give a wrong place. One step leaves a share of about 1 / sqrt(n).
MAX_WALK = 64


def feistel(x: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """One pass of the permutation of 0..a*b-1, where a * b >= n is as near to n as two factors near its root allow."""
    a, b = factors(n)
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b)).cast("long")
    pair = F.struct(left.alias("l"), right.alias("r"))
    step = lambda s, i: F.struct(
        F.when(i % 2 == 0, F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), F.lit(a)), F.lit(a))).otherwise(s["l"]).alias("l"),
        F.when(i % 2 == 0, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], i, F.lit(seed)), F.lit(b)), F.lit(b))).alias("r"),
    )
    done = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), pair, step)
    return F.aggregate(F.array(done), F.lit(0).cast("long"), lambda _, s: s["l"] * F.lit(b).cast("long") + s["r"])


def factors(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """The place of a row number: cycle walking. A walk visits each of the a * b - n < a outside places once at most."""
    a, b = factors(n)
    walk = min(a * b - n, MAX_WALK)
    first = feistel(number, n, seed)
    if not walk:
        return first
    place = F.aggregate(F.sequence(F.lit(1), F.lit(walk)), first, lambda x, _: F.when(x < n, x).otherwise(feistel(x, n, seed)))
    return F.when(place < n, place).otherwise(F.raise_error(F.lit(f"a row number was still beyond {n} after {walk} steps")).cast("long"))


def numbered(rows: DataFrame, key: Column, order: list[Column], out: str, name: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """rows with the global number `out`, and their count. `rows` is written once; only narrow tables should come here."""
    kept = written(rows.withColumn("_h", F.xxhash64(key)), name)
    n = kept.count()
    buckets = max(1, 1 << max(0, (-(-n // rows_per_bucket) - 1).bit_length()))
    kept = kept.withColumn("_b", F.pmod("_h", F.lit(buckets)))
    return running_sum(kept, [], "_b", ["_h", *order], F.lit(1), out).drop("_h", "_b"), n


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, number, law, shard, slot, grown_shard of every row."""
    text = F.col(text_col).cast("string").cast("binary")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
    )
    rows, n = numbered(narrow, F.col("doc_id"), [F.col("doc_id"), F.col("size"), F.col("text_crc32")], "number", "rows")
    place = rows.withColumn("_place", permuted(F.col("number"), n, seed)).withColumn("law", F.lit("rows"))
    return place.select(
        "doc_id", "size", "text_crc32", "law",
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "number",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
