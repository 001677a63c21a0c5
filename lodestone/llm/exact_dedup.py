"""Exact deduplication (operator 5): two passes over a Bloom filter leave only possible repeats to shuffle.

Pass one reads a 64-bit hash of every normalised text and sets bits in two blocked Bloom filters: `once` (some
row set this bit) and `twice` (at least two rows did). A row all of whose bits are in `twice` may be a repeat; any
other row is certainly alone. Pass two probes `twice` with a broadcast join, and only possible repeats are shuffled,
by the SHA-256 of the normalised text, which decides; the verdict on a hot text is brought to its rows by a broadcast.

A filter has at most max_words words of 64 bits (as a broadcast table about 50 bytes a word: 108 MB at the default, as
measured). Beyond max_words * DOCS_PER_WORD rows the hash space is cut into slices with a filter each, worked on one
after the other: rows are written by slice first (not shuffled), and each slice is marked and gathered before the next
filter is built. Every slice costs some jobs and files, so give max_words as much as an executor can hold: 2^25 words
(1.7 GB) mean 134 million rows a slice. Results do not depend on the number of slices.

Defined cases: null text equals empty text; all empty texts are one group. Rows that repeat with one doc_id and one
text share a verdict, and `deduplicate` returns one of them; it keeps every unique text, whatever its doc_id. A null doc_id stays only if its whole group has none. An empty table
gives an empty result. Other columns of the input are never read by name and pass through `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import WHITE, discard, gathered, joined_with_groups, read, ship, text_of, work_folder, written

ship(__name__)

MAX_WORDS = 1 << 21
DOCS_PER_WORD = 4
PROBES = 4


def _bit_positions(hashes: np.ndarray, words: int) -> np.ndarray:
    """The distinct (row, bit) positions of each hash: all in one 64-bit word."""
    word = (hashes & np.uint64(words - 1)).astype(np.int64)
    planes = np.stack([((hashes >> np.uint64(40 + 6 * i)) & np.uint64(63)).astype(np.int64) for i in range(PROBES)])
    planes.sort(axis=0)
    fresh = np.ones_like(planes, dtype=bool)
    fresh[1:] = planes[1:] != planes[:-1]
    return (planes + word[None, :] * 64)[fresh]


def _local_filter(words: int, page_words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        seen = False
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if not len(hashes):
                continue
            seen = True
            positions, counts = np.unique(_bit_positions(hashes, words), return_counts=True)
            word, bit = positions >> 6, np.uint64(1) << (positions & 63).astype(np.uint64)
            before = (once[word] & bit) != 0
            again = before | (counts > 1)
            np.bitwise_or.at(twice, word[again], bit[again])
            np.bitwise_or.at(once, word, bit)
        if not seen:
            return
        used = np.flatnonzero(once)
        pages = used // page_words
        cuts = np.flatnonzero(np.diff(pages)) + 1
        groups = np.split(used, cuts)
        for lo in range(0, len(groups), 4096):
            some = groups[lo : lo + 4096]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(g[0] // page_words) for g in some], pa.int32()),
                    pa.array([(g % page_words).astype(np.int32).tobytes() for g in some], pa.binary()),
                    pa.array([once[g].tobytes() for g in some], pa.binary()),
                    pa.array([twice[g].tobytes() for g in some], pa.binary()),
                ],
                names=["page", "at", "once", "twice"],
            )

    return build


def _merge_pages(page_words: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for page, at, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if page not in pages:
                    pages[page] = np.zeros(page_words, np.uint64), np.zeros(page_words, np.uint64)
                ones, twos = pages[page]
                where, more = np.frombuffer(at, np.int32), np.frombuffer(once, np.uint64)
                twos[where] |= np.frombuffer(twice, np.uint64) | (ones[where] & more)
                ones[where] |= more
        for page, (_, twos) in pages.items():
            used = np.flatnonzero(twos)
            yield pa.RecordBatch.from_arrays([pa.array(used + page * page_words, pa.int64()), pa.array(twos[used].view(np.int64), pa.int64())], names=["word", "bits"])

    return merge


def repeat_filter(hashes: DataFrame, words: int, name: str = "repeats") -> DataFrame:
    """(word, bits) of the `twice` filter over the one column of `hashes`, words without bits left out."""
    page_words = max(64, words // 4096)
    local = hashes.mapInArrow(_local_filter(words, page_words), "page int, at binary, once binary, twice binary")
    merged = local.repartition("page").mapInArrow(_merge_pages(page_words), "word long, bits long")
    return written(merged, name)


def with_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 and a 64-bit hash of the normalised text."""
    text = F.regexp_replace(text_of(text_col), WHITE, " ")
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), F.xxhash64(text).alias("_hash"))


def _mark(rows: DataFrame, filter_: DataFrame, words: int) -> DataFrame:
    """rows with `_maybe`: all bits of the row's hash are in the filter. The filter has MAX_WORDS rows at most."""
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_hash, {40 + 6 * i}) & 63 as int))"))
    marked = rows.withColumn("_word", F.col("_hash").bitwiseAND(F.lit(words - 1))).withColumn("_mask", mask)
    found = marked.join(F.broadcast(filter_.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))), "_word", "left")
    return found.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))).drop("_word", "_mask", "_bits")


def _size(rows: int, max_words: int) -> tuple[int, int]:
    """Words of a filter and the number of slices."""
    need = max(1, -(-rows // DOCS_PER_WORD))
    words = min(max_words, 1 << max(10, (need - 1).bit_length()))
    return words, -(-need // words)


def _slice(slices: int) -> Column:
    return F.pmod(F.shiftrightunsigned("_hash", 24).bitwiseAND(F.lit(0xFFFF)), F.lit(slices)).cast("int")


def _marked_slices(rows: DataFrame, words: int, slices: int) -> Iterator[DataFrame]:
    """rows (with `_hash`) with `_maybe`, slice by slice; a slice's filter is deleted when the next slice is asked for."""
    for at in range(slices):
        mine = rows.filter(F.col("_slice") == at).drop("_slice") if slices > 1 else rows
        found = repeat_filter(mine.select("_hash"), words)
        yield _mark(mine, found, words)
        if slices > 1:
            discard(found)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    words, slices = _size(docs.count(), max_words)
    hashed = with_hashes(docs, id_col, text_col)
    hashed = written(hashed.withColumn("_slice", _slice(slices)), "slices", partition_by="_slice") if slices > 1 else written(hashed, "hashes")
    marked = gathered((part.drop("_hash") for part in _marked_slices(hashed, words, slices)), "marked")
    discard(hashed)
    alone = marked.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = marked.filter("_maybe").drop("_maybe")
    groups = written(maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    repeats = joined_with_groups(maybe, groups, "text_sha256", "group_size", total)
    repeats = repeats.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.unionByName(repeats)


def _stay(marked: DataFrame) -> DataFrame:
    """Of rows (`_row`, `_id`, `_sha`, `_maybe`) those that stay: lone ones as they come, of equal texts the one of the smallest id."""
    alone = marked.filter(~F.col("_maybe")).select("_row.*")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    repeats = marked.filter("_maybe").groupBy("_sha").agg(first.alias("_first")).select("_first.row.*")
    return alone.unionByName(repeats)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """The rows that stay, with all their columns.

    A row that is certainly alone is passed on in the task that read it; only possible repeats are shuffled, with the
    whole row (of each task's equal rows one). With several filters the rows are written by slice first, not shuffled.
    """
    columns = docs.columns
    words, slices = _size(docs.count(), max_words)
    text = F.regexp_replace(text_of(text_col), WHITE, " ")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_hash"), F.sha2(text, 256).alias("_sha"))
    if slices == 1:
        narrow = written(docs.select(F.xxhash64(text).alias("_hash")), "hashes")
        found = repeat_filter(narrow, words)
        discard(narrow)
        return _stay(_mark(rows, found, words))
    rows = written(rows.withColumn("_slice", _slice(slices)), "slices", partition_by="_slice")
    kept = gathered((_stay(part) for part in _marked_slices(rows, words, slices)), "kept")
    discard(rows)
    return kept


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_folder(spark)
    return verdicts(read(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
