"""Near-duplicate groups (operator 4): fast similarity sketches, banding, and verification on full shingle sets.

A document's set holds the 64-bit hashes of its distinct five-word shingles (A-Z lower-cased, words split at ASCII
white space; with one to four words, the whole sequence is the one shingle). The sketch has COORDINATES bins. Round
i hashes every shingle to a bin and a value and fills empty bins with the round's smallest value, until all bins are
full; from round COORDINATES on, round i fills bin i - COORDINATES by itself, so every bin is surely filled. Two
coordinates agree with probability J, concentrated as for independent MinHashes. BANDS bands of ROWS coordinates
give candidates: a pair at J = 0.75 escapes all bands with probability (1 - 0.75^5)^40 = 2e-5.

Texts with one word sequence (a 128-bit hash of it) are folded into a class first (they are linked without any check), so copies never
meet in buckets. Classes, not doc_ids, are linked, so a doc_id may stand on rows with different texts. In each bucket every class is held against the bucket's smallest one; links are confirmed on full
sets. Where a bucket still holds several components after that, pairs across its components are held against each
other too (in large buckets block by block), so no candidate link between different components is left unchecked.

Defined cases: null, empty or white-space texts have no shingles and are their own component; a null doc_id cannot be
named: its row is kept, linked with nothing, and component_id is null; repeated rows share a component and a verdict, so
`deduplicate` keeps all or none of them; rows of one doc_id with different texts are linked by their own texts, and each has
its own component; an empty table gives an empty result. Other columns are ignored. Two shingles count as equal when their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import discard, joined_with_groups, read, ship, slices, text_of, work_folder, written
from lodestone.llm.components import connected_components

ship(__name__)

WORDS = 5
PERCENT = 75
ROWS, BANDS = 5, 40
COORDINATES = ROWS * BANDS
CHUNK = 1 << 20
#: Members of a mixed bucket up to which pairs across its components are rows; larger ones go by blocks.
BUCKET = 32
#: About the most documents and shingles of a block; two blocks meet in a task.
BLOCK = 500
BLOCK_ITEMS = 250_000
SEED = 7_919

_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = max(n, CHUNK + 4096)
        up, down = np.full(size, _PRIME, _U), np.full(size, pow(_PRIME, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        _tables["up"], _tables["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _tables["byte"] = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
    return _tables["byte"], _tables["up"], _tables["down"]


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end at white space."""
    at = 0
    while len(text) - at > CHUNK:
        cut = next((i for i in range(at + CHUNK, len(text)) if text[i] in b" \t\n\r\x0b\x0c"), len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in lower-cased bytes that end in white space."""
    raw = np.frombuffer(data, np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(white, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    byte, up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum(byte[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407)), starts


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if group:
            data = b" ".join(group) + b" "
            hashes, starts = _words(data)
            edges = np.cumsum([0] + [len(g) + 1 for g in group])
            out.extend(np.split(hashes, np.searchsorted(starts, edges[1:-1])))
        group.clear()
        size = 0

    for text in texts:
        if len(text) > CHUNK:
            flush()
            out.append(np.concatenate([_words(piece + b" ")[0] for piece in _pieces(text)]))
            continue
        if size + len(text) > CHUNK:
            flush()
        group.append(text)
        size += len(text) + 1
    flush()
    return out


_FACTORS = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)]


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    if not len(words):
        return np.empty(0, _U)
    n = min(size, len(words))
    total = np.full(len(words) - n + 1, n, _U)
    for i in range(n):
        total = total * _FACTORS[0] + words[i : len(words) - n + 1 + i] * _FACTORS[1 + i % 4]
        total ^= total >> _U(29)
    return np.unique(mix(total))


def sketch(items: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The sketch of a non-empty set of hashes: coordinate = (round, value), packed."""
    out, empty, at = np.zeros(t, _U), np.ones(t, bool), 0
    n = len(items)
    many = max(1, -(-3 * t // n))
    while at < t and empty.any():
        rounds = np.arange(at, min(t, at + many), dtype=_U)
        x = mix(items[None, :] ^ mix(rounds * _U(0x9FB21C651E98DF25) + _U(SEED))[:, None])
        place = ((x >> _U(32)) * _U(t)) >> _U(32)
        key = np.sort(((place << _U(48)) | (rounds[:, None] << _U(32)) | (x & _U(0xFFFFFFFF))).ravel())
        place = (key >> _U(48)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        found = place[first]
        new = empty[found]
        out[found[new]] = key[first][new] & _U((1 << 48) - 1)
        empty[found] = False
        at += len(rounds)
        many = max(1, -(-t // n))
    for b in np.flatnonzero(empty):
        out[b] = (_U(t + b) << _U(32)) | (mix(items ^ mix(np.array([t + b], _U) * _U(0x9FB21C651E98DF25) + _U(SEED))) & _U(0xFFFFFFFF)).min()
    return out


def bands(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    table = coordinates.reshape(-1, rows)
    key = np.arange(1, len(table) + 1, dtype=_U) * _U(0xE7037ED1A0B428DB)
    for i in range(rows):
        key = mix(key * _FACTORS[0] + table[:, i])
    return key.view(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t.lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            k1, k2, sizes, keys = [], [], [], []
            for words in word_hashes(_texts(batch)):
                digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                k1.append(int.from_bytes(digest[:8], "little", signed=True))
                k2.append(int.from_bytes(digest[8:], "little", signed=True))
                items = shingles(words)
                sizes.append(len(items))
                keys.append(bands(sketch(items)) if len(items) else np.empty(0, np.int64))
            arrays = [batch.column("doc_id"), batch.column("tie"), *(pa.array(x, pa.int64()) for x in (k1, k2, sizes)), _lists(keys)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "tie", "k1", "k2", "n", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingles(w) for w in word_hashes(_texts(batch))])], names=["id", "items"])


def _alike(n: str, m: str) -> Column:
    """Sizes that a linked pair can have."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _confirmed(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Of pairs (a, n, b, m), those with 100 * intersection >= PERCENT * union over the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("_x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("_common", common)
    return written(both.filter(100 * F.col("_common") >= PERCENT * (F.col("n") + F.col("m") - F.col("_common"))).select("a", "b"), name)


def _block_pair(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, among the documents of two blocks: counts of common shingles by products of 0/1 matrices."""
    rows = rows.drop_duplicates("id")
    ids, n, component, block = (rows[c].to_numpy() for c in ("id", "n", "component", "block"))
    lengths = np.array([len(x) for x in rows["items"]])
    owner = np.repeat(np.arange(len(rows)), lengths)
    _, item = np.unique(np.concatenate(list(rows["items"])), return_inverse=True)
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    common = np.zeros((len(rows), len(rows)), np.float32)
    for low in range(0, int(item[-1]) + 1, 2048):
        lo, hi = np.searchsorted(item, [low, low + 2048])
        part = np.zeros((len(rows), 2048), np.float32)
        part[owner[lo:hi], item[lo:hi] - low] = 1
        common += part @ part.T
    least = 100 * common.astype(np.float64) + PERCENT * common  # 100 * common >= PERCENT * union
    linked = np.triu(least >= PERCENT * (n[:, None] + n[None, :]), 1) & (component[:, None] != component[None, :])
    if key[1] != key[2]:
        linked &= block[:, None] != block[None, :]
    i, j = np.nonzero(linked)
    _, part = np.unique(component, return_inverse=True)
    _, first = np.unique(np.minimum(part[i], part[j]) * len(rows) + np.maximum(part[i], part[j]), return_index=True)
    return pd.DataFrame({"a": ids[i[first]], "b": ids[j[first]]}, dtype="int64")


def _block_links(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components in large buckets. Buckets that share members become one group; a group is cut into blocks of
    about BLOCK documents or BLOCK_ITEMS shingles, and each pair of blocks is held against each other in a task of its own: a set
    is read as often as its group has blocks, m members cost m * m / BLOCK sets. Pairs of documents are never rows."""
    heads = written(large.groupBy("key").agg(F.min("id").alias("head")), "heads")
    groups = connected_components(large.select("key", "id").join(heads, "key").select("id", "head"), "id", "head")
    members = large.select("id", "n", F.col("component")).distinct().join(groups.select(F.col("node").alias("id"), F.col("component").alias("group")), "id")
    members = written(members, "members")
    blocks = members.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    placed = members.join(written(blocks, "groups"), "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", "n", "component", "group", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    full = dealt.join(sets, "id")
    return written(full.groupBy("group", "i", "j").applyInPandas(_block_pair, "a long, b long"), "across-blocks")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tie (a hash of the text), n_shingles, component_id and kept of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    signed = rows.select("doc_id", "text", "tie").mapInArrow(_signatures, "doc_id long, tie long, k1 long, k2 long, n long, bands array<long>")
    signed = written(signed, "signatures")
    linked = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "tie", "n", "bands")).alias("_c"), F.count(F.lit(1)).alias("size"))
    classes = classes.select("k1", "k2", F.monotonically_increasing_id().alias("id"), F.col("_c.doc_id").alias("lead"), F.col("_c.tie").alias("tie"), F.col("_c.n").alias("n"), F.col("_c.bands").alias("bands"), "size")
    classes = written(classes, "classes")
    buckets = classes.select("id", "n", F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.min(F.struct("id", "n")).alias("_h"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    heads = written(heads, "bucket-heads")
    members = written(buckets.join(heads.select("key", F.col("_h.id").alias("head"), F.col("_h.n").alias("m"), "c"), "key"), "buckets")
    discard(heads)
    pairs = members.filter((F.col("id") != F.col("head")) & _alike("n", "m"))
    pairs = written(pairs.select(F.col("id").alias("a"), "n", F.col("head").alias("b"), "m").distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(members.filter("c > 2").select("id")).distinct()
    leads = wanted.join(classes.select("id", F.col("lead").alias("doc_id"), "tie"), "id")
    texts = rows.join(leads, ["doc_id", "tie"]).select("id", "text")
    if _repeated(signed):
        texts = texts.dropDuplicates(["id"])
    sets = written(texts.mapInArrow(_sets, "id long, items array<long>"), "sets")
    links = _confirmed(pairs, sets, "links")
    component = connected_components(links, "a", "b")
    in_buckets = members.filter("c > 2").join(component.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", "c", F.coalesce("component", "id").alias("component"))
    mixed = in_buckets.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    open_ = written(in_buckets.join(mixed, "key", "left_semi"), "open")
    small = open_.filter(F.col("c") <= BUCKET)
    other = small.select("key", F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"))
    across = small.withColumnRenamed("id", "a").join(other, "key").filter((F.col("a") > F.col("b")) & (F.col("component") != F.col("other")) & _alike("n", "m"))
    across = written(across.select("a", "n", "b", "m").distinct().join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "across")
    more = None if across.isEmpty() else _confirmed(across, sets, "more")
    large = open_.filter(F.col("c") > BUCKET)
    if not large.isEmpty():
        found = _block_links(large, sets)
        more = found if more is None else more.unionByName(found)
    if more is not None:
        component = connected_components(links.unionByName(more), "a", "b")
    joint = written(component.withColumnRenamed("node", "id").join(classes.select("id", "lead"), "id"), "joint")
    lows = written(joint.groupBy("component").agg(F.min("lead").alias("low"), F.count(F.lit(1)).alias("of")), "lows")
    named = joined_with_groups(joint, lows, "component", "of", joint.count()).select("id", "low")
    named = written(classes.select("k1", "k2", "id", "lead", "size").join(named, "id", "left").select("k1", "k2", "size", F.coalesce("low", "lead").alias("_component")), "named")
    discard(members, pairs, sets, links, open_, across, joint, lows, classes)
    narrow = signed.select("doc_id", "tie", "k1", "k2", F.col("n").alias("n_shingles"))
    has = joined_with_groups(narrow.filter("n_shingles > 0 AND doc_id IS NOT NULL"), named, ["k1", "k2"], "size", narrow.count())
    none = narrow.filter("n_shingles = 0 OR doc_id IS NULL").withColumn("_component", F.col("doc_id"))
    out = has.select("doc_id", "tie", "n_shingles", "_component").unionByName(none.select("doc_id", "tie", "n_shingles", "_component"))
    return out.select("doc_id", "tie", "n_shingles", F.col("_component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("_component")).alias("kept"))


def _repeated(signed: DataFrame) -> bool:
    """Whether a doc_id stands on more than one row of the same text."""
    return not signed.groupBy("doc_id", "tie").count().filter("count > 1").isEmpty()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return _grouped(docs, id_col, text_col).drop("tie")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents that stay: one document of each group, with all columns."""
    dropped = _grouped(docs, id_col, text_col).filter(~F.col("kept")).select("doc_id", "tie").distinct()
    mine = (F.col(f"`{id_col}`").cast("long") == F.col("_drop.doc_id")) & (F.xxhash64(text_of(text_col)) == F.col("_drop.tie"))
    return docs.join(dropped.select(F.struct("doc_id", "tie").alias("_drop")), mine, "left_anti")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_folder(spark)
    return near_duplicates(read(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS items
  FROM w
), n AS (SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles FROM s),
x AS (SELECT doc_id, hash(unnest(items)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n_shingles + nb.n_shingles - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT both_ways.b, r.root FROM r JOIN both_ways ON both_ways.a = r.node)
SELECT n.doc_id, n.n_shingles, min(r.root) AS component_id, n.doc_id = min(r.root) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""
