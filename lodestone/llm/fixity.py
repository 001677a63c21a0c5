"""WARC fixity (operator 2): records and ordered offset ranges are hashed into trees; replicas are compared from the roots down.

Records lie in archives by ascending id: an archive holds the ids of one span of SPAN numbers, and an id has the same
slot (its remainder) in every replica, so a record that one replica lost or gained moves no other. Each record has an
offset and a length in its replica's archive. A leaf is a hash of the SHA-256s and lengths of a slot's records; a node is
the SHA-256 of its FANOUT children's slots, sizes and hashes in order, and stands for one offset range. `audit` compares
the roots of two replicas and, level by level, only the children of nodes that differ, so an intact archive costs one
comparison; it counts the nodes it compared. Below a differing leaf, `differences` names the records.

Defined cases: null url or html count as empty; null ids form an archive of their own (archive null); repeated rows are
records of their own, equal ones one behind the other; records of one id lie in the order of their hashes. A record that only
the first replica has is `missing`, one that only the second has is `extra`; if both have such records under one id, the
first's are `corrupt` (and the second's are not listed). An empty table has no archives. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import discard, read, running_sum, ship, written

ship(__name__)

SPAN = 256
FANOUT = 16
#: Stands for null in the columns that trees are joined by.
NOWHERE = -(1 << 62)


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """One WARC response record as text."""
    size = F.octet_length(html)
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def records(pages: DataFrame, span: int = SPAN) -> DataFrame:
    """page_id, archive, at (the slot), sha256, length, copies (how many equal records lie here) and offset of the first of them."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    record = record_bytes(F.col("page_id"), clean("url"), clean("html"))
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("sha256"))
    counted = written(narrow.groupBy("page_id", "sha256", "length").agg(F.count(F.lit(1)).alias("copies")), "records")
    return laid_out(counted.withColumn("archive", F.floor(F.col("page_id") / span)).withColumn("at", F.coalesce(F.pmod("page_id", F.lit(span)), F.lit(0)).cast("long")))


def laid_out(counted: DataFrame, nowhere: int | str = NOWHERE) -> DataFrame:
    """Records with archive (null becomes `nowhere`), at, sha256, length and copies, with their offsets in order of at and sha256."""
    keyed = counted.withColumn("archive", F.coalesce("archive", F.lit(nowhere))).withColumn("_b", F.col("at") * 4096 + F.conv(F.substring("sha256", 1, 3), 16, 10).cast("long"))
    placed = running_sum(keyed, ["archive"], "_b", ["sha256", "length"], F.col("length") * F.col("copies"), "offset").drop("_b")
    return written(placed, "laid-out")


def leaves(rows: DataFrame) -> DataFrame:
    """Level 0 of the trees: one row per slot that has records, hashed by sums, so in no order and in parts."""
    piece = lambda i: F.sum((F.conv(F.substring("sha256", 1 + 13 * i, 13), 16, 10).cast("decimal(20,0)") * F.col("copies")).cast("decimal(38,0)")).cast("string")
    sized = (F.col("length") * F.col("copies")).cast("decimal(38,0)")
    told = F.concat_ws(":", F.sum("copies").cast("string"), F.sum(sized).cast("string"), *[piece(i) for i in range(5)])
    ends = F.col("offset") + F.col("length") * F.col("copies")
    return rows.groupBy("archive", F.col("at").alias("node")).agg(F.sha2(told, 256).alias("hash"), F.min("offset").alias("lo"), F.max(ends).alias("hi"))


def tree(rows: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """level (0 the leaves), archive, node, hash and the offset range lo..hi of all nodes, written once.

    An archive's leaves meet in one task (span of them at most); the levels above need no further exchange.
    """
    level = leaves(rows).repartition("archive")
    levels, width = [level], span
    while width > 1:
        children = F.array_sort(F.collect_list(F.struct("node", (F.col("hi") - F.col("lo")).alias("size"), "hash")))
        up = levels[-1].groupBy("archive", F.floor(F.col("node") / fanout).alias("parent")).agg(children.alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        told = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"].cast("string"), x["size"].cast("string"), x["hash"])), ",")
        levels.append(up.select("archive", F.col("parent").alias("node"), F.sha2(told, 256).alias("hash"), "lo", "hi"))
        width = -(-width // fanout)
    every = levels[0].withColumn("level", F.lit(0))
    for i, up in enumerate(levels[1:], 1):
        every = every.unionByName(up.withColumn("level", F.lit(i)))
    return written(every, "tree", partition_by="level")


@dataclass
class Audit:
    """found: archive, at, lo, hi and status (corrupt, missing, extra) of the slots that differ; visited: nodes compared at each level, roots first."""

    found: DataFrame
    visited: list[int] = field(default_factory=list)


def audit(first: DataFrame, second: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> Audit:
    """Where two replicas' trees differ."""
    top, width = 0, span
    while width > 1:
        top, width = top + 1, -(-width // fanout)
    wrong, visited = None, []
    for level in range(top, -1, -1):
        a, b = (t.filter(F.col("level") == level).drop("level") for t in (first, second))
        if wrong is not None:
            parent = F.floor(F.col("node") / fanout)
            a, b = (x.withColumn("parent", parent).join(wrong.select("archive", F.col("node").alias("parent")), ["archive", "parent"], "left_semi").drop("parent") for x in (a, b))
        theirs = b.select("archive", "node", F.col("hash").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        both = a.join(theirs, ["archive", "node"], "full_outer")
        status = F.when(F.col("hash").eqNullSafe(F.col("other")), "same").when(F.col("other").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("corrupt")
        compared = written(both.select("archive", "node", F.coalesce("lo", "lo2").alias("lo"), F.coalesce("hi", "hi2").alias("hi"), status.alias("status")), "compared")
        visited.append(compared.count())
        wrong = compared.filter("status <> 'same'")
    return Audit(wrong.select("archive", F.col("node").alias("at"), "lo", "hi", "status"), visited)


def differences(first: DataFrame, second: DataFrame, found: DataFrame, key: str = "page_id") -> DataFrame:
    """The records of the slots in `found` that differ: the key, archive, at, sha256, length, offset, copies (of them) and status.

    A record that both have, but one more often, differs by the surplus.
    """
    slots = found.select("archive", "at")
    columns = ["archive", "at", key, "sha256", "length"]
    mine, theirs = (x.join(slots, ["archive", "at"], "left_semi") for x in (first, second))
    theirs = theirs.select(*columns, F.col("copies").alias("_c2"), F.col("offset").alias("_o2"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]
    both = mine.alias("a").join(theirs.alias("b"), same[0] & same[1] & same[2] & same[3] & same[4], "full_outer")
    more = F.coalesce("copies", F.lit(0)) - F.coalesce("_c2", F.lit(0))
    rows = both.select(*[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in columns], F.coalesce("offset", "_o2").alias("offset"), more.alias("_more")).filter("_more <> 0")
    sides = rows.groupBy("archive", "at", key).agg(F.max("_more").alias("_most"), F.min("_more").alias("_least"))
    sides = sides.select(F.col("archive").alias("_a"), F.col("at").alias("_t"), F.col(key).alias("_k"), "_most", "_least")
    told = rows.join(sides, F.col("archive").eqNullSafe(F.col("_a")) & (F.col("at") == F.col("_t")) & F.col(key).eqNullSafe(F.col("_k")))
    status = F.when(F.col("_more") < 0, "extra").when(F.col("_least") < 0, "corrupt").otherwise("missing")
    return told.filter("_more > 0 OR _most < 0").select(*columns, "offset", F.abs("_more").alias("copies"), status.alias("status"))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            at, number, rows = 0, 0, []
            while data.startswith(b"WARC/", at):
                head = data.index(b"\r\n\r\n", at) + 4
                size = next(int(line.split(b":", 1)[1]) for line in data[at:head].split(b"\r\n") if line.lower().startswith(b"content-length:"))
                end = head + size + 4
                named = next((line.split(b":", 1)[1].strip() for line in data[at:head].split(b"\r\n") if line.lower().startswith(b"warc-record-id:")), None)
                rows.append((path, number, at, end - at, hashlib.sha256(data[at:end]).hexdigest(), None if named is None else named.decode("utf-8", "replace")))
                at, number = end, number + 1
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["archive", "at", "offset", "length", "sha256", "record_id"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """archive (the file's path), at, offset, length, sha256 and record_id (null if it has none) of the records of uncompressed WARC files, a file per task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parse, "archive string, at long, offset long, length long, sha256 string, record_id string")


def by_record_id(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """The records of `read_warc`, laid out for trees: a record's slot follows from its id, so replicas align by ids."""
    counted = rows.groupBy("archive", F.pmod(F.xxhash64("record_id"), F.lit(span)).alias("at"), "record_id", "sha256", "length").agg(F.count(F.lit(1)).alias("copies"))
    return laid_out(written(counted, "records"), "")


def damaged(pages: DataFrame, span: int = SPAN) -> DataFrame:
    """The replica that op2 is held against. In about half of the archives, by md5 of their numbers, one page in 16 each, by
    md5 of its id, has its first character replaced, is lost, or has a second record."""
    page_id = F.col("page_id").cast("long")
    hit = F.substring(F.md5(F.concat(F.lit("archive"), F.floor(page_id / span).cast("string"))), 1, 1) < "8"
    mark = F.when(hit, F.substring(F.md5(F.concat(F.lit("damage"), page_id.cast("string"))), 1, 1))
    marked = pages.select("page_id", "url", "html", F.coalesce(mark, F.lit("")).alias("_m"))
    changed = F.when((F.col("_m") == "0") & (F.col("html") != ""), F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    more = marked.filter("_m = '2'").select("page_id", "url", F.concat(F.lit("+"), F.coalesce("html", F.lit(""))).alias("html"))
    return marked.filter("_m <> '1'").select("page_id", "url", changed.alias("html")).unionByName(more)


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    mine, other = records(pages), records(damaged(pages))
    first, second = tree(mine), tree(other)
    wrong = written(differences(mine, other, audit(first, second).found), "wrong")
    discard(first, second, other)
    columns = ["page_id", "archive", F.col("at").alias("record"), F.col("offset").alias("byte_offset"), F.col("length").alias("n_bytes"), "sha256"]
    bad = wrong.filter("status <> 'extra'").select(F.col("archive").alias("_a"), F.col("at").alias("_t"), F.col("sha256").alias("_s"), F.col("copies").alias("_n"), F.col("status").alias("_status"))
    same = (F.col("archive") == F.col("_a")) & (F.col("at") == F.col("_t")) & (F.col("sha256") == F.col("_s"))
    each = mine.join(bad, same, "left").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    each = each.withColumn("offset", F.col("offset") + (F.col("_copy") - 1) * F.col("length"))
    rows = each.select(*columns, F.when(F.col("_copy") <= F.coalesce("_n", F.lit(0)), F.col("_status")).otherwise("intact").alias("status"))
    more = wrong.filter("status = 'extra'").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    more = more.withColumn("offset", F.col("offset") + (F.col("_copy") - 1) * F.col("length")).select(*columns, "status")
    return rows.unionByName(more).withColumn("archive", F.nullif("archive", F.lit(NOWHERE)))


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    CASE WHEN substr(md5('archive' || (page_id // 256)::VARCHAR), 1, 1) < '8' THEN substr(md5('damage' || page_id::VARCHAR), 1, 1) ELSE '' END AS m FROM pages
), b AS (
  SELECT page_id, url, html, m, 1 AS side FROM p
  UNION ALL SELECT page_id, url, CASE WHEN m = '0' AND html <> '' THEN '?' || substr(html, 2) ELSE html END, m, 2 FROM p WHERE m <> '1'
  UNION ALL SELECT page_id, url, '+' || html, m, 2 FROM p WHERE m = '2'
), r AS (
  SELECT *, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>',
    chr(13), chr(10), 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)) AS record FROM b
), o AS (
  SELECT page_id, side, m, page_id // 256 AS archive, page_id % 256 AS record_no, strlen(record) AS length, sha256(record) AS sha256 FROM r
), s AS (
  SELECT *, CAST(sum(length) OVER (PARTITION BY side, archive ORDER BY record_no, sha256) - length AS BIGINT) AS byte_offset FROM o
)
SELECT page_id, archive, record_no AS record, byte_offset, CAST(length AS BIGINT) AS n_bytes, sha256,
  CASE WHEN side = 2 THEN 'extra' WHEN m = '1' THEN 'missing' WHEN EXISTS (SELECT 1 FROM s t WHERE t.side = 2 AND t.page_id = s.page_id AND t.sha256 = s.sha256) THEN 'intact' ELSE 'corrupt' END AS status
FROM s WHERE side = 1 OR (side = 2 AND m = '2' AND NOT EXISTS (SELECT 1 FROM s t WHERE t.side = 1 AND t.page_id = s.page_id AND t.sha256 = s.sha256))
"""
