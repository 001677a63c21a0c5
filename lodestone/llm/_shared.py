"""What the operators of this subpackage have in common: a shared work folder, written intermediate tables, shipping."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as `ship` does for the other modules

#: What the contracts call white space, as a Java regular expression.
WHITE = r"[\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Pickle the module's functions by value, so executors need no copy of this repository."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def work_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where it is unset, a session whose
    executors are threads of the driver (tests) gets a local one; any other has no folder to share, so that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str, *, partition_by: str | None = None) -> DataFrame:
    """df, written to the shared folder and read again: cuts the lineage, survives lost executors. See `discard`."""
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    schema = df.schema
    if partition_by:
        fields = [f for f in schema.fields if f.name != partition_by] + [schema[partition_by]]
        schema = type(schema)(fields)
    return _tabled(spark.read.schema(schema).parquet(path), path)


def gathered(parts: Iterator[DataFrame], name: str) -> DataFrame:
    """The rows of all parts, written one part after the other, so only one part's plan (and its broadcasts) runs at a time."""
    path = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or f"{work_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        part.write.mode("append").parquet(path)
    return _tabled(spark.read.schema(schema).parquet(path), path)


def _tabled(df: DataFrame, path: str) -> DataFrame:
    df._written_at = path
    _paths.append(path)
    return df


#: Where this process has written tables that still stand.
_paths: list[str] = []


def mark() -> int:
    """A place in the list of written tables, for `discard_since`."""
    return len(_paths)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` gave, once nothing unfinished reads them."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path in _paths:
            _paths.remove(path)
            _delete(df.sparkSession, path)


def discard_since(spark: SparkSession, place: int, *keep: DataFrame) -> None:
    """Deletes all tables written since `mark` gave `place`, but those to keep: after the result that read them is written."""
    spared = {getattr(df, "_written_at", None) for df in keep}
    for path in [p for p in _paths[place:] if p not in spared]:
        _paths.remove(path)
        _delete(spark, path)


#: Keys with more rows than this, and than the HOT_KEYS-th part of all rows, are hot: there are fewer than HOT_KEYS of them.
HOT_ROWS = 200
HOT_KEYS = 20_000


def joined_with_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """rows joined with `groups`, which has one row per key and in `size` how many rows have the key; total: all rows.

    Rows of a hot key stay where they are: the hot groups, fewer than HOT_KEYS by the counts, are broadcast. The other
    rows are shuffled, at most the larger of HOT_ROWS and total / HOT_KEYS of them by one key. Both inputs should be written
    tables. Rows without a group, and null keys, are left out.
    """
    keys = [key] if isinstance(key, str) else key
    least = max(HOT_ROWS, total // HOT_KEYS)
    hot = groups.filter(F.col(size) > least)
    columns = [*rows.columns, *[c for c in groups.columns if c not in keys]]
    near = rows.join(F.broadcast(hot), keys).select(*columns)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return near.unionByName(rest.join(groups.filter(F.col(size) <= least), keys).select(*columns))


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts in `column` have at most `most` bytes together, or of one row: what a task holds at
    a time follows from bytes, however long the texts of a batch are."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = done = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(at, upto - at)
        at, done = upto, int(sizes[upto - 1])


def text_of(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quantile_buckets(df: DataFrame, key: str, out: str, rows: int, rows_per_bucket: int = 2000) -> DataFrame:
    """df with `out`, a long that never falls as the integer `key` rises; null keys come first, in bucket -1.

    256 quantiles of the key (a bounded sketch) bound the buckets; up to 256 quantiles of each cut it again until a bucket
    holds about `rows_per_bucket` (beyond 65,536 buckets they grow). Equal keys share a bucket, so buckets can be ordered alone.
    """
    from pyspark.ml.feature import Bucketizer

    quantiles = df.select(F.col(key).cast("double").alias(key)).approxQuantile(key, [i / 256 for i in range(257)], 1 / 1024)
    bounds = sorted(set(quantiles))
    if len(bounds) < 3:
        return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    parts = min(256, max(1, -(-rows // (rows_per_bucket * (len(bounds) - 1)))))
    column, place = f"__{out}_double", f"__{out}_at"
    cut = Bucketizer(splits=[float("-inf"), *bounds[1:-1], float("inf")], inputCol=column, outputCol=place, handleInvalid="keep")
    placed = cut.transform(df.withColumn(column, F.coalesce(F.col(key).cast("double"), F.lit(bounds[0])))).withColumn(place, F.col(place).cast("long"))
    bucket = F.col(place)
    if parts > 1:
        inner = placed.groupBy(place).agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 4096).alias("__cuts"))
        placed = placed.join(F.broadcast(written(inner, "cuts")), place)  # 256 rows of 255 numbers at most
        bucket = bucket * parts + F.size(F.filter("__cuts", lambda c: c < F.col(column)))
    return placed.withColumn(out, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(bucket).cast("long")).select(*df.columns, out)


def running_sum(rows: DataFrame, group: list[str], at: str, order: list, value: Column, out: str) -> DataFrame:
    """rows with `out`: the sum of `value` over the group's earlier rows, by the bucket `at` (a long), then by `order`.

    Only one bucket of rows is ever ordered in a task; the buckets' sums are summed in two levels. group and at must not be null.
    """
    from pyspark.sql import Window

    valued = rows.withColumn("_value", value)
    keys = [*group, at]
    sums = valued.groupBy(*keys).agg(F.sum("_value").alias("_sum")).withColumn("_top", F.floor(F.col(at) / 1024))
    tops = sums.groupBy(*group, "_top").agg(F.sum("_sum").alias("_topsum"))
    over = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    tops = tops.select(*group, "_top", (F.sum("_topsum").over(over.orderBy("_top")) - F.col("_topsum")).alias("_topbase"))
    inside = F.sum("_sum").over(Window.partitionBy(*group, "_top").orderBy(at)) - F.col("_sum")
    bases = sums.withColumn("_inside", inside).join(tops, [*group, "_top"]).select(*keys, (F.col("_topbase") + F.col("_inside")).alias("_base"))
    mine = F.sum("_value").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_value")
    return valued.withColumn("_mine", mine).join(bases, keys).withColumn(out, F.col("_base") + F.col("_mine")).drop("_value", "_mine", "_base")
