"""Tables, caches, key-value stores, files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import number
from lodestone.operators.spatial import wkt_line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parameterised(spark: SparkSession, sql: str, **args: object) -> DataFrame:
    """SQL with named parameters, bound and never spliced."""
    return spark.sql(sql, args=args)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The cached table; built and written if it is absent or empty of files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _files(spark: SparkSession, path: str):
    java = spark._jvm.org.apache.hadoop.fs
    return java.FileContext.getFileContext(java.Path(path).toUri(), spark._jsc.hadoopConfiguration()), java


def replace_table(df: DataFrame, path: str) -> None:
    """The new rows are written as a version of their own beside the old ones; then the file CURRENT, which names the
    version that counts, is replaced by one atomic rename. A reader (`read_table`) sees the old rows or the new ones, never a mixture."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    files, java = _files(spark, path)
    rename = getattr(java, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    flags = spark._jvm.java.util.EnumSet.of(java.CreateFlag.CREATE)
    fresh = java.Path(f"{path}/CURRENT.{version}")
    out = files.create(fresh, flags, spark._sc._gateway.new_array(getattr(java, "Options$CreateOpts"), 0))
    out.write(bytearray(version.encode()))
    out.close()
    files.rename(fresh, java.Path(f"{path}/CURRENT"), options)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows that `replace_table` put in place last. Old versions stay for readers that have begun; see `expire_versions`."""
    return spark.read.parquet(f"{path}/{spark.read.text(f'{path}/CURRENT').first()[0]}")


def expire_versions(spark: SparkSession, path: str) -> int:
    """Deletes the versions of a table that no longer count; how many."""
    now = spark.read.text(f"{path}/CURRENT").first()[0]
    files, java = _files(spark, path)
    found = [f.getPath() for f in files.util().listStatus(java.Path(path)) if f.isDirectory() and f.getPath().getName() != now]
    for old in found:
        files.delete(old, True)
    return len(found)


def table_exists(spark: SparkSession, path: str) -> bool:
    """whether a table stands at the path."""
    files, java = _files(spark, path)
    return files.util().exists(java.Path(path))


def settings(spark: SparkSession, path: str) -> DataFrame:
    """Key and value of 'key = value' lines, and the value as a number (0 if it begins with none); comments go."""
    lines = spark.read.text(path).filter("NOT value RLIKE '^\\\\s*(#|$)' AND value LIKE '%=%'")
    value = F.trim(F.expr("substring(value, instr(value, '=') + 1)"))
    return lines.select(F.trim(F.substring_index("value", "=", 1)).alias("key"), value.alias("value"), number(value).alias("number"))


def append_log(df: DataFrame, path: str) -> None:
    """CSV rows with the time of writing, appended."""
    df.withColumn("written", F.current_timestamp()).write.mode("append").csv(path, header=True)


def export_paths(points: DataFrame, path_key: str, order: str, out: str) -> None:
    """One CSV row per path, its points as WKT."""
    lines = points.groupBy(path_key).agg(F.array_sort(F.collect_list(F.struct(order, "x", "y"))).alias("p")).select(path_key, wkt_line(F.col("p")).alias("wkt"))
    lines.write.mode("overwrite").csv(out, header=True)


def load_values(rows: DataFrame, entity: str, key: str, value: str, keys: list[str]) -> DataFrame:
    """Key-value rows, one column per key."""
    return rows.groupBy(entity).pivot(key, keys).agg(F.max(value))


def save_values(wide: DataFrame, entity: str, keys: list[str]) -> DataFrame:
    """One row per entity and key that has a value."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    return wide.select(entity, F.explode(pairs).alias("p")).select(entity, "p.key", "p.value").filter("value IS NOT NULL")


def commands(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-framed commands from a socket, for development."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def save_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Rows take the place of what the table has of their values of `by`; other partitions stay as they are."""
    rows.write.mode("overwrite").partitionBy(by).option("partitionOverwriteMode", "dynamic").parquet(path)
