"""Structured Streaming: event streams, windows, and replays to the end of what is there. Keyed state is in keyed.py."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import shared_folder


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The events as a stream with a zoned event time (watermarks reject zone-less timestamps)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a pattern, so that the table may be one file as well as a folder of files
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{sf_dir}/event[s].parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def replayed(stream: DataFrame, mode: str) -> DataFrame:
    """What the stream gives when all that is there has been read. In complete mode each batch replaces the last one's
    result; else it is added. Results and progress go to the folder that executors share, nothing to the driver."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{folder}/result")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/result")


def windowed(stream: DataFrame, width: str, late: str) -> DataFrame:
    """Counts and sums per tumbling window and type; rows later than `late` are dropped."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def last_values(stream: DataFrame, late: str) -> DataFrame:
    """K2: the newest row of each user and type, by event time and id."""
    return stream.withWatermark("ts", late).groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max("ts").alias("ts"))
