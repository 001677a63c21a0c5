"""The session the library is meant for, and lineage cuts that survive lost executors."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("lodestone").config(map={**CONF, **conf})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which the driver and all executors share. Where none is set, a session whose executors are
    threads of the driver (tests) gets a local one; any other has no folder to share, so that is an error."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
