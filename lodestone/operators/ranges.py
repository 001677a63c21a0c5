"""Range joins without nested loops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expanded(brackets: DataFrame, low: str, high: str, level: str) -> DataFrame:
    """A row per integer level in low..high, for equi joins on the level. For narrow brackets."""
    return brackets.withColumn(level, F.explode(F.sequence(F.col(low), F.col(high))))


def binned_range_join(points: DataFrame, brackets: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Points and the brackets with low <= at <= high, by an equi join on bins of `width`."""
    left = points.withColumn("_bin", F.floor(F.col(at) / width))
    right = brackets.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return left.join(right, "_bin").filter(F.col(at).between(F.col(low), F.col(high))).drop("_bin")


def histogram(rows: DataFrame, level: str, sides: dict[str, Column], parts: int = 8) -> DataFrame:
    """Low, high and a count for each side, per step of max(1, (top + 4) div parts) levels from 1 up to the largest, top.
    A step ends where level + 1 is a multiple of its width, or at the top; empty steps are left out."""
    top = F.broadcast(rows.agg(F.max(level).alias("_top")))
    stepped = rows.crossJoin(top).filter(F.col(level) >= 1).withColumn("_step", F.greatest(F.lit(1), F.floor((F.col("_top") + 4) / parts)))
    at = stepped.withColumn("_at", F.floor(F.col(level) / F.col("_step")) * F.col("_step"))
    counted = at.groupBy("_at", "_step", "_top").agg(*[F.count_if(c).alias(name) for name, c in sides.items()])
    return counted.select(F.greatest(F.lit(1), "_at").cast("int").alias("low"), F.least(F.col("_top"), F.col("_at") + F.col("_step") - 1).cast("int").alias("high"), *sides)


def windowed_levels(rows: DataFrame, required: str, levels: DataFrame, level: str, window: int = 13) -> DataFrame:
    """rows and the levels that may use them: required <= level, and from level window + 1 on not more than `window` below.
    An equi join: low levels take all below them, higher ones look at window + 1 levels."""
    low = F.when(F.col(level) > window, F.col(level) - window).otherwise(0)
    asked = levels.select(level, F.explode(F.sequence(low, F.col(level))).alias("_req"))
    return rows.join(asked, F.col(required) == F.col("_req")).drop("_req")


#: Cells that an enumeration may have; its axes are dimensions of fixed size.
CELLS = 1_000_000


def enumerated(*axes: DataFrame) -> DataFrame:
    """All combinations of a few small axes; an error beyond CELLS of them."""
    total = 1
    for axis in axes:
        total *= axis.count()
    if total > CELLS:
        raise ValueError(f"{total} combinations")
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), axes)
