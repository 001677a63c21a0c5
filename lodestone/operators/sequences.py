"""Rows in the order of their group: runs, histories, crops, the next larger score. Windows are per key, never global."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, group: list[str], order: list[str], kind: str) -> DataFrame:
    """`changed` (the kind differs from the row before, the first row included) and `ordinal`, restarting at each change."""
    w = Window.partitionBy(*group).orderBy(*order)
    flagged = df.withColumn("changed", ~F.col(kind).eqNullSafe(F.lag(kind).over(w)) | (F.row_number().over(w) == 1))
    run = flagged.withColumn("_run", F.sum(F.col("changed").cast("int")).over(w))
    return run.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group, "_run").orderBy(*order))).drop("_run")


def history(df: DataFrame, group: list[str], order: str, value: str, size: int = 10) -> DataFrame:
    """The last `size` values of each group, oldest first. Rows beyond go before values are gathered."""
    newest = df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(order)))).filter(F.col("_n") <= size)
    listed = newest.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_l"))
    return listed.select(*group, F.col("_l.v").alias("history"))


def cropped(df: DataFrame, group: list[str], order: list[str], distance: str) -> DataFrame:
    """The rows of each group up to its nearest one (the first of the nearest)."""
    w = Window.partitionBy(*group)
    so_far = F.min(distance).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_before", so_far).withColumn("_least", F.min(distance).over(w))
    return marked.filter(F.col("_before").isNull() | (F.col("_before") > F.col("_least"))).drop("_before", "_least")


def upgrades(df: DataFrame, group: str, level: str, score: str, key: str, span: int, has: Column | None = None) -> DataFrame:
    """Of each row, how many rows of its group within `span` levels score higher, and the least such score.

    Each row asks at 2 * span + 1 levels; at a level one ordered pass answers all, so pairs of rows never arise.
    `score` is a whole number. With `has`, only rows for which it holds count as higher ones.
    """
    asks = df.select(key, group, F.explode(F.sequence(F.col(level) - span, F.col(level) + span)).alias("_at"), score, F.lit(0).alias("_has"))
    have = (df if has is None else df.filter(has)).select(F.lit(None).cast("long").alias(key), group, F.col(level).alias("_at"), score, F.lit(1).alias("_has"))
    higher = Window.partitionBy(group, "_at").orderBy(F.col("_minus")).rangeBetween(Window.unboundedPreceding, -1)
    answered = asks.unionByName(have).withColumn("_minus", -F.col(score))
    answered = answered.withColumn("_n", F.sum("_has").over(higher)).withColumn("_next", F.min(F.when(F.col("_has") == 1, F.col(score))).over(higher))
    return answered.filter("_has = 0").groupBy(key).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("upgrades"), F.min("_next").alias("closest"))


def compared(old: DataFrame, new: DataFrame, keys: list[str], value: str, *, gone: bool = False) -> DataFrame:
    """Per key of the new list (of either, if `gone`) the signed and absolute difference, and what was added and removed."""
    theirs = old.select(*keys, F.col(value).alias("_o"))
    both = new.select(*keys, F.col(value).alias("_n")).join(theirs, keys, "full" if gone else "left")
    d = F.coalesce("_n", F.lit(0)) - F.coalesce("_o", F.lit(0))
    return both.select(*keys, d.alias("signed"), F.abs(d).alias("absolute"), F.greatest(d, F.lit(0)).alias("added"), F.greatest(-d, F.lit(0)).alias("removed"))


def running(df: DataFrame, group: list[str], bucket: Column, order: list[str | Column], value: Column, out: str) -> DataFrame:
    """Df with `out`, the sum of `value` over the group's earlier rows. `bucket` is a whole number that never
    falls in that order: a task orders one bucket of a group, never the whole group; the buckets' sums are added in two levels."""
    rows = df.withColumn("_at", bucket.cast("long")).withColumn("_value", value)
    sums = rows.groupBy(*group, "_at").agg(F.sum("_value").alias("_sum")).withColumn("_top", F.floor(F.col("_at") / 1024))
    tops = sums.groupBy(*group, "_top").agg(F.sum("_sum").alias("_topsum"))
    tops = tops.select(*group, "_top", (F.sum("_topsum").over(Window.partitionBy(*group).orderBy("_top")) - F.col("_topsum")).alias("_topbase"))
    inside = F.sum("_sum").over(Window.partitionBy(*group, "_top").orderBy("_at")) - F.col("_sum")
    bases = sums.withColumn("_inside", inside).join(tops, [*group, "_top"]).select(*group, "_at", (F.col("_topbase") + F.col("_inside")).alias("_base"))
    before = F.coalesce(F.sum("_value").over(Window.partitionBy(*group, "_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_mine", before).join(bases, [*group, "_at"]).withColumn(out, F.col("_base") + F.col("_mine")).select(*df.columns, out)


def chance(key: Column, outcomes: int = 101) -> Column:
    """A number from 0 to outcomes - 1 that depends on the key alone, so repeated runs agree."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % outcomes


def passes(key: Column, percent: Column) -> Column:
    """A gate; no percentage, or 0, always passes; 101 outcomes."""
    return F.coalesce(percent == 0, F.lit(True)) | (chance(key) < percent)


def first_success(key: Column, channels: list[tuple[str, Column]]) -> Column:
    """Channels roll one after the other; the first that succeeds, or null."""
    rolls = [F.when(chance(F.concat_ws(":", F.lit(name), key.cast("string")), 100) < percent, F.lit(name)) for name, percent in channels]
    return F.coalesce(*rolls)
