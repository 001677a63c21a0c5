"""Scores and choices."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(values: dict[str, float]) -> Column:
    """Weighted sum of columns."""
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in values.items()])


def capped(stat: Column, current: Column, cap: float, per_point: float) -> Column:
    """What of a stat still counts below its cap."""
    return F.least(stat, F.greatest(F.lit(0.0), (F.lit(cap) - current) / F.lit(per_point)))


def product(factors: list[Column]) -> Column:
    """The product, null if any factor is not positive."""
    positive = reduce(and_, [f > 0 for f in factors])
    return F.when(positive, reduce(lambda a, b: a * b, factors))


def ladder(value: Column, steps: list[tuple[float, float]], above: float) -> Column:
    """The result of the first step whose bound is at or above value."""
    out = None
    for bound, result in steps:
        out = F.when(value <= bound, result) if out is None else out.when(value <= bound, result)
    return out.otherwise(above)


def best(rows: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """The first row of each group; the order says which tie wins."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n = 1").drop("_n")


def all_of(conditions: list[Column]) -> Column:
    """F17."""
    return reduce(and_, conditions)


def weighted_order(weight: Column, key: Column, seed: int) -> Column:
    """Sort key of a weighted shuffle without replacement (Efraimidis and Spirakis); the rolls are hashes of the key."""
    roll = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") + 1) / 4294967297.0
    return -F.log(roll) / weight


def phases(rows: DataFrame, key: str, group: str, quota: int, more: tuple[object, int], total: int, *order: Column) -> DataFrame:
    """The first `quota` of each group, then so many more of one group, then the best others up to the total; with `phase`.
    Ranks beyond what can be chosen are cut before rows are shuffled, and only top rows are ever ordered together."""
    name, extra = more
    deep = quota + extra
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= deep)
    first = ranked.filter((F.col("_r") <= quota) | (F.col(group).eqNullSafe(F.lit(name)))).withColumn("phase", F.when(F.col("_r") <= quota, 1).otherwise(2)).drop("_r")
    rest = rows.join(first.select(key), key, "left_anti").orderBy(*order).limit(total).withColumn("phase", F.lit(3)).select(*first.columns)
    return first.unionByName(rest).orderBy("phase", *order).limit(total)


def pushed(name: Column, relevance: Column, needs: Column, done: Column) -> Column:
    """K6: array of (act, rel) that an executed action pushes: its prerequisite at +0.002 and itself again at +0.001 where it
    needs one; what comes after it where it is done; else its alternative at +0.003."""
    one = lambda prefix, more: F.struct(F.concat(F.lit(prefix), name).alias("act"), (relevance + more).alias("rel"))
    return F.when(needs, F.array(one("before ", 0.002), one("", 0.001))).when(done, F.array(one("after ", 0.0))).otherwise(F.array(one("else ", 0.003)))


def first_match(cases: list[tuple[Column, str, str]], otherwise: tuple[str, str]) -> Column:
    """struct(level, reason) of the first condition that holds."""
    out = None
    for condition, level, reason in cases:
        value = F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"))
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.struct(F.lit(otherwise[0]).alias("level"), F.lit(otherwise[1]).alias("reason")))


def weighted(rows: DataFrame, key: str, kind: str, stats: list[str], weights: DataFrame) -> DataFrame:
    """Per key the sum of its stats times the weights (kind, stat, weight) of its kind; a stat without a weight counts 0."""
    long = rows.select(key, kind, F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).alias("v")) for c in stats])).alias("x")).select(key, kind, "x.stat", "x.v")
    return long.join(weights, [kind, "stat"], "left").groupBy(key).agg(F.coalesce(F.sum(F.col("v") * F.col("weight")), F.lit(0.0)).alias("score"))


def from_both_ends(pool: DataFrame, group: str, needs: DataFrame, need: str, *order: str) -> DataFrame:
    """Of each group's pool the first `need` rows and the last `need` rows, by order, with `taken` (first or last; first
    where both hold). No more than the largest need is ever ranked of a group's two ends."""
    most = needs.agg(F.max(need)).first()[0] or 0
    ends, rows = None, pool.withColumn("_row", F.monotonically_increasing_id())
    for name, by in (("first", [F.asc(c) for c in order]), ("last", [F.desc(c) for c in order])):
        end = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*by))).filter(F.col("_r") <= most).withColumn("taken", F.lit(name))
        ends = end if ends is None else ends.unionByName(end)
    kept = ends.join(needs, group).filter(F.col("_r") <= F.col(need))
    return kept.groupBy("_row").agg(F.min(F.struct("taken", *pool.columns)).alias("_k")).select("_k.*")
