"""Relational clean-up and lookup: anti and semi joins, keep-latest, expiry, overrides, as-of lookups, table maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child without a parent. A null key has no parent (NOT EXISTS, not NOT IN)."""
    return child.join(parent.select(F.col(parent_key).alias("_parent")), F.col(child_key) == F.col("_parent"), "left_anti")


def having_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose parent exists; applied from the top down it is the cascade's survivors."""
    return child.join(parent.select(F.col(parent_key).alias("_parent")), F.col(child_key) == F.col("_parent"), "left_semi")


def keep_max_of_group(rows: DataFrame, subject: str, group: Sequence[str], key: str, *, on_subject_only: bool = False) -> DataFrame:
    """Without the duplicates of each group but the one with the largest key. on_subject_only compares with
    the largest key of *any* group of the subject, as a join on the subject alone does."""
    by = [subject] if on_subject_only else [subject, *group]
    if not on_subject_only:
        best = rows.groupBy(*by).agg(F.max(key).alias(key))
        return rows.join(best, [*by, key], "left_semi")
    tops = rows.groupBy(subject, *group).agg(F.max(key).alias("_top")).groupBy(subject).agg(F.min("_top").alias("_lo"), F.max("_top").alias("_hi"))
    other = (F.col("_lo") != F.col("_hi")) | (F.col(key) != F.col("_lo"))  # some group's largest key is another one
    return rows.join(rows.join(tops, subject).filter(other).select(key).distinct(), key, "left_anti")


def latest(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """K2: the first row of each key by `order` (one Window with a group limit; no self join)."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def unexpired(age: Column, valid_in: Column, exempt: Column | None = None) -> Column:
    """true unless a positive lifetime is over; a lifetime of 0 never ends."""
    over = (F.coalesce(valid_in, F.lit(0)) > 0) & (age >= valid_in)
    return ~(over & ~exempt) if exempt is not None else ~over


def task_value(value: Column, age: Column, valid_in: Column) -> Column:
    """F16: 0 once the lifetime is over; a lifetime of 0 is over at once."""
    return F.when(age >= valid_in, F.lit(0)).otherwise(value)


def override_lookup(base: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Of rows for one key the one of the highest priority (specific over general)."""
    return latest(base, keys, F.desc(priority))


def asof_floor(requests: DataFrame, levels: DataFrame, by: Sequence[str], at: str, level: str, tolerance: int, value: str) -> DataFrame:
    """To each request the row with the nearest level at or below `at`, at most `tolerance` lower.

    Levels are looked up by an equi join on the exploded window of integer levels when it is narrow, so no range join.
    """
    mine = requests.withColumn("_row", F.monotonically_increasing_id())
    window = mine.withColumn("_level", F.explode(F.sequence(F.col(at) - tolerance, F.col(at))))
    hit = window.join(levels.select(*by, F.col(level).alias("_level"), value), [*by, "_level"])
    best = hit.groupBy("_row").agg(F.max_by(F.struct(*requests.columns, value), "_level").alias("_b"), F.max("_level").alias("found_level"))
    return best.select("_b.*", "found_level")


def insert_ignore(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M1, M2: table and those rows whose key it lacks (one row per new key)."""
    fresh = rows.join(table.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys))
    return table.unionByName(fresh.select(*table.columns))


def replace_into(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M3: table with rows put in the place of those of equal key."""
    return table.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows.select(*table.columns))


def update_where(table: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """M4."""
    return table.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """M5: a null condition deletes nothing."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def coalesced_patch(table: DataFrame, patch: DataFrame, key: str, column: str) -> DataFrame:
    """Column from the patch where it has the key, else as it was."""
    new = patch.select(key, F.col(column).alias("_new"))
    return table.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def either_way(links: DataFrame, a: str, b: str) -> DataFrame:
    """An edge table read in both directions."""
    return links.select(F.col(a).alias("one"), F.col(b).alias("other")).unionByName(links.select(F.col(b).alias("one"), F.col(a).alias("other"))).distinct()


def with_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """M9: df with those of the columns (name: type and default) that it has not yet; those it has stay as they are."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(default).cast(kind) for c, (kind, default) in columns.items() if c.lower() not in have})


def by_level_and_type(items: DataFrame, level: str, kind: str, low: int, high: int, predicate: Column, kinds: Sequence[str] | None = None) -> DataFrame:
    """items of levels low..high, of some types if given, for which the caller's predicate holds."""
    found = items.filter(F.col(level).between(low, high) & predicate)
    return found if kinds is None else found.filter(F.col(kind).isin(*kinds))
