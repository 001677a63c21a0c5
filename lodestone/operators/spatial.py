"""Positions: cells, radius and nearest-neighbour search, centroids, paths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import checkpointed

XYZ = ("x", "y", "z")
BROADCAST_ROWS = 100_000
#: Points of a group up to which all of its pairs are few.
WHOLE_GROUP = 1_000


def squared(a: str, b: str, axes: Sequence[str] = XYZ) -> Column:
    """Squared distance of the columns a_x.. and b_x.."""
    return sum((F.pow(F.col(f"{a}{c}") - F.col(f"{b}{c}"), 2) for c in axes[1:]), F.pow(F.col(f"{a}{axes[0]}") - F.col(f"{b}{axes[0]}"), 2))


def cell(column: str, size: float) -> Column:
    """A14, X24."""
    return F.floor(F.col(column) / size).cast("int")


def grid_id(column: Column, centre: float, size: float) -> Column:
    """int(centre - x / size)."""
    return F.floor(F.lit(centre) - column / size).cast("int")


def grid_corner(grid: Column, centre: float, size: float) -> Column:
    """X24, the way back: (centre - grid) * size."""
    return (F.lit(centre) - grid) * size


def angle(dx: Column, dy: Column) -> Column:
    """The direction of (dx, dy), normalised to 0 up to 2 pi."""
    turn = F.atan2(dy, dx)
    return F.when(turn < 0, turn + 2 * F.pi()).otherwise(turn)


def weighted_pick(points: DataFrame, by: Sequence[str], key: str, weight: Column, seed: int) -> DataFrame:
    """One point of each group, by chance in proportion to its weight. The roll is a hash of the key, so repeated
    runs agree; the smallest -ln(roll) / weight wins, which is an aggregate: no group is ordered."""
    roll = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") + 1) / 4294967297.0
    return points.withColumn("_r", -F.log(roll) / weight).groupBy(*by).agg(F.min_by(key, F.struct("_r", key)).alias("picked"))


def within(points: DataFrame, key: str, group: str, radius: float, axes: Sequence[str] = XYZ) -> DataFrame:
    """Pairs (a, b, d2) of different points of a group within the radius.

    One side is copied to the neighbouring cells of a grid of the radius, so it is an equi join on group and cell.
    """
    left = points.select(F.col(group).alias("g"), F.col(key).alias("a"), *[F.col(c).alias(f"a{c}") for c in axes], *[cell(c, radius).alias(f"c{c}") for c in axes])
    right = points.select(F.col(group).alias("g"), F.col(key).alias("b"), *[F.col(c).alias(f"b{c}") for c in axes], *[cell(c, radius).alias(f"c{c}") for c in axes])
    for c in axes:
        right = right.withColumn(f"c{c}", F.explode(F.array(*[F.col(f"c{c}") + i for i in (-1, 0, 1)])))
    near = left.join(right, ["g", *[f"c{c}" for c in axes]]).withColumn("d2", squared("a", "b", axes))
    return near.filter((F.col("a") != F.col("b")) & (F.col("d2") <= radius * radius)).select("g", "a", "b", "d2")


def nearest(queries: DataFrame, points: DataFrame, query: str, key: str, group: str, k: int, axes: Sequence[str] = XYZ) -> DataFrame:
    """The k nearest other points of the group to each query, by exact distance, ties by key.

    Queries meet the points of their own and the neighbouring cells of a grid that holds about k points a cell. A query is
    done once its k-th point is nearer than a cell is wide; the others go on with cells twice as wide, at last with one
    that holds a whole group. Dense groups never meet as a whole: only if no group has more than WHOLE_GROUP points (counted)
    is one such cell where the search begins.
    """
    left = checkpointed(queries.select(F.col(query).alias("a"), F.col(group).alias("g"), *[F.col(c).alias(f"a{c}") for c in axes]))
    right = checkpointed(points.select(F.col(key).alias("b"), F.col(group).alias("g"), *[F.col(c).alias(f"b{c}") for c in axes]))
    most = right.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    extent, size = 0.0, 1.0
    if most > WHOLE_GROUP:
        ends = [x.agg(*[F.struct(F.min(f"{p}{c}").alias("lo"), F.max(f"{p}{c}").alias("hi")) for c in axes]).first() for x, p in ((left, "a"), (right, "b"))]
        if ends[0][0]["lo"] is not None:
            extent = max(max(e[i]["hi"] for e in ends) - min(e[i]["lo"] for e in ends) for i in range(len(axes)))
            size = max(extent / max(1.0, (most / k) ** (1 / len(axes))), 1e-9)
    rank = F.row_number().over(Window.partitionBy("a").orderBy("d2", "b"))
    done = []
    while True:
        last = size > extent
        mine, theirs = left, right
        for c in axes if most > WHOLE_GROUP else ():
            mine = mine.withColumn(f"c{c}", F.explode(F.array(*[cell(f"a{c}", size) + i for i in (-1, 0, 1)])))
            theirs = theirs.withColumn(f"c{c}", cell(f"b{c}", size))
        pairs = mine.join(theirs, ["g", *[f"c{c}" for c in axes if most > WHOLE_GROUP]]).filter(F.col("a") != F.col("b")).withColumn("d2", F.round(squared("a", "b", axes), 6))
        ranked = checkpointed(pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("a", "b", "d2", "rank"))
        if last:
            done.append(ranked)
            break
        full = ranked.filter((F.col("rank") == k) & (F.col("d2") + 1e-6 < size * size)).select("a")
        done.append(ranked.join(full, "a", "left_semi"))
        left = checkpointed(left.join(full, "a", "left_anti"))
        if left.isEmpty():
            break
        size *= 2
    return reduce(DataFrame.unionByName, done)


def centroid(points: DataFrame, by: Sequence[str], axes: Sequence[str] = XYZ) -> DataFrame:
    """A16."""
    return points.groupBy(*by).agg(*[F.avg(c).alias(f"m{c}") for c in axes], F.count(F.lit(1)).alias("n"))


def medoid(points: DataFrame, by: Sequence[str], key: str, axes: Sequence[str] = XYZ) -> DataFrame:
    """The member nearest to its group's centroid, ties by key."""
    middle = centroid(points, by, axes)
    d2 = sum((F.pow(F.col(c) - F.col(f"m{c}"), 2) for c in axes[1:]), F.pow(F.col(axes[0]) - F.col(f"m{axes[0]}"), 2))
    return points.join(middle, list(by)).groupBy(*by).agg(F.min_by(key, F.struct(F.round(d2, 6), F.col(key))).alias("medoid"), F.first("n").alias("n"), *[F.first(f"m{c}").alias(f"m{c}") for c in axes])


def wkt_line(points: Column) -> Column:
    """LINESTRING of an array of structs with x and y."""
    return F.concat(F.lit("LINESTRING("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ","), F.lit(")"))


def steps(points: DataFrame, path: str, at: str, value: str) -> DataFrame:
    """To each point of a path the step from the one before and the running length."""
    order = Window.partitionBy(path).orderBy(at)
    step = F.coalesce(F.abs(F.col(value) - F.lag(value).over(order)), F.lit(0.0))
    return points.withColumn("step", step).withColumn("run", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def hulls(points: DataFrame) -> DataFrame:
    """g, x, y: the corners of the convex hull of each group, first of each task's points, then of those corners."""

    def corners(xy: set[tuple[float, float]]) -> set[tuple[float, float]]:
        out: set[tuple[float, float]] = set()
        for some in (sorted(xy), sorted(xy, reverse=True)):
            chain: list[tuple[float, float]] = []
            for p in some:
                while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) <= (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]):
                    chain.pop()
                chain.append(p)
            out.update(chain)
        return out

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[object, set[tuple[float, float]]] = {}
        for batch in batches:
            fresh: dict[object, set[tuple[float, float]]] = {}
            for g, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fresh.setdefault(g, set()).add((x, y))
            for g, xy in fresh.items():
                kept[g] = corners(xy | kept.get(g, set()))
        rows = [(g, x, y) for g, xy in kept.items() for x, y in xy]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), batch.schema, strict=True)], names=batch.schema.names)

    rows = points.select("g", "x", "y")
    return rows.mapInArrow(part, rows.schema).repartition("g").mapInArrow(part, rows.schema)


def farthest_flight(points: DataFrame, group: str, step: float = 0.1, safe: float = 0.02) -> DataFrame:
    """(group, away): the largest sum of distances to all points of the group from a free place of any point's polar grid.

    A place is free if no point of the group is within `safe`. Points in a place's own cell decide most places, the
    neighbouring cells the others. The sum of distances is convex, so its maximum over the free places is at a corner of
    their convex hull: only corners are held against all points.
    """
    p = points.filter(F.col(group).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy(F.col(group).alias("g"), "x", "y").agg(F.count(F.lit(1)).alias("n"))
    p = checkpointed(p)
    turn = F.col("a") * F.pi() / 4
    places = p.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(2))))
    places = places.select("g", (F.col("x") + step * F.col("r") * F.cos(turn)).alias("x"), (F.col("y") + step * F.col("r") * F.sin(turn)).alias("y"))
    own = [cell(c, safe * 0.7).alias(f"o{c}") for c in "xy"]
    places = places.select("*", *own, *[cell(c, safe).alias(f"c{c}") for c in "xy"]).join(p.select("g", *own).distinct(), ["g", "ox", "oy"], "left_anti")
    around = p.select("g", F.col("x").alias("ex"), F.col("y").alias("ey"), *[cell(c, safe).alias(f"c{c}") for c in "xy"])
    for c in "xy":
        around = around.withColumn(f"c{c}", F.explode(F.array(*[F.col(f"c{c}") + i for i in (-1, 0, 1)])))
    a, b = places.alias("a"), around.alias("b")
    far = lambda x, y: F.sqrt(F.pow(F.col("a.x") - F.col(x), 2) + F.pow(F.col("a.y") - F.col(y), 2))
    same = (F.col("a.g") == F.col("b.g")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    free = a.join(b, same & (far("b.ex", "b.ey") <= safe), "left_anti")
    ends = checkpointed(hulls(free))
    ends = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
    pairs = p.alias("b").join(ends.alias("a"), F.col("a.g") == F.col("b.g")).select(F.col("a.g").alias(group), F.col("a.x").alias("x"), F.col("a.y").alias("y"), (F.col("b.n") * far("b.x", "b.y")).alias("d"))
    return pairs.groupBy(group, "x", "y").agg(F.sum("d").alias("away")).groupBy(group).agg(F.max("away").alias("away"))
