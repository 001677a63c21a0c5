"""Graphs as edge tables: closure, shortest paths, costs, pruning. Frontiers are joined round by round; lineage is cut each round."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import checkpointed


def undirected(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """Both directions, without loops and repeats."""
    both = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst")))
    return both.filter("src <> dst").distinct()


def _rounds(max_hops: int | None) -> Iterable[int]:
    """2, 3, ..., max_hops; without end if None."""
    return count(2) if max_hops is None else range(2, max_hops + 1)


class _Seen:
    """What rounds have found so far: each round's rows are written once; the tables are put together every 16 rounds."""

    def __init__(self, first: DataFrame) -> None:
        self.parts = [first]

    def add(self, part: DataFrame) -> None:
        self.parts.append(part)
        if len(self.parts) == 16:
            self.parts = [checkpointed(self.all())]

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)


def closure(edges: DataFrame, max_hops: int | None = None, ignored: DataFrame | None = None, important: DataFrame | None = None) -> DataFrame:
    """(src, dst, hops): the fewest hops from src to every node it reaches, if given within max_hops. No way leads
    over nodes that are ignored (`node`); only important nodes (`node`) are given as dst."""
    if ignored is not None:
        edges = edges.join(ignored.select(F.col("node").alias("src")), "src", "left_anti").join(ignored.select(F.col("node").alias("dst")), "dst", "left_anti")
    edges = checkpointed(edges.select("src", "dst").filter("src <> dst").distinct())
    front = edges.withColumn("hops", F.lit(1))
    seen = _Seen(front)
    for hop in _rounds(max_hops):
        step = front.select("src", F.col("dst").alias("mid")).join(edges.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst").filter("src <> dst").distinct()
        front = checkpointed(step.join(seen.all(), ["src", "dst"], "left_anti").withColumn("hops", F.lit(hop)))
        if front.isEmpty():
            break
        seen.add(front)
    return seen.all() if important is None else seen.all().join(important.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst", "hops")


def shortest_paths(edges: DataFrame, max_hops: int | None = None) -> DataFrame:
    """As closure, with the path as an array of nodes (the smallest of the shortest, as arrays compare)."""
    edges = checkpointed(edges.select("src", "dst").filter("src <> dst").distinct())
    front = edges.withColumn("path", F.array("src", "dst"))
    seen = _Seen(front)
    for _ in _rounds(max_hops):
        moved = front.withColumnRenamed("dst", "mid").join(edges.select(F.col("src").alias("mid"), "dst"), "mid").filter("src <> dst")
        step = moved.groupBy("src", "dst").agg(F.min(F.concat("path", F.array("dst"))).alias("path"))
        front = checkpointed(step.join(seen.all(), ["src", "dst"], "left_anti"))
        if front.isEmpty():
            break
        seen.add(front)
    return seen.all()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that is reachable, edges read both ways. Every round a node takes the smallest
    label of its neighbours and then that label's own, so rounds grow with the logarithm of a path's length."""
    both = checkpointed(undirected(edges))
    label = checkpointed(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("node"), F.min("dst")).alias("component")))
    for _ in count():
        theirs = both.join(label.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("component").alias("_c"))
        near = label.join(theirs, "node").select("node", F.least("component", "_c").alias("component"))
        up = near.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        after = checkpointed(near.join(up, "component", "left").select("node", F.coalesce("_up", "component").alias("component")))
        if after.join(label, ["node", "component"], "left_anti").isEmpty():
            return after
        label = after


def without_small_components(edges: DataFrame, least: int = 5) -> DataFrame:
    """Edges of components with at least so many nodes."""
    of = components(edges)
    large = of.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    kept = of.join(large.select("component"), "component", "left_semi").select(F.col("node").alias("src"))
    return edges.join(kept, "src", "left_semi")


def cheapest(edges: DataFrame, max_hops: int | None = None, budget: float | None = None) -> DataFrame:
    """G9 without prices: (src, dst, cost): the least cost, if given with at most max_hops edges and within a budget; edges of negative cost are forbidden."""
    usable = checkpointed(edges.filter("cost >= 0").groupBy("src", "dst").agg(F.min("cost").alias("cost")))
    best = front = usable
    for _ in _rounds(max_hops):
        longer = front.select("src", F.col("dst").alias("mid"), F.col("cost").alias("_c")).join(usable.select(F.col("src").alias("mid"), "dst", "cost"), "mid")
        longer = longer.filter("src <> dst").groupBy("src", "dst").agg(F.min(F.col("_c") + F.col("cost")).alias("cost"))
        if budget is not None:
            longer = longer.filter(F.col("cost") <= budget)
        front = checkpointed(longer.join(best.withColumnRenamed("cost", "_known"), ["src", "dst"], "left").filter("_known IS NULL OR cost < _known").select("src", "dst", "cost"))
        if front.isEmpty():
            break
        best = checkpointed(best.unionByName(front).groupBy("src", "dst").agg(F.min("cost").alias("cost")))
    return best


def cheapest_within(edges: DataFrame, gold: float) -> DataFrame:
    """(src, dst, cost, price): the least cost of a way whose prices together are within `gold`, the lowest price at that
    cost. Of each pair those ways go on of which no other is both cheaper and faster, so the result is exact."""

    def best(ways: DataFrame) -> DataFrame:
        below = Window.partitionBy("src", "dst").orderBy("cost", "price")
        least = F.min("price").over(below.rowsBetween(Window.unboundedPreceding, -1))
        return ways.withColumn("_p", least).filter("_p IS NULL OR price < _p").drop("_p")

    usable = checkpointed(best(edges.select("src", "dst", "cost", "price").filter((F.col("cost") >= 0) & (F.col("price") <= gold))))
    known = front = usable
    while True:
        more = front.select("src", F.col("dst").alias("mid"), F.col("cost").alias("_c"), F.col("price").alias("_q")).join(usable.select(F.col("src").alias("mid"), "dst", "cost", "price"), "mid")
        more = more.select("src", "dst", (F.col("_c") + F.col("cost")).alias("cost"), (F.col("_q") + F.col("price")).alias("price")).filter((F.col("src") != F.col("dst")) & (F.col("price") <= gold))
        after = checkpointed(best(known.unionByName(more)))
        front = checkpointed(after.join(known, ["src", "dst", "cost", "price"], "left_anti"))
        if front.isEmpty():
            break
        known = after
    return known.groupBy("src", "dst").agg(F.min(F.struct("cost", "price")).alias("_b")).select("src", "dst", "_b.cost", "_b.price")


def without_detours(edges: DataFrame, factor: float = 1.1) -> DataFrame:
    """Edges for which no way of two or more other edges is shorter than factor times the direct cost, again and again
    until none is dropped. A way that makes an edge useless has only edges that come before it by (cost, src, dst), so edges
    that would replace each other are not both dropped, and what was reachable stays so."""
    left = checkpointed(edges.select("src", "dst", "cost"))
    order = F.struct("cost", "src", "dst")
    while True:
        steps = left.select(F.col("src").alias("_at"), F.col("dst").alias("_to"), F.col("cost").alias("_step"), order.alias("_key"))
        wanted = left.select("src", "dst", "cost", order.alias("_own"))
        walks = wanted.join(steps, (F.col("src") == F.col("_at")) & (F.col("_key") < F.col("_own"))).select("src", "dst", "cost", "_own", F.col("_to").alias("at"), F.col("_step").alias("total"))
        near = F.col("total") < factor * F.col("cost")
        seen = front = checkpointed(walks.filter(near))
        while True:
            on = front.filter("at <> dst").join(steps, (F.col("at") == F.col("_at")) & (F.col("_key") < F.col("_own")))
            on = on.withColumn("total", F.col("total") + F.col("_step")).filter(near & (F.col("_to") != F.col("src"))).groupBy("src", "dst", "cost", "_own", F.col("_to").alias("at")).agg(F.min("total").alias("total"))
            best = seen.groupBy("src", "dst", "cost", "at").agg(F.min("total").alias("_known"))
            front = checkpointed(on.join(best, ["src", "dst", "cost", "at"], "left").filter("_known IS NULL OR total < _known").drop("_known").select(*seen.columns))
            if front.isEmpty():
                break
            seen = checkpointed(seen.unionByName(front))
        useless = seen.filter("at = dst").select("src", "dst", "cost").distinct()
        after = checkpointed(left.join(useless, ["src", "dst", "cost"], "left_anti"))
        if useless.isEmpty():
            return after
        left = after


def with_reversed(paths: DataFrame) -> DataFrame:
    """(src, dst, path, how) for paths (src, dst, path, complete, walk): a complete path as it is, else the reversed path
    of the way back if that is complete and walked, else the path as far as it goes; the same holds for the way back."""
    back = paths.filter("complete AND walk").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.reverse("path").alias("_back"))
    both = paths.join(back, ["src", "dst"], "left")
    how = F.when(F.col("complete"), "own").when(F.col("_back").isNotNull(), "reversed").otherwise("part")
    return both.select("src", "dst", F.when(how == "reversed", F.col("_back")).otherwise(F.col("path")).alias("path"), how.alias("how"))


def paired_ends(starts: DataFrame, ends: DataFrame, reachable: DataFrame, request: str) -> DataFrame:
    """Of the nearest nodes of both ends of a request, starts (request, start, i) and ends (request, end, j) with ranks
    from 0, the first pair with a route, in the order in which ends are tried: j from 0 to i + 1, then the next i."""
    pairs = starts.join(ends, request).filter(F.col("j") <= F.col("i") + 1)
    routed = pairs.join(reachable.select(F.col("src").alias("start"), F.col("dst").alias("end")), ["start", "end"], "left_semi")
    return routed.groupBy(request).agg(F.min(F.struct("i", "j", "start", "end")).alias("_p")).select(request, "_p.start", "_p.end", "_p.i", "_p.j")


def edge_cost(distance: Column, swim: Column, speed: float, swim_speed: float, mobs: Column, faction: Column, extra: Column | None = None, walk: Column | None = None) -> Column:
    """(run / speed + swim / swim speed) * (1 + 0.1 * mobs + 0.3 * faction), where those are above 0; extra cost for ways
    that are not walked; a cost below 0 forbids the way."""
    modifier = 1 + 0.1 * F.greatest(mobs, F.lit(0)) + 0.3 * F.greatest(faction, F.lit(0))
    walked = ((distance - swim) / speed + swim / swim_speed) * modifier
    return walked if walk is None else F.when(walk, walked).otherwise(extra * modifier)


def transfers_closed(transfers: DataFrame) -> DataFrame:
    """Transfers and their two-step joins, the shortest of each pair."""
    t = transfers.select("src", "dst", "cost")
    two = t.select("src", F.col("dst").alias("mid"), F.col("cost").alias("_c")).join(t.select(F.col("src").alias("mid"), "dst", F.col("cost").alias("_d")), "mid").filter("src <> dst")
    return t.unionByName(two.select("src", "dst", (F.col("_c") + F.col("_d")).alias("cost"))).groupBy("src", "dst").agg(F.min("cost").alias("cost"))


def route_length(route: DataFrame, edges: DataFrame) -> DataFrame:
    """Per path_id the sum over all consecutive nodes of `path`."""
    pairs = route.select("path_id", F.explode(F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("src"), F.slice("path", 2, F.size("path")).alias("dst"))).alias("e")).select("path_id", "e.src", "e.dst")
    return pairs.join(edges, ["src", "dst"]).groupBy("path_id").agg(F.sum("cost").alias("cost"))
