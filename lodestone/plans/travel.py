"""Named queries over positions, paths and graphs; each with its SQL, where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators import graph, scoring, spatial
from lodestone.plans.catalogue import EDGES_SQL, POSITIONS, all_edges, count, positions, query
from lodestone.session import checkpointed
from lodestone.sources.tables import table

NEAR = f"p AS ({POSITIONS}), u AS (SELECT a.map_id, a.id AS src, b.id AS dst FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0064)"


def neighbours(s: SparkSession, d: str) -> DataFrame:
    return spatial.within(positions(s, d), "id", "map_id", 0.08).select(F.col("g").alias("map_id"), F.col("a").alias("src"), F.col("b").alias("dst"))


@query(f"""
WITH RECURSIVE {NEAR}, r AS (SELECT DISTINCT src AS node, src AS root FROM u UNION SELECT u.dst, r.root FROM r JOIN u ON u.src = r.node),
c AS (SELECT node, min(root) AS component FROM r GROUP BY 1), k AS (SELECT component FROM c GROUP BY 1 HAVING count(*) >= 5)
SELECT src, dst FROM u JOIN c ON c.node = u.src WHERE component IN (SELECT component FROM k)""")
def component_removal(s: SparkSession, d: str) -> DataFrame:
    """Links of neighbours, without components of fewer than five nodes."""
    return graph.without_small_components(neighbours(s, d).select("src", "dst"))


@query(None)
def graph_prune(s: SparkSession, d: str) -> DataFrame:
    """Flows without those that a way of several others replaces, to the fixpoint (an iteration; tested against plain loops)."""
    return graph.without_detours(all_edges(s, d)).select("src", "dst")


@query(None)
def graph_budget(s: SparkSession, d: str) -> DataFrame:
    """The least cost of a way within 90 gold, a flow's price being its nodes' distance on the list (tested against plain loops)."""
    priced = all_edges(s, d).withColumn("price", (F.abs(F.col("src") - F.col("dst")) * 10).cast("double"))
    return graph.cheapest_within(priced, 90.0).select("src", "dst", F.round("cost", 2).alias("cost"), "price")


@query(f"""
WITH {EDGES_SQL.replace(" WHERE n <= 2", "")}, l AS (SELECT src, dst, cost < 500 AS complete, (src + dst) % 3 > 0 AS walk, concat(src, '>', (src + dst) % 7, '>', dst) AS path, concat(dst, '>', (src + dst) % 7, '>', src) AS back FROM e)
SELECT l.src, l.dst, CASE WHEN l.complete THEN l.path WHEN b.src IS NOT NULL THEN b.back ELSE l.path END AS path, CASE WHEN l.complete THEN 'own' WHEN b.src IS NOT NULL THEN 'reversed' ELSE 'part' END AS how
FROM l LEFT JOIN l b ON b.src = l.dst AND b.dst = l.src AND b.complete AND b.walk""")
def reversed_paths(s: SparkSession, d: str) -> DataFrame:
    """Paths between nations; an incomplete one is replaced by the way back, reversed."""
    links = all_edges(s, d).select("src", "dst", F.array("src", (F.col("src") + F.col("dst")) % 7, "dst").alias("path"), (F.col("cost") < 500).alias("complete"), ((F.col("src") + F.col("dst")) % 3 > 0).alias("walk"))
    return graph.with_reversed(links).select("src", "dst", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"), "how")


@query(f"""
WITH RECURSIVE {NEAR}, r AS (SELECT DISTINCT src AS node, src AS root FROM u UNION SELECT u.dst, r.root FROM r JOIN u ON u.src = r.node),
q AS (SELECT map_id, min(id) AS a, max(id) AS b FROM p GROUP BY 1),
n AS (SELECT q.map_id, side, p.id, row_number() OVER (PARTITION BY q.map_id, side ORDER BY round(pow(p.x - o.x, 2) + pow(p.y - o.y, 2) + pow(p.z - o.z, 2), 6), p.id) - 1 AS k
  FROM q, (VALUES (0), (1)) t(side), p, p o WHERE p.map_id = q.map_id AND o.id = CASE side WHEN 0 THEN a ELSE b END AND p.id <> o.id)
SELECT s.map_id, s.id AS "start", t.id AS "end" FROM n s JOIN n t ON t.map_id = s.map_id AND s.side = 0 AND t.side = 1 AND s.k < 5 AND t.k < 5 AND t.k <= s.k + 1
WHERE EXISTS (SELECT 1 FROM r WHERE node = s.id AND root = t.id AND node <> root) QUALIFY row_number() OVER (PARTITION BY s.map_id ORDER BY s.k, t.k) = 1""")
def route_ends(s: SparkSession, d: str) -> DataFrame:
    """A route from each map's first point to its last: the first pair of their five nearest nodes that is joined."""
    p = checkpointed(positions(s, d))
    asked = p.groupBy("map_id").agg(F.min("id").alias("a"), F.max("id").alias("b"))

    def near(column: str, node: str, rank: str) -> DataFrame:
        ends = p.join(asked.select(F.col(column).alias("id")).distinct(), "id", "left_semi")
        found = spatial.nearest(ends, p, "id", "id", "map_id", 5)
        return asked.join(found.select(F.col("a").alias(column), F.col("b").alias(node), (F.col("rank") - 1).alias(rank)), column).select("map_id", node, rank)

    joined = graph.components(neighbours(s, d))
    starts, ends = near("a", "start", "i"), near("b", "end", "j")
    pairs = starts.join(ends, "map_id").select("start", "end").distinct()
    same = pairs.join(joined.select(F.col("node").alias("start"), "component"), "start").join(joined.select(F.col("node").alias("end"), F.col("component").alias("_c")), "end").filter("component = _c AND start <> end")
    return graph.paired_ends(starts, ends, same.select(F.col("start").alias("src"), F.col("end").alias("dst")), "map_id").select("map_id", "start", "end")


@query(f"""
WITH p AS ({POSITIONS}), s AS (SELECT *, map_id * 10 + id % 10 AS path, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(z) OVER w AS pz, lag(id % 4) OVER w AS pw FROM p WINDOW w AS (PARTITION BY map_id, id % 10 ORDER BY id)),
l AS (SELECT path, coalesce(sqrt(pow(x - px, 2) + pow(y - py, 2) + pow(z - pz, 2)), 0) AS step, id % 4 = 0 OR pw = 0 AS wet FROM s),
c AS (SELECT a.map_id * 10 + a.id % 10 AS path, max(CASE WHEN b.id % 3 = 0 THEN b.id % 60 END) AS m0, max(CASE WHEN b.id % 3 = 1 THEN b.id % 60 END) AS m1, max(CASE WHEN b.id % 3 = 2 THEN b.id % 60 END) AS m2
  FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0064 GROUP BY 1),
t AS (SELECT path, 0.1 + sum(step) AS dist, sum(CASE WHEN wet THEN step ELSE 0 END) AS swim FROM l GROUP BY 1)
SELECT t.path, round(dist, 5) AS dist, round(swim, 5) AS swim, coalesce(m0, 0) AS m0, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2,
  round(((dist - swim) / 8.0 + swim / 4.0) * (1 + 0.1 * greatest(coalesce(m0, 0) - 30, 0) + 0.3 * greatest(coalesce(m2, 0) - 30, 0)), 5) AS cost FROM t LEFT JOIN c ON c.path = t.path""")
def path_costs(s: SparkSession, d: str) -> DataFrame:
    """Each path's length, what of it is in water, the highest levels near it by allegiance, and its cost for level 20."""
    p = positions(s, d).withColumn("path", (F.col("map_id") * 10 + F.col("id") % 10).cast("long"))
    w = Window.partitionBy("path").orderBy("id")
    gap = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), 2) for c in "yz"), F.pow(F.col("x") - F.lag("x").over(w), 2)))
    wet = (F.col("id") % 4 == 0) | (F.lag(F.col("id") % 4).over(w) == 0)
    steps = p.select("path", F.coalesce(gap, F.lit(0.0)).alias("step"), F.coalesce(wet, F.lit(False)).alias("wet"))
    lengths = steps.groupBy("path").agg((0.1 + F.sum("step")).alias("dist"), F.sum(F.when(F.col("wet"), F.col("step")).otherwise(0.0)).alias("swim"))
    near = neighbours(s, d).select((F.col("map_id") * 10 + F.col("src") % 10).cast("long").alias("path"), (F.col("dst") % 3).alias("side"), (F.col("dst") % 60).alias("level"))
    levels = near.groupBy("path").agg(*[F.max(F.when(F.col("side") == i, F.col("level"))).alias(f"m{i}") for i in range(3)])
    both = lengths.join(levels, "path", "left").na.fill(0, ["m0", "m1", "m2"])
    cost = graph.edge_cost(F.col("dist"), F.col("swim"), 8.0, 4.0, F.col("m0") - 30, F.col("m2") - 30)
    return both.select("path", F.round("dist", 5).alias("dist"), F.round("swim", 5).alias("swim"), "m0", "m1", "m2", F.round(cost, 5).alias("cost"))


@query(f"""
WITH p AS ({POSITIONS}), n AS (SELECT a.id AS a, b.id AS b, row_number() OVER (PARTITION BY a.id ORDER BY round(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2), 6), b.id) AS k FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id)
SELECT a, arg_min(b, k) AS node, CAST(min(k) AS INTEGER) AS probes FROM n WHERE k <= 6 AND (a + b) % 3 = 0 GROUP BY 1""")
def probe_nearest(s: SparkSession, d: str) -> DataFrame:
    """The nearest node that can be walked to, of the first six tried."""
    p = positions(s, d)
    tried = spatial.nearest(p, p, "id", "id", "map_id", 6).filter((F.col("a") + F.col("b")) % 3 == 0)
    return tried.groupBy("a").agg(F.min_by("b", "rank").alias("node"), F.min("rank").alias("probes"))


@query(f"""
WITH p AS ({POSITIONS}), w AS (SELECT map_id, id, 1 + 1000 * exp(-(x * x + y * y + z * z) / 0.04) AS w FROM p)
SELECT map_id, id AS picked FROM w QUALIFY row_number() OVER (PARTITION BY map_id ORDER BY -ln((CAST(('0x' || substr(md5('7:' || id), 1, 8)) AS BIGINT) + 1) / 4294967297.0) / w, id) = 1""")
def weighted_point(s: SparkSession, d: str) -> DataFrame:
    """One point of each map, by chance, near the centre rather than far (weights as meant: a bell from 1001 down to 1)."""
    weight = 1 + 1000 * F.exp(-(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")) / 0.04)
    return spatial.weighted_pick(positions(s, d), ["map_id"], "id", weight, 7)


@query(f"""
WITH {NEAR}, n AS (SELECT map_id, src, count(*) AS n FROM u GROUP BY ALL), b AS (SELECT map_id, src FROM n QUALIFY row_number() OVER (PARTITION BY map_id ORDER BY n DESC, src) = 1),
m AS (SELECT b.map_id, u.dst AS id FROM b JOIN u ON u.src = b.src UNION ALL SELECT map_id, src FROM b)
SELECT m.map_id, round((min(x) + max(x)) / 2, 5) AS mx, round((min(y) + max(y)) / 2, 5) AS my, count(*) AS n FROM m JOIN p ON p.id = m.id GROUP BY 1""")
def density_midpoint(s: SparkSession, d: str) -> DataFrame:
    """The middle of the box around the densest point and its neighbours."""
    u = checkpointed(neighbours(s, d))
    best = scoring.best(u.groupBy("map_id", "src").agg(count().alias("n")), ["map_id"], F.desc("n"), F.asc("src")).select("src")
    members = u.join(best, "src").select("map_id", F.col("dst").alias("id")).unionByName(u.join(best, "src").select("map_id", F.col("src").alias("id")).distinct())
    middle = lambda c: F.round((F.min(c) + F.max(c)) / 2, 5)
    return members.join(positions(s, d).select("id", "x", "y"), "id").groupBy("map_id").agg(middle("x").alias("mx"), middle("y").alias("my"), count().alias("n"))


@query(f"""
SELECT map_id, CAST(floor(x / 0.1) AS INTEGER) AS cx, CAST(floor(y / 0.1) AS INTEGER) AS cy, round(avg(x), 7) AS mx, round(avg(y), 7) AS my, round(avg(z), 7) AS mz FROM ({POSITIONS}) GROUP BY ALL HAVING count(*) <= 3""")
def sparse_means(s: SparkSession, d: str) -> DataFrame:
    """The mean position of areas with three points or fewer."""
    groups = positions(s, d).groupBy("map_id", spatial.cell("x", 0.1).alias("cx"), spatial.cell("y", 0.1).alias("cy"))
    return groups.agg(*[F.round(F.avg(c), 7).alias(f"m{c}") for c in "xyz"], count().alias("n")).filter("n <= 3").drop("n")


@query(f"SELECT map_id, round(x, 1) AS x, round(y, 1) AS y, min(id) AS node, count(*) - 1 AS refused FROM (SELECT map_id, id, round(x, 1) + 0.0 AS x, round(y, 1) + 0.0 AS y FROM ({POSITIONS})) GROUP BY ALL")
def node_positions(s: SparkSession, d: str) -> DataFrame:
    """G1: of nodes at one rounded position the first is kept, the others are refused."""
    at = [(F.round(c, 1) + 0.0).alias(c) for c in ("x", "y")]
    return positions(s, d).select("map_id", "id", *at).groupBy("map_id", "x", "y").agg(F.min("id").alias("node"), (count() - 1).alias("refused"))


@query(f"""
SELECT id, CAST(floor(32 - x / 0.05) AS INTEGER) AS grid, round((32 - floor(32 - x / 0.05)) * 0.05, 4) AS corner, round(CASE WHEN atan2(y, x) < 0 THEN atan2(y, x) + 2 * pi() ELSE atan2(y, x) END, 5) AS angle FROM ({POSITIONS})""")
def grids_and_angles(s: SparkSession, d: str) -> DataFrame:
    """Grid cells and back, directions from 0 up to 2 pi."""
    grid = spatial.grid_id(F.col("x"), 32.0, 0.05)
    return positions(s, d).select("id", grid.alias("grid"), F.round(spatial.grid_corner(grid, 32.0, 0.05), 4).alias("corner"), F.round(spatial.angle(F.col("x"), F.col("y")), 5).alias("angle"))


@query("""
WITH t AS (SELECT s_nationkey AS a, (s_nationkey + 7) % 25 AS b, min(s_acctbal + 1000) AS len FROM supplier GROUP BY ALL), c AS (SELECT c_custkey, c_nationkey AS na, (c_nationkey * 3 + 1) % 25 AS nb, abs(c_acctbal) AS x FROM customer)
SELECT c_custkey, round(least(200000, coalesce(min(x + len + x / 2), 200000)), 3) AS dist FROM c LEFT JOIN t ON t.a = na AND t.b = nb GROUP BY 1""")
def cross_map_distance(s: SparkSession, d: str) -> DataFrame:
    """The way to a transfer, the transfer and the way from it, the least over the transfers that join the two maps; 200000 without one."""
    transfers = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("na"), ((F.col("s_nationkey") + 7) % 25).alias("nb")).agg(F.min(F.col("s_acctbal") + 1000).alias("len"))
    rows = table(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("na"), ((F.col("c_nationkey") * 3 + 1) % 25).alias("nb"), F.abs("c_acctbal").alias("x"))
    legs = F.min(F.col("x") + F.col("len") + F.col("x") / 2)
    return rows.join(transfers, ["na", "nb"], "left").groupBy("c_custkey").agg(F.round(F.least(F.lit(200000.0), F.coalesce(legs, F.lit(200000.0))), 3).alias("dist"))
