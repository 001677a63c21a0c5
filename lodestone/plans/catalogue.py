"""The named queries over the driver's tables, each with the SQL that gives the same rows.

Positions are the first three dimensions of an embedding with its label as map; the graph is the flow of volume from
supplier nations to customer nations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import folds, graph, ranges, relational, scoring, sequences, spatial
from lodestone.session import checkpointed
from lodestone.sources.tables import load_values, save_values, table
from lodestone.streaming import replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def count() -> Column:
    return F.count(F.lit(1))


def total(column: Column | str, alias: str, digits: int = 2) -> Column:
    return F.round(F.sum(column), digits).alias(alias)


def seconds(a: str, b: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, {a}, {b})")


def positions(s: SparkSession, d: str) -> DataFrame:
    at = lambda i: F.round(F.col("embedding")[i].cast("double"), 6)
    return table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("map_id"), at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))


POSITIONS = "SELECT vec_id AS id, label AS map_id, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y, round(embedding[3]::DOUBLE, 6) AS z FROM embeddings"


# relational


@query("""
WITH m AS (SELECT max(ts) AS now FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM r, m
WHERE n = 1 AND NOT (user_id % 3 > 0 AND datesub('second', ts, now) >= user_id % 3 * 86400 AND event_type <> 'purchase') GROUP BY event_type""")
def latest_valid_events(s: SparkSession, d: str) -> DataFrame:
    """The newest event per user and type, without the expired ones; purchases never expire."""
    events = table(s, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    newest = relational.latest(events, ["user_id", "event_type"], F.desc("ts"), F.desc("event_id"))
    aged = newest.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now"))))
    ok = relational.unexpired(seconds("ts", "now"), F.col("user_id") % 3 * 86400, F.col("event_type") == "purchase")
    return aged.filter(ok).groupBy("event_type").agg(count().alias("n"), total("value", "total"))


@query("""
WITH m AS (SELECT max(ts) AS now FROM events)
SELECT event_type, round(sum(CASE WHEN datesub('second', ts, now) >= user_id % 4 * 86400 THEN 0 ELSE value END), 2) AS live FROM events, m GROUP BY event_type""")
def task_value_expiry(s: SparkSession, d: str) -> DataFrame:
    """F16: values count 0 once their lifetime is over, a lifetime of 0 at once."""
    events = table(s, d, "events").select("ts", "user_id", "event_type", "value")
    aged = events.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now"))))
    return aged.groupBy("event_type").agg(total(relational.task_value(F.col("value"), seconds("ts", "now"), F.col("user_id") % 4 * 86400), "live"))


@query("""
WITH a AS (SELECT l_partkey, l_suppkey % 7 AS grp, l_returnflag AS kind, CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE l_discount * 100 END AS chance FROM lineitem),
g AS (SELECT *, greatest(0, 100 - sum(chance) OVER w) AS rest, count(*) FILTER (WHERE chance = 0) OVER w AS zero FROM a WINDOW w AS (PARTITION BY l_partkey, kind, grp)),
v AS (SELECT l_partkey, kind, avg(CASE WHEN chance = 0 THEN rest / zero ELSE chance END) AS rarity FROM g GROUP BY ALL)
SELECT l_partkey, round(max(rarity), 4) AS rarity FROM v GROUP BY l_partkey HAVING max(rarity) > 0.01""")
def rarity_residual_max(s: SparkSession, d: str) -> DataFrame:
    """An unset chance is an equal part of what its group leaves of 100; the mean per kind, the largest mean per part."""
    kind = F.col("l_returnflag").alias("kind")
    lines = table(s, d, "lineitem").select("l_partkey", (F.col("l_suppkey") % 7).alias("grp"), kind, F.when(F.col("l_linenumber") % 3 == 0, 0.0).otherwise(F.col("l_discount") * 100).alias("chance"))
    w = Window.partitionBy("l_partkey", "kind", "grp")
    rest = F.greatest(F.lit(0.0), 100 - F.sum("chance").over(w)) / F.count(F.when(F.col("chance") == 0, 1)).over(w)
    means = lines.withColumn("c", F.when(F.col("chance") == 0, rest).otherwise(F.col("chance"))).groupBy("l_partkey", "kind").agg(F.avg("c").alias("rarity"))
    return means.groupBy("l_partkey").agg(F.max("rarity").alias("_r")).filter("_r > 0.01").select("l_partkey", F.round("_r", 4).alias("rarity"))


@query("""
WITH alive AS (SELECT * FROM customer c WHERE EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey < 4) AND c_acctbal > 0),
o AS (SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM alive WHERE c_custkey = o_custkey))
SELECT o.o_orderstatus, count(DISTINCT o.o_orderkey) AS orders_left, count(l_orderkey) AS lines_left FROM o LEFT JOIN lineitem ON l_orderkey = o.o_orderkey GROUP BY 1""")
def orphan_cascade(s: SparkSession, d: str) -> DataFrame:
    """What stays of orders and lines when customers and, with them, everything below them are deleted."""
    nations = relational.delete_where(table(s, d, "nation"), F.col("n_regionkey") >= 4)
    alive = relational.having_parent(table(s, d, "customer").filter("c_acctbal > 0"), nations, "c_nationkey", "n_nationkey")
    orders = relational.having_parent(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), alive, "o_custkey", "c_custkey")
    lines = table(s, d, "lineitem").groupBy("l_orderkey").agg(count().alias("lines"))
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").groupBy("o_orderstatus").agg(F.countDistinct("o_orderkey").alias("orders_left"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_left"))


@query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def unused_names_anti(s: SparkSession, d: str) -> DataFrame:
    """Parts without a large line."""
    return relational.orphans(table(s, d, "part").select("p_partkey", "p_name"), table(s, d, "lineitem").filter("l_quantity > 45"), "p_partkey", "l_partkey")


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_name LIKE 'Customer#00000%')")
def semi_prefix_delete(s: SparkSession, d: str) -> DataFrame:
    """Orders of customers by a name prefix."""
    named = table(s, d, "customer").filter(F.col("c_name").startswith("Customer#00000"))
    return relational.having_parent(table(s, d, "orders").select("o_orderkey", "o_custkey"), named, "o_custkey", "c_custkey").agg(count().alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""
WITH t AS (SELECT source, lang, max(doc_id) AS top FROM documents GROUP BY ALL)
SELECT d.source, count(*) AS kept_by_group, count(*) FILTER (WHERE d.doc_id = (SELECT max(doc_id) FROM documents x WHERE x.source = d.source)) AS kept_by_subject
FROM documents d JOIN t ON d.source = t.source AND d.lang = t.lang AND d.doc_id = t.top GROUP BY d.source""")
def dedupe_keep_max(s: SparkSession, d: str) -> DataFrame:
    """The largest id of each source and language; and whether it is the source's largest."""
    docs = table(s, d, "documents").select("source", "lang", "doc_id")
    kept = relational.keep_max_of_group(docs, "source", ["lang"], "doc_id")
    tops = docs.groupBy("source").agg(F.max("doc_id").alias("top"))
    return kept.join(tops, "source").groupBy("source").agg(count().alias("kept_by_group"), F.count_if(F.col("doc_id") == F.col("top")).alias("kept_by_subject"))


@query("""
WITH p AS (SELECT p_brand, p_size, max(p_partkey) AS best FROM part GROUP BY ALL), r AS (SELECT p_partkey, p_brand, p_size + 3 AS want FROM part)
SELECT p_partkey, max(best ORDER BY p.p_size) AS best, max(p.p_size) AS found_level FROM (SELECT r.p_partkey, p.best, p.p_size FROM r JOIN p ON p.p_brand = r.p_brand AND p.p_size BETWEEN want - 5 AND want
QUALIFY row_number() OVER (PARTITION BY r.p_partkey ORDER BY p.p_size DESC) = 1) p GROUP BY 1""".replace("max(best ORDER BY p.p_size)", "max(best)"))
def best_in_slot(s: SparkSession, d: str) -> DataFrame:
    """To each wanted size of a brand the best part of the nearest size at or below, at most 5 lower."""
    parts = table(s, d, "part")
    levels = parts.groupBy("p_brand", "p_size").agg(F.max("p_partkey").alias("best"))
    wanted = parts.select("p_partkey", "p_brand", (F.col("p_size") + 3).alias("want"))
    return relational.asof_floor(wanted, levels, ["p_brand"], "want", "p_size", 5, "best").select("p_partkey", "best", "found_level")


@query("""
WITH t AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0), r AS (SELECT c_custkey, c_nationkey, round(c_acctbal + 1, 2) AS c_acctbal FROM customer WHERE c_custkey % 3 = 0),
i AS (SELECT * FROM t UNION ALL SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = r.c_custkey)), p AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE t.c_custkey = r.c_custkey) UNION ALL SELECT * FROM r)
SELECT 'ignore' AS how, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM i UNION ALL SELECT 'replace', count(*), round(sum(c_acctbal), 2) FROM p""")
def insert_and_replace(s: SparkSession, d: str) -> DataFrame:
    """M1 to M3: rows added where their key is new, and rows put in the place of old ones."""
    all_ = table(s, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    old, new = all_.filter("c_custkey % 2 = 0"), all_.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.round(F.col("c_acctbal") + 1, 2))
    both = [("ignore", relational.insert_ignore(old, new, ["c_custkey"])), ("replace", relational.replace_into(old, new, ["c_custkey"]))]
    a, b = (t.agg(F.lit(how).alias("how"), count().alias("n"), total("c_acctbal", "total")) for how, t in both)
    return a.unionByName(b)


@query("""
SELECT c_mktsegment, round(sum(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END), 2) AS total, count(*) AS n FROM customer WHERE NOT (coalesce(c_nationkey, -1) IN (1, 2, 3)) GROUP BY 1""")
def update_delete(s: SparkSession, d: str) -> DataFrame:
    """M4, M5, F12."""
    rows = relational.delete_where(table(s, d, "customer"), F.col("c_nationkey").isin(1, 2, 3))
    return relational.update_where(rows, F.col("c_acctbal") < 0, c_acctbal=F.lit(0.0)).groupBy("c_mktsegment").agg(total("c_acctbal", "total"), count().alias("n"))


@query("""
SELECT p_brand, coalesce(max(o.size2), max(p.p_size)) AS low FROM part p LEFT JOIN (SELECT p_partkey AS k, p_size * 2 AS size2 FROM part WHERE p_partkey % 10 = 0) o ON o.k = p.p_partkey GROUP BY 1""")
def bracket_override(s: SparkSession, d: str) -> DataFrame:
    """Defaults, overridden where there is an override."""
    parts = table(s, d, "part").select("p_partkey", "p_brand", "p_size")
    own = relational.coalesced_patch(parts.withColumn("patched", F.lit(None).cast("int")), parts.filter("p_partkey % 10 = 0").select("p_partkey", (F.col("p_size") * 2).alias("patched")), "p_partkey", "patched")
    return own.groupBy("p_brand").agg(F.coalesce(F.max("patched"), F.max("p_size")).alias("low"))


@query("""
WITH k AS (SELECT user_id, max(CASE WHEN event_type = 'click' THEN value::BIGINT END) AS click, max(CASE WHEN event_type = 'view' THEN value::BIGINT END) AS view FROM (SELECT user_id, event_type, floor(value) AS value FROM events) GROUP BY 1)
SELECT k2 AS key, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (SELECT 'click' AS k2, click AS v FROM k UNION ALL SELECT 'view', view FROM k) WHERE v IS NOT NULL GROUP BY 1""")
def key_value_store(s: SparkSession, d: str) -> DataFrame:
    """Rows to columns by key and back."""
    rows = table(s, d, "events").select("user_id", "event_type", F.floor("value").cast("long").alias("v"))
    wide = load_values(rows, "user_id", "event_type", "v", ["click", "view"])
    return save_values(wide, "user_id", ["click", "view"]).groupBy("key").agg(count().alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


# aggregates and windows


@query("""
SELECT 'nation' AS metric, n_name AS name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 2
UNION ALL SELECT 'segment', c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 2
UNION ALL SELECT 'sign', CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 2""")
def population_report(s: SparkSession, d: str) -> DataFrame:
    """One pass, three groupings."""
    rows = table(s, d, "customer").join(table(s, d, "nation").select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    facets = F.array(*[F.struct(F.lit(m).alias("metric"), c.alias("name")) for m, c in (("nation", F.col("n_name")), ("segment", F.col("c_mktsegment")), ("sign", F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit")))])
    return rows.select(F.explode(facets).alias("f"), "c_acctbal").filter("f.name IS NOT NULL").groupBy("f.metric", "f.name").agg(count().alias("n"), total("c_acctbal", "total"))


@query("""
SELECT event_type, user_id % 10 AS bucket, min(CASE WHEN value > 0 THEN value END) AS low, max(value) AS high, round(sum(value), 2) AS total, count(*) AS n, round(avg(value), 4) AS mean,
  round(100 * sum(value) / (SELECT sum(value) FROM events), 4) AS percent, CAST(grouping(user_id % 10) AS INTEGER) AS subtotal FROM events GROUP BY GROUPING SETS ((event_type, user_id % 10), (event_type))""")
def profiler_report(s: SparkSession, d: str) -> DataFrame:
    """Figures per key, their share of the whole, and a subtotal per type; 0 never is the minimum."""
    rows = table(s, d, "events").select("event_type", (F.col("user_id") % 10).alias("bucket"), "value")
    figures = rows.groupingSets([[F.col("event_type"), F.col("bucket")], [F.col("event_type")]], F.col("event_type"), F.col("bucket")).agg(F.min(F.when(F.col("value") > 0, F.col("value"))).alias("low"), F.max("value").alias("high"), total("value", "total"), count().alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.sum("value").alias("_s"), F.grouping("bucket").cast("int").alias("subtotal"))
    whole = F.broadcast(rows.agg(F.sum("value").alias("_t")))
    return figures.crossJoin(whole).withColumn("percent", F.round(100 * F.col("_s") / F.col("_t"), 4)).drop("_s", "_t")


@query("SELECT p_brand, p_partkey, round(sum(p_retailprice) OVER w, 2) AS needed, round(greatest(0, 20000 - sum(p_retailprice) OVER w + p_retailprice), 2) AS free FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size, p_partkey)")
def prefix_budget(s: SparkSession, d: str) -> DataFrame:
    """Own cost and that of all earlier priorities; what those leave of the budget."""
    parts = table(s, d, "part").select("p_brand", "p_partkey", "p_size", "p_retailprice")
    rows = sequences.running(parts, ["p_brand"], F.col("p_size"), ["p_size", "p_partkey"], F.col("p_retailprice"), "run")
    return rows.withColumn("run", F.col("run") + F.col("p_retailprice")).select("p_brand", "p_partkey", F.round("run", 2).alias("needed"), F.round(F.greatest(F.lit(0.0), 20000 - F.col("run") + F.col("p_retailprice")), 2).alias("free"))


@query("""
WITH w AS (SELECT p_brand, p_partkey, p_size, coalesce(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM part)
SELECT p_brand, p_partkey, CAST(least(p_size, greatest(0, 300 - before)) AS BIGINT) AS kept, before < p_size * 5 AS gated FROM w""")
def budget_crop(s: SparkSession, d: str) -> DataFrame:
    """Ranks lowered where the running total passes the budget; a row is gated by the points before it."""
    rows = sequences.running(table(s, d, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], F.floor(F.col("p_partkey") / 1000), ["p_partkey"], F.col("p_size"), "before")
    return rows.select("p_brand", "p_partkey", F.least(F.col("p_size").cast("long"), F.greatest(F.lit(0).cast("long"), 300 - F.col("before"))).alias("kept"), (F.col("before") < F.col("p_size") * 5).alias("gated"))


@query("SELECT l_suppkey, round(sum(p_retailprice), 2) AS cost, count(*) AS parts FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey GROUP BY 1")
def sum_distinct_cost(s: SparkSession, d: str) -> DataFrame:
    """Each supplier's distinct parts and their cost."""
    used = table(s, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return used.join(table(s, d, "part").select("p_partkey", "p_retailprice"), F.col("p_partkey") == F.col("l_partkey")).groupBy("l_suppkey").agg(total("p_retailprice", "cost"), count().alias("parts"))


@query("""
WITH w AS (SELECT l_suppkey, CASE WHEN l_linenumber = 1 AND l_quantity > 45 THEN 2 ELSE 1 END AS hands, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS n FROM lineitem)
SELECT l_suppkey, round(sum(l_extendedprice * hands) / 10, 4) AS mean10 FROM w WHERE n <= 10 GROUP BY 1""")
def topn_avg(s: SparkSession, d: str) -> DataFrame:
    """The ten largest by ten, also where there are fewer; what takes both hands counts for both."""
    order = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    hands = F.when((F.col("l_linenumber") == 1) & (F.col("l_quantity") > 45), 2).otherwise(1)
    ranked = table(s, d, "lineitem").select("l_suppkey", (F.col("l_extendedprice") * hands).alias("v"), F.row_number().over(order).alias("n"))
    return ranked.filter("n <= 10").groupBy("l_suppkey").agg(F.round(F.sum("v") / 10, 4).alias("mean10"))


@query("""
SELECT p_type, round(sum(CASE WHEN p_size <= 10 THEN p_size * 1.0 WHEN p_size <= 30 THEN p_size * 2.5 ELSE p_size * 4.0 END * least(4, greatest(0.75, p_retailprice / 1000))), 2) AS power,
  CASE WHEN count(*) >= 25 THEN 1.2 ELSE 1.0 END::DOUBLE AS bonus FROM part GROUP BY 1""")
def piecewise_power(s: SparkSession, d: str) -> DataFrame:
    """Piecewise by size, clamped ratio, bonus for large groups."""
    size = F.col("p_size")
    power = size * scoring.ladder(size, [(10, 1.0), (30, 2.5)], 4.0) * F.least(F.lit(4.0), F.greatest(F.lit(0.75), F.col("p_retailprice") / 1000))
    return table(s, d, "part").groupBy("p_type").agg(total(power, "power"), F.when(count() >= 25, 1.2).otherwise(1.0).alias("bonus"))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey FROM orders), l AS (SELECT o_custkey, sum(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END * l_quantity) AS weight, avg(l_quantity) AS mean, count(*) AS n FROM lineitem JOIN o ON o_orderkey = l_orderkey GROUP BY 1)
SELECT o_custkey, CAST(least(200, floor(round(100 * weight / (mean * least(n, 10)), 6))) AS BIGINT) AS percent FROM l""")
def balance_percent(s: SparkSession, d: str) -> DataFrame:
    """Weighted sum against the mean of at most ten, in whole percent, at most 200."""
    joined = table(s, d, "lineitem").join(table(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    agg = joined.groupBy("o_custkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 2).otherwise(1) * F.col("l_quantity")).alias("w"), F.avg("l_quantity").alias("m"), count().alias("n"))
    return agg.select("o_custkey", F.least(F.lit(200).cast("long"), F.floor(F.round(100 * F.col("w") / (F.col("m") * F.least(F.col("n"), F.lit(10))), 6))).alias("percent"))


@query("""
WITH t AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS tank, max(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS other FROM lineitem GROUP BY 1)
SELECT CASE WHEN tank IS NULL THEN 'none' WHEN other IS NULL OR other / tank < 0.5 THEN 'low' WHEN other / tank < 1 THEN 'high' ELSE 'over' END AS threat, count(*) AS n FROM t GROUP BY 1""")
def threat_ratio(s: SparkSession, d: str) -> DataFrame:
    """The largest of one role against the largest of the rest, as a ladder."""
    role = F.col("l_returnflag") == "R"
    t = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.max(F.when(role, F.col("l_quantity"))).alias("tank"), F.max(F.when(~role, F.col("l_quantity"))).alias("other"))
    ratio = F.col("other") / F.col("tank")
    return t.groupBy(F.when(F.col("tank").isNull(), "none").when(F.col("other").isNull() | (ratio < 0.5), "low").when(ratio < 1, "high").otherwise("over").alias("threat")).agg(count().alias("n"))


@query("SELECT l_orderkey, bool_and(l_quantity > 5) AS all_large, bool_or(l_discount > 0.09) AS any_cheap, count(*) FILTER (WHERE l_quantity > 25 AND l_discount < 0.05) AS both_hold FROM lineitem GROUP BY 1")
def bool_group(s: SparkSession, d: str) -> DataFrame:
    """All, any, and a true count."""
    return table(s, d, "lineitem").groupBy("l_orderkey").agg(F.bool_and(F.col("l_quantity") > 5).alias("all_large"), F.bool_or(F.col("l_discount") > 0.09).alias("any_cheap"), F.count_if(scoring.all_of([F.col("l_quantity") > 25, F.col("l_discount") < 0.05])).alias("both_hold"))


@query("""
SELECT p_brand, s_nationkey, CAST(bit_or(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 4 END | CASE l_linestatus WHEN 'O' THEN 8 ELSE 16 END) AS INTEGER) AS flags, count(DISTINCT l_orderkey) AS orders
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""")
def relation_flags(s: SparkSession, d: str) -> DataFrame:
    """Flags of all relations of a pair, or-ed."""
    flag = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(4).bitwiseOR(F.when(F.col("l_linestatus") == "O", 8).otherwise(16))
    joined = table(s, d, "lineitem").join(table(s, d, "part"), F.col("p_partkey") == F.col("l_partkey")).join(table(s, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    return joined.groupBy("p_brand", "s_nationkey").agg(F.bit_or(flag).cast("int").alias("flags"), F.countDistinct("l_orderkey").alias("orders"))


@query("SELECT source, arg_max(lang, n * 1000 - rank) AS lang, max(n) AS votes FROM (SELECT source, lang, count(*) AS n, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS rank FROM documents GROUP BY ALL) GROUP BY 1")
def locale_vote(s: SparkSession, d: str) -> DataFrame:
    """The language with most votes, the lowest index among equals."""
    index = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).when(F.col("lang") == "fr", 2).otherwise(3)
    votes = table(s, d, "documents").groupBy("source", "lang").agg(count().alias("n")).withColumn("r", -index)
    return votes.groupBy("source").agg(F.max_by("lang", F.struct("n", "r")).alias("lang"), F.max("n").alias("votes"))


@query("""
SELECT user_id % 5 AS queue, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'view') AS views, count(DISTINCT user_id) AS instances,
  CASE WHEN max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 0 AND count(DISTINCT user_id) < 3 THEN 1 ELSE 0 END AS top_up FROM events GROUP BY 1""")
def queue_census(s: SparkSession, d: str) -> DataFrame:
    """Counts by kind, instances, and a top-up."""
    kind = lambda k: F.count_if(F.col("event_type") == k)
    users = F.countDistinct("user_id")
    return table(s, d, "events").groupBy((F.col("user_id") % 5).alias("queue")).agg(kind("click").alias("clicks"), kind("view").alias("views"), users.alias("instances"), F.when((kind("purchase") == 0) & (users < 3), 1).otherwise(0).alias("top_up"))


@query("""
WITH m AS (SELECT max(p_size) AS top, greatest(1, (max(p_size) + 4) // 8) AS step FROM part), x AS (SELECT p_size // step * step AS lo, p_partkey % 2 AS side, top, step FROM part, m WHERE p_size >= 1)
SELECT CAST(greatest(1, lo) AS INTEGER) AS low, CAST(least(max(top), lo + max(step) - 1) AS INTEGER) AS high, count(*) FILTER (WHERE side = 0) AS one, count(*) FILTER (WHERE side = 1) AS other FROM x GROUP BY lo""")
def level_histogram(s: SparkSession, d: str) -> DataFrame:
    """Counts of two sides by steps of max(1, (top + 4) div 8), which end where level + 1 is a multiple of the step."""
    return ranges.histogram(table(s, d, "part"), "p_size", {"one": F.col("p_partkey") % 2 == 0, "other": F.col("p_partkey") % 2 == 1})


@query("""
WITH b AS (SELECT p_brand, min(p_size) AS lo, min(p_size) + 5 AS hi FROM part GROUP BY 1), x AS (SELECT p_brand, unnest(range(lo, hi + 1)) AS level FROM b)
SELECT p.p_partkey, count(*) AS brackets FROM part p JOIN x ON x.level = p.p_size GROUP BY 1""")
def level_range_expand(s: SparkSession, d: str) -> DataFrame:
    """Brackets expanded to levels, then an equi join."""
    parts = table(s, d, "part").select("p_partkey", "p_brand", "p_size")
    brackets = parts.groupBy("p_brand").agg(F.min("p_size").alias("lo"), (F.min("p_size") + 5).alias("hi"))
    return ranges.expanded(brackets, "lo", "hi", "level").join(parts.select("p_partkey", F.col("p_size").alias("level")), "level").groupBy("p_partkey").agg(count().alias("brackets"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders JOIN (SELECT s_suppkey, s_acctbal AS lo, s_acctbal + 500 AS hi FROM supplier) ON o_totalprice / 10 BETWEEN lo AND hi GROUP BY 1")
def price_brackets(s: SparkSession, d: str) -> DataFrame:
    """A range join by bins."""
    orders = table(s, d, "orders").select("o_orderpriority", (F.col("o_totalprice") / 10).alias("at"))
    brackets = table(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + 500).alias("hi"))
    return ranges.binned_range_join(orders, brackets, "at", "lo", "hi", 500.0).groupBy("o_orderpriority").agg(count().alias("n"))


# positions


@query(f"""
SELECT map_id, CAST(floor(avg(p_size)) AS INTEGER) AS low, CAST(floor(avg(p_size + p_partkey % 5)) AS INTEGER) AS high, count(*) AS n FROM ({POSITIONS}) JOIN part ON p_partkey = id + 1
WHERE abs(x) < 0.1 AND abs(y) < 0.1 AND p_size BETWEEN 5 AND 45 AND p_brand LIKE '%1' GROUP BY 1""")
def box_avg_level(s: SparkSession, d: str) -> DataFrame:
    """The pair of mean levels of what stands in a box, by a join with its templates."""
    templates = table(s, d, "part").filter(F.col("p_size").between(5, 45) & F.col("p_brand").endswith("1")).select((F.col("p_partkey") - 1).alias("id"), "p_size", (F.col("p_size") + F.col("p_partkey") % 5).alias("p_high"))
    inside = positions(s, d).filter((F.abs("x") < 0.1) & (F.abs("y") < 0.1)).join(templates, "id")
    return inside.groupBy("map_id").agg(F.floor(F.avg("p_size")).cast("int").alias("low"), F.floor(F.avg("p_high")).cast("int").alias("high"), count().alias("n"))


@query(f"WITH p AS ({POSITIONS}) SELECT a.map_id AS g, a.id AS a, b.id AS b FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0064")
def radius_neighbours(s: SparkSession, d: str) -> DataFrame:
    """Neighbours within 0.08 by a grid join."""
    return spatial.within(positions(s, d), "id", "map_id", 0.08).select("g", "a", "b")


@query(f"""
WITH p AS ({POSITIONS}), n AS (SELECT a.map_id AS g, a.id AS a, count(*) AS n FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0064 GROUP BY ALL)
SELECT g, a AS densest, n FROM n QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, a) = 1""")
def density_argmax(s: SparkSession, d: str) -> DataFrame:
    """The point with most neighbours, the first among equals."""
    n = spatial.within(positions(s, d), "id", "map_id", 0.08).groupBy("g", F.col("a").alias("densest")).agg(count().alias("n"))
    return scoring.best(n, ["g"], F.desc("n"), F.asc("densest"))


@query(f"""
WITH p AS ({POSITIONS}) SELECT a.id AS a, b.id AS b, CAST(row_number() OVER (PARTITION BY a.id ORDER BY round(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2), 6), b.id) AS INTEGER) AS rank
FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id QUALIFY rank <= 5""")
def knn5(s: SparkSession, d: str) -> DataFrame:
    """The five nearest of the map."""
    p = positions(s, d)
    return spatial.nearest(p, p, "id", "id", "map_id", 5).select("a", "b", "rank")


@query(f"SELECT map_id, CAST(floor(x / 0.05) AS INTEGER) AS cx, CAST(floor(y / 0.05) AS INTEGER) AS cy, count(*) AS n, min(id) AS head FROM ({POSITIONS}) GROUP BY ALL HAVING count(*) >= 2")
def grid_cells_having(s: SparkSession, d: str) -> DataFrame:
    """Cells with two points or more."""
    return positions(s, d).groupBy("map_id", spatial.cell("x", 0.05).alias("cx"), spatial.cell("y", 0.05).alias("cy")).agg(count().alias("n"), F.min("id").alias("head")).filter("n >= 2")


@query(f"""
WITH p AS ({POSITIONS}), c AS (SELECT map_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, count(*) AS n FROM p GROUP BY 1)
SELECT map_id, p.id AS medoid, n, round(mx, 4) AS mx, round(my, 4) AS my FROM p JOIN c USING (map_id) QUALIFY row_number() OVER (PARTITION BY map_id ORDER BY round(pow(x - mx, 2) + pow(y - my, 2) + pow(z - mz, 2), 6), p.id) = 1""")
def centroid_medoid(s: SparkSession, d: str) -> DataFrame:
    """A16, A17."""
    m = spatial.medoid(positions(s, d), ["map_id"], "id")
    return m.select("map_id", "medoid", "n", F.round("mx", 4).alias("mx"), F.round("my", 4).alias("my"))


@query("""
WITH s AS (SELECT user_id, event_id, abs(value - lag(value) OVER w) AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, round(sum(coalesce(step, 0)), 2) AS length, count(*) AS points FROM s GROUP BY 1""")
def path_running_distance(s: SparkSession, d: str) -> DataFrame:
    """The length of each user's path of values."""
    return spatial.steps(table(s, d, "events"), "user_id", "event_id", "value").groupBy("user_id").agg(total("step", "length"), count().alias("points"))


@query("SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS day, concat('LINESTRING(', string_agg(concat(event_id, ' ', user_id), ',' ORDER BY event_id), ')') AS wkt FROM events GROUP BY ALL")
def wkt_paths(s: SparkSession, d: str) -> DataFrame:
    """Each user's path of a day as text."""
    rows = table(s, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("x"), F.col("user_id").alias("y")))).alias("p"))
    return rows.select("user_id", "day", spatial.wkt_line(F.col("p")).alias("wkt"))


@query(f"""
WITH p AS ({POSITIONS}), f AS (SELECT DISTINCT map_id, x + 0.1 * r * cos(a * pi() / 4) AS fx, y + 0.1 * r * sin(a * pi() / 4) AS fy FROM p, range(0, 8) t(a), range(1, 3) u(r)),
g AS (SELECT f.map_id, fx, fy, min(sqrt(pow(fx - p.x, 2) + pow(fy - p.y, 2))) AS gap, sum(sqrt(pow(fx - p.x, 2) + pow(fy - p.y, 2))) AS away FROM f JOIN p ON p.map_id = f.map_id GROUP BY ALL)
SELECT map_id, round(max(away), 4) AS away FROM g WHERE gap > 0.02 GROUP BY 1""")
def flee_grid(s: SparkSession, d: str) -> DataFrame:
    """R11, the cross join of places and points: of the polar grids of all points the places not too near to any point; the largest sum of distances to all of them."""
    return spatial.farthest_flight(positions(s, d), "map_id").select("map_id", F.round("away", 4).alias("away"))


# scores and rules


@query("SELECT p_partkey, round(least(p_size, greatest(0, (40 - p_partkey % 30) / 0.5)) * 1.5 + p_retailprice * 0.01 + CASE WHEN p_brand LIKE '%1' THEN 5 ELSE 0 END, 4) AS score FROM part")
def stat_dot_score(s: SparkSession, d: str) -> DataFrame:
    """Weighted sum of capped stats and a bonus."""
    size = scoring.capped(F.col("p_size").cast("double"), (F.col("p_partkey") % 30).cast("double"), 40.0, 0.5)
    rows = table(s, d, "part").withColumn("size", size).withColumn("bonus", F.when(F.col("p_brand").endswith("1"), 5.0).otherwise(0.0))
    return rows.select("p_partkey", F.round(scoring.dot({"size": 1.5, "p_retailprice": 0.01, "bonus": 1.0}), 4).alias("score"))


@query("SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY round(c_acctbal / 100 + CASE WHEN c_custkey % 4 = 0 THEN 30 ELSE c_custkey % 40 / 10 END, 4), c_custkey DESC) = 1")
def heal_priority(s: SparkSession, d: str) -> DataFrame:
    """The lowest score of each group; the last among equals."""
    score = F.round(F.col("c_acctbal") / 100 + F.when(F.col("c_custkey") % 4 == 0, 30.0).otherwise(F.col("c_custkey") % 40 / 10), 4)
    return scoring.best(table(s, d, "customer").withColumn("score", score), ["c_nationkey"], F.asc("score"), F.desc("c_custkey")).select("c_nationkey", "c_custkey")


@query("""
SELECT s_nationkey, s_suppkey FROM (SELECT *, CASE WHEN s_acctbal BETWEEN 500 AND 3000 THEN 2 WHEN s_acctbal < 500 THEN 1 ELSE 0 END + CASE WHEN s_suppkey % 2 = 0 THEN 10 ELSE 0 END AS level FROM supplier)
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY level DESC, CASE WHEN level % 10 = 2 THEN s_acctbal ELSE -s_acctbal END, s_suppkey) = 1""")
def target_class_rank(s: SparkSession, d: str) -> DataFrame:
    """Classes first, then an order that differs by class."""
    bal = F.col("s_acctbal")
    level = F.when(bal.between(500, 3000), 2).when(bal < 500, 1).otherwise(0) + F.when(F.col("s_suppkey") % 2 == 0, 10).otherwise(0)
    rows = table(s, d, "supplier").withColumn("level", level)
    return scoring.best(rows, ["s_nationkey"], F.desc("level"), F.when(F.col("level") % 10 == 2, bal).otherwise(-bal), F.col("s_suppkey")).select("s_nationkey", "s_suppkey")


RULES = [("click", "attack", 10.0), ("click", "flee", 9.5), ("view", "look", 5.0), ("purchase", "loot", 20.0), ("signup", "greet", 7.0)]


@query("""
WITH r(event_type, act, rel) AS (VALUES ('click', 'attack', 10.0::DOUBLE), ('click', 'flee', 9.5), ('view', 'look', 5.0), ('purchase', 'loot', 20.0), ('signup', 'greet', 7.0)),
c AS (SELECT user_id, act, max(rel * CASE WHEN value < 1 THEN 0 ELSE 1 + value / 1000 END) AS rel, min(event_id) AS first FROM events JOIN r USING (event_type) WHERE value >= 1 GROUP BY ALL)
SELECT user_id, act FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(rel, 6) DESC, first, act) = 1""")
def rule_argmax(s: SparkSession, d: str) -> DataFrame:
    """Rules fire, relevances are multiplied and dropped at 0, actions keep their largest, the best wins."""
    rules = s.createDataFrame(RULES, "event_type string, act string, rel double")
    fired = table(s, d, "events").join(F.broadcast(rules), "event_type")
    fired = fired.withColumn("r", scoring.product([F.col("rel"), F.when(F.col("value") < 1, 0.0).otherwise(1 + F.col("value") / 1000)])).filter("r IS NOT NULL")
    kept = fired.groupBy("user_id", "act").agg(F.max("r").alias("r"), F.min("event_id").alias("first"))
    return scoring.best(kept, ["user_id"], F.round("r", 6).desc(), F.asc("first"), F.asc("act")).select("user_id", "act")


@query("""
WITH r AS (SELECT c_custkey, c_acctbal, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer),
a AS (SELECT c_custkey, 1 AS phase FROM r WHERE r <= 3), b AS (SELECT c_custkey, 2 AS phase FROM r WHERE r > 3 AND c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 10),
c AS (SELECT c_custkey, 3 AS phase FROM r WHERE c_custkey NOT IN (SELECT c_custkey FROM a UNION ALL SELECT c_custkey FROM b) ORDER BY c_acctbal DESC, c_custkey LIMIT 40 - (SELECT count(*) FROM a) - (SELECT count(*) FROM b))
SELECT c_custkey, CAST(phase AS INTEGER) AS phase FROM a UNION ALL SELECT c_custkey, CAST(phase AS INTEGER) FROM b UNION ALL SELECT c_custkey, CAST(phase AS INTEGER) FROM c""")
def quota_phases(s: SparkSession, d: str) -> DataFrame:
    """Three of each segment, then ten more of one, then the best others, 40 in all (a top-k report)."""
    rows = table(s, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return scoring.phases(rows, "c_custkey", "c_mktsegment", 3, ("BUILDING", 10), 40, F.desc("c_acctbal"), F.asc("c_custkey")).select("c_custkey", "phase")


@query("SELECT c_custkey % 500 AS bucket, count(*) AS n, CAST(min(c_custkey) AS BIGINT) AS head FROM customer GROUP BY 1")
def hash_sample(s: SparkSession, d: str) -> DataFrame:
    """Deterministic buckets of keys."""
    return table(s, d, "customer").groupBy(F.pmod("c_custkey", F.lit(500)).alias("bucket")).agg(count().alias("n"), F.min("c_custkey").alias("head"))


@query("SELECT c_custkey, sha256(c_name) AS key FROM customer")
def sha_key(s: SparkSession, d: str) -> DataFrame:
    """X29."""
    return table(s, d, "customer").select("c_custkey", F.sha2("c_name", 256).alias("key"))


@query("""
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY -ln((CAST(('0x' || substr(md5('11:' || c_custkey), 1, 8)) AS BIGINT) + 1) / 4294967297.0) / c_acctbal, c_custkey LIMIT 100""")
def weighted_shuffle(s: SparkSession, d: str) -> DataFrame:
    """Customers in a weighted random order, the first 100 (a sampling operator); rolls are hashes of the key, so runs agree."""
    order = scoring.weighted_order(F.col("c_acctbal"), F.col("c_custkey"), 11)
    return table(s, d, "customer").filter("c_acctbal > 0").orderBy(order, "c_custkey").limit(100).select("c_custkey", "c_acctbal")


# text


@query("SELECT conv_id, turn, CASE WHEN lower(text) LIKE '%the%' AND role = 'user' THEN text WHEN text LIKE 'A%' THEN concat('a:', text) ELSE '' END AS kept FROM conversations WHERE CASE WHEN lower(text) LIKE '%the%' AND role = 'user' THEN text WHEN text LIKE 'A%' THEN concat('a:', text) ELSE '' END <> ''")
def chat_selectors(s: SparkSession, d: str) -> DataFrame:
    """Selectors that pass a message on or blank it."""
    kept = F.when(F.lower("text").contains("the") & (F.col("role") == "user"), F.col("text")).when(F.col("text").startswith("A"), F.concat(F.lit("a:"), "text")).otherwise("")
    return table(s, d, "conversations").withColumn("kept", kept).filter("kept <> ''").select("conv_id", "turn", "kept")


@query("""
WITH c(command) AS (VALUES ('the'), ('the and'), ('of'), ('and'), ('is'), ('The'), ('To'), ('And')), m AS (SELECT conv_id, turn, text, string_split(text, ' ') AS w FROM conversations),
x AS (SELECT conv_id, turn, text, n, array_to_string(w[1:n], ' ') AS command FROM m, range(1, 4) t(n) WHERE n <= len(w))
SELECT conv_id, turn, max(x.command) AS command FROM (SELECT x.* FROM x JOIN c ON c.command = x.command QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC) = 1) x GROUP BY ALL""")
def command_prefix(s: SparkSession, d: str) -> DataFrame:
    """The longest command a message begins with."""
    commands = s.createDataFrame([(c,) for c in ("the", "the and", "of", "and", "is", "The", "To", "And")], "command string")
    return X.routed(table(s, d, "conversations").select("conv_id", "turn", "text"), commands, "text", "command").select("conv_id", "turn", "command")


@query("""
WITH m AS (SELECT c_custkey, CAST(abs(floor(c_acctbal * 100)) AS BIGINT) AS c FROM customer), p AS (SELECT c_custkey, c, c // 10000 AS g, c // 100 % 100 AS s, c % 100 AS k FROM m),
t AS (SELECT *, concat_ws(' ', CASE WHEN g > 0 THEN g || 'g' END, CASE WHEN s > 0 AND g < 50 THEN s || 's' END, CASE WHEN k > 0 AND g < 10 THEN k || 'c' END) AS t FROM p)
SELECT c_custkey, CASE WHEN t = '' THEN '0c' ELSE t END AS money, CAST(CASE WHEN g > 0 THEN g * 10000 WHEN s > 0 THEN s * 100 ELSE k END AS BIGINT) AS first_part FROM t""")
def money_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Copper as text, and what is read back up to the first space."""
    rows = table(s, d, "customer").select("c_custkey", F.abs(F.floor(F.col("c_acctbal") * 100)).cast("long").alias("c")).withColumn("money", X.money(F.col("c")))
    return rows.select("c_custkey", "money", X.copper(F.col("money")).alias("first_part"))


@query("SELECT page_id, len(list_distinct(regexp_extract_all(html, 'href=\"/([^\"]*)\"', 1))) AS links, regexp_extract(url, '//([^/]*)/', 1) AS host FROM pages")
def link_extract(s: SparkSession, d: str) -> DataFrame:
    """Distinct links and the host of each page."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1)))
    return table(s, d, "pages").select("page_id", F.size(links).cast("long").alias("links"), F.regexp_extract("url", "//([^/]*)/", 1).alias("host"))


@query("SELECT doc_id, replace(replace('Dear %who, from %lang', '%lang', lang), '%who', source) AS filled FROM documents")
def template_fill(s: SparkSession, d: str) -> DataFrame:
    """X5, X7."""
    return table(s, d, "documents").select("doc_id", X.filled(F.lit("Dear %who, from %lang"), {"%lang": F.col("lang"), "%who": F.col("source")}).alias("filled"))


@query("""
SELECT doc_id, len(string_split(text, '.')) - CASE WHEN text LIKE '%.' OR text = '' THEN 1 ELSE 0 END AS inner_kept, len(list_filter(regexp_split_to_array(text, '[., \\n]'), lambda x: x <> '')) AS none_empty FROM documents""")
def split_semantics(s: SparkSession, d: str) -> DataFrame:
    """X1 to X3."""
    return table(s, d, "documents").select("doc_id", F.size(X.split_keep_inner(F.col("text"), ".")).cast("long").alias("inner_kept"), F.size(X.split_drop_empty(F.col("text"), "., \n")).cast("long").alias("none_empty"))


@query("SELECT c_mktsegment, CASE WHEN sign = '-' THEN 'off' ELSE 'on' END AS state, count(*) AS n FROM (SELECT c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS sign FROM customer) GROUP BY ALL")
def strategy_delta(s: SparkSession, d: str) -> DataFrame:
    """Signed names taken apart."""
    text = F.concat(F.when(F.col("c_custkey") % 2 == 0, "+").otherwise("-"), "c_mktsegment", F.lit(",?,plain"))
    rows = table(s, d, "customer").select(F.explode(X.deltas(text)).alias("x"))
    return rows.groupBy(F.col("x.name").alias("c_mktsegment"), F.when(F.col("x.sign") == "-", "off").otherwise("on").alias("state")).agg(count().alias("n"))


# graph

EDGES_SQL = """e AS (
  SELECT s_nationkey AS src, c_nationkey AS dst, round(1000000 / (1 + sum(l_quantity)), 4) AS cost
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey <> c_nationkey GROUP BY s_nationkey, c_nationkey)"""


def doubled(name: str, start: str, value: str, times: int = 5) -> str:
    """SQL tables name1 to name{times + 1}: the least sums of `value` over ways of up to 2 ** times edges."""
    steps = [f"{name}1 AS ({start})"]
    for i in range(1, times + 1):
        steps.append(f"{name}{i + 1} AS (SELECT src, dst, min({value}) AS {value} FROM (SELECT * FROM {name}{i} UNION ALL SELECT a.src, b.dst, a.{value} + b.{value} FROM {name}{i} a JOIN {name}{i} b ON a.dst = b.src WHERE a.src <> b.dst) GROUP BY ALL)")
    return ", ".join(steps)


def flows(s: SparkSession, d: str) -> DataFrame:
    flow = table(s, d, "lineitem").join(table(s, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(table(s, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    return flow.filter("s_nationkey <> c_nationkey").groupBy(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst")).agg(F.sum("l_quantity").alias("q"))


def all_edges(s: SparkSession, d: str) -> DataFrame:
    """The flow graph, its lineage cut, so that rounds don't read the tables again."""
    return checkpointed(flows(s, d).select("src", "dst", F.round(F.lit(1000000) / (1 + F.col("q")), 4).alias("cost")))


@query(f"WITH {EDGES_SQL}, {doubled('h', 'SELECT src, dst, 1 AS hops FROM e', 'hops')} SELECT src, dst, CAST(hops AS INTEGER) AS hops FROM h6")
def graph_closure(s: SparkSession, d: str) -> DataFrame:
    """What each node reaches, in any number of hops, and the fewest (25 nations: the SQL's 32 hops are enough)."""
    return graph.closure(all_edges(s, d))


UNDIRECTED_SQL = "u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"


@query(f"""
WITH RECURSIVE {EDGES_SQL}, {UNDIRECTED_SQL}, {doubled('h', 'SELECT src, dst, 1 AS hops FROM u', 'hops')},
r AS (SELECT src, dst, [src, dst] AS path FROM u UNION ALL SELECT r.src, u.dst, list_append(r.path, u.dst) FROM r JOIN u ON u.src = r.dst JOIN h6 ON h6.src = r.src AND h6.dst = u.dst AND h6.hops = len(r.path))
SELECT src, dst, array_to_string(path, '>') AS path FROM r QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY path) = 1""")
def graph_bfs_paths(s: SparkSession, d: str) -> DataFrame:
    """A shortest path between all pairs, of any length, undirected."""
    return graph.shortest_paths(graph.undirected(all_edges(s, d))).select("src", "dst", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


@query(f"WITH {EDGES_SQL}, {doubled('c', 'SELECT * FROM e', 'cost')} SELECT src, dst, round(cost, 2) AS cost FROM c6")
def graph_cheapest(s: SparkSession, d: str) -> DataFrame:
    """G9 without prices: the least cost with any number of edges."""
    return graph.cheapest(all_edges(s, d)).select("src", "dst", F.round("cost", 2).alias("cost"))


@query(f"""
WITH {EDGES_SQL}, t AS (SELECT src, dst, cost FROM e UNION ALL SELECT a.src, b.dst, a.cost + b.cost FROM e a JOIN e b ON a.dst = b.src WHERE a.src <> b.dst)
SELECT src, dst, round(least(200000, min(cost)), 2) AS cost FROM t GROUP BY ALL""")
def transfer_min(s: SparkSession, d: str) -> DataFrame:
    """Transfers and their two-step joins, the shortest of each pair."""
    return graph.transfers_closed(all_edges(s, d)).select("src", "dst", F.round(F.least(F.lit(200000.0), "cost"), 2).alias("cost"))


@query(f"""
WITH {EDGES_SQL}, r AS (SELECT path, unnest(range(1, 5)) AS k FROM (SELECT n_nationkey AS path FROM nation)), p AS (SELECT path, (path + k * (path % 3 + 1) - path % 3 - 1) % 25 AS src, (path + k * (path % 3 + 1)) % 25 AS dst FROM r)
SELECT path AS path_id, round(sum(cost), 4) AS cost FROM p JOIN e ON e.src = p.src AND e.dst = p.dst GROUP BY 1""")
def route_lengths(s: SparkSession, d: str) -> DataFrame:
    """The length of a route of five nodes from each nation, over all of its edges."""
    node = F.col("n_nationkey")
    route = table(s, d, "nation").select(F.col("n_nationkey").alias("path_id"), F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: ((node + k * (node % 3 + 1)) % 25).cast("int")).alias("path"))
    return graph.route_length(route, all_edges(s, d).withColumn("src", F.col("src").cast("int")).withColumn("dst", F.col("dst").cast("int"))).select("path_id", F.round("cost", 4).alias("cost"))


# state and streams


@query("""
WITH RECURSIVE v AS (SELECT user_id, CAST(floor(value) AS BIGINT) AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
f AS (SELECT user_id, n, v AS ema FROM v WHERE n = 1 UNION ALL SELECT v.user_id, v.n, (9 * f.ema + v.v) // 10 FROM f JOIN v ON v.user_id = f.user_id AND v.n = f.n + 1)
SELECT user_id, CAST(arg_max(ema, n) AS BIGINT) AS ema, CAST(max(n) AS BIGINT) AS n FROM f GROUP BY 1""")
def ema_fold(s: SparkSession, d: str) -> DataFrame:
    """Integer smoothing, truncated at each step."""
    return folds.smoothed(table(s, d, "events").select("user_id", "event_id", F.floor("value").cast("long").alias("v")), "user_id", "event_id", "v")


@query("""
WITH RECURSIVE v AS (SELECT user_id, 50 - value AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
f AS (SELECT user_id, 0::BIGINT AS n, 0.0::DOUBLE AS integral, 0.0::DOUBLE AS before, 0.0::DOUBLE AS out FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT user_id, n, CASE WHEN raw BETWEEN -100 AND 100 THEN integral + e ELSE integral END, e, least(100.0, greatest(-100.0, raw)) FROM (
    SELECT v.user_id, v.n, v.e, integral, 0.5 * v.e + 0.01 * (integral + v.e) + 0.1 * (v.e - before) AS raw FROM f JOIN v ON v.user_id = f.user_id AND v.n = f.n + 1))
SELECT user_id, round(arg_max(out, n), 6) AS out FROM f GROUP BY 1""")
def pid_control(s: SparkSession, d: str) -> DataFrame:
    """The last output of a controller per user, an ordered fold."""
    rows = table(s, d, "events").select("user_id", "event_id", (50 - F.col("value")).alias("error"))
    return folds.controlled(rows, "user_id", "event_id", "error", 0.5, 0.01, 0.1, -100.0, 100.0).select("user_id", F.round("out", 6).alias("out"))


@query("SELECT user_id, CAST(sum(CASE WHEN value <= 50 THEN 100 WHEN value >= 200 THEN 0 ELSE floor(100 - (value - 50) * 100 / 150) END) AS BIGINT) AS kept, count(*) FILTER (WHERE user_id % 201 < 100) AS active FROM events GROUP BY 1")
def queue_shed(s: SparkSession, d: str) -> DataFrame:
    """A linear shed factor between a floor and a ceiling."""
    v = F.col("value")
    share = F.when(v <= 50, 100).when(v >= 200, 0).otherwise(F.floor(100 - (v - 50) * 100 / 150))
    return table(s, d, "events").groupBy("user_id").agg(F.sum(share).cast("long").alias("kept"), F.count_if(F.col("user_id") % 201 < 100).alias("active"))


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def report_tumbling(s: SparkSession, d: str) -> DataFrame:
    """Counts per day."""
    return table(s, d, "events").groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("start"), "event_type").agg(count().alias("n"))


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stream_window_replay(s: SparkSession, d: str) -> DataFrame:
    """The same counts by a stream with a watermark, replayed to its end."""
    rows = replay.replayed(replay.windowed(replay.event_stream(s, d), "1 day", "1 day"), "complete")
    return rows.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def stream_ttl_replay(s: SparkSession, d: str) -> DataFrame:
    """K2: the newest value of each key, kept by a stream."""
    return replay.replayed(replay.last_values(replay.event_stream(s, d), "1 day"), "complete").select("user_id", "event_type", "value")
