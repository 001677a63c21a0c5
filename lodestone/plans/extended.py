"""More named queries: runs and histories, upgrades, deltas, gates, sets, seeds, figures and texts; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators import relational, sequences
from lodestone.plans.catalogue import count, query, total
from lodestone.sources.tables import table

ROLL = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT)"


@query("""
WITH c AS (SELECT *, coalesce(event_type IS DISTINCT FROM lag(event_type) OVER w, TRUE) OR row_number() OVER w = 1 AS changed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(changed::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM c)
SELECT event_id, changed, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS INTEGER) AS ordinal FROM r""")
def restart_ordinal(s: SparkSession, d: str) -> DataFrame:
    """W4, W6."""
    return sequences.runs(table(s, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], ["event_id"], "event_type").select("event_id", "changed", "ordinal")


@query("""
SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS history FROM (SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 10) GROUP BY 1""")
def bounded_history(s: SparkSession, d: str) -> DataFrame:
    """A history of ten is the feature."""
    kept = sequences.history(table(s, d, "events").select("user_id", "event_id"), ["user_id"], "event_id", "event_id")
    return kept.select("user_id", F.array_join(F.col("history").cast("array<string>"), ",").alias("history"))


@query("""
WITH w AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_extendedprice AS p FROM lineitem),
b AS (SELECT l_orderkey, arg_min(n, (p, n)) AS upto FROM w GROUP BY 1)
SELECT w.l_orderkey, count(*) AS kept, max(l_linenumber) AS last_line FROM w JOIN b ON b.l_orderkey = w.l_orderkey AND n <= upto GROUP BY 1""")
def prefix_crop(s: SparkSession, d: str) -> DataFrame:
    """W8."""
    kept = sequences.cropped(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_extendedprice")
    return kept.groupBy("l_orderkey").agg(count().alias("kept"), F.max("l_linenumber").alias("last_line"))


@query("""
WITH p AS (SELECT p_partkey, p_brand, p_size, CAST(round(p_retailprice * 100) AS BIGINT) AS score FROM part)
SELECT a.p_partkey, count(b.p_partkey) AS upgrades, min(b.score) AS closest FROM p a LEFT JOIN p b ON b.p_brand = a.p_brand AND abs(b.p_size - a.p_size) <= 10 AND b.score > a.score GROUP BY 1""")
def upgrade_search(s: SparkSession, d: str) -> DataFrame:
    """Higher scores within ten levels, and the closest."""
    parts = table(s, d, "part").select("p_partkey", "p_brand", "p_size", F.round(F.col("p_retailprice") * 100).cast("long").alias("score"))
    return sequences.upgrades(parts, "p_brand", "p_size", "score", "p_partkey", 10)


@query("""
WITH o AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), w AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
d AS (SELECT w.l_partkey, w.n - coalesce(o.n, 0) AS d FROM w LEFT JOIN o ON o.l_partkey = w.l_partkey)
SELECT l_partkey, d AS signed, abs(d) AS absolute, greatest(d, 0) AS added, greatest(-d, 0) AS removed FROM d""")
def list_delta(s: SparkSession, d: str) -> DataFrame:
    """Totals of two lists held against each other; what is only in the old list is ignored."""
    lines = table(s, d, "lineitem").select("l_partkey", "l_returnflag")
    old, new = (lines.filter(c).groupBy("l_partkey").agg(count().alias("n")) for c in (F.col("l_returnflag") == "R", F.col("l_returnflag") != "R"))
    return sequences.compared(old, new, ["l_partkey"], "n")


@query(f"""
SELECT c_mktsegment, count(*) FILTER (WHERE coalesce(c_nationkey % 5 = 0, TRUE) OR {ROLL.format('c_custkey::VARCHAR')} % 101 < c_nationkey % 5 * 25) AS passed,
  count(*) FILTER (WHERE {ROLL.format("'say:' || c_custkey")} % 100 < 30) AS say, count(*) FILTER (WHERE {ROLL.format("'say:' || c_custkey")} % 100 >= 30 AND {ROLL.format("'yell:' || c_custkey")} % 100 < 50) AS yell FROM customer GROUP BY 1""")
def probability_gate(s: SparkSession, d: str) -> DataFrame:
    """Gates and channels that roll by key."""
    key = F.col("c_custkey")
    channel = sequences.first_success(key, [("say", F.lit(30)), ("yell", F.lit(50))])
    rows = table(s, d, "customer").select("c_mktsegment", sequences.passes(key, F.col("c_nationkey") % 5 * 25).alias("ok"), channel.alias("channel"))
    return rows.groupBy("c_mktsegment").agg(F.count_if("ok").alias("passed"), F.count_if(F.col("channel") == "say").alias("say"), F.count_if(F.col("channel") == "yell").alias("yell"))


@query("""
SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey)::INTEGER AS by_size, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_partkey)::INTEGER AS by_length FROM part""")
def two_key_ranks(s: SparkSession, d: str) -> DataFrame:
    """Places by two keys and by length; no brand is ordered in one task."""
    parts = table(s, d, "part").select("p_brand", "p_partkey", "p_size", F.length("p_name").alias("len"))
    one = sequences.running(parts, ["p_brand"], F.col("p_size"), ["p_size", "p_partkey"], F.lit(1), "by_size")
    both = sequences.running(one, ["p_brand"], -F.col("len"), [F.desc("len"), "p_partkey"], F.lit(1), "by_length")
    return both.select("p_brand", "p_partkey", (F.col("by_size") + 1).cast("int").alias("by_size"), (F.col("by_length") + 1).cast("int").alias("by_length"))


@query("""
SELECT p_brand, string_agg(p_size::VARCHAR, ',' ORDER BY p_size) AS sizes FROM (SELECT DISTINCT p_brand, p_size FROM part) WHERE p_size IS NOT NULL GROUP BY 1""")
def distinct_sorted(s: SparkSession, d: str) -> DataFrame:
    """Each brand's distinct sizes in order."""
    return table(s, d, "part").groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_size")).cast("array<string>"), ",").alias("sizes"))


@query("""
WITH u AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' UNION SELECT o_custkey FROM orders WHERE o_totalprice > 100000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)
SELECT c_nationkey, count(*) AS n FROM u JOIN customer ON c_custkey = k WHERE c_acctbal < 5000 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = k AND o_orderpriority = '1-URGENT') GROUP BY 1""")
def target_union(s: SparkSession, d: str) -> DataFrame:
    """Three lists united, filtered by validity, without an exclusion list."""
    orders, people = table(s, d, "orders"), table(s, d, "customer")
    lists = [orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k")), orders.filter("o_totalprice > 100000").select(F.col("o_custkey").alias("k")), people.filter("c_acctbal < 0").select(F.col("c_custkey").alias("k"))]
    united = lists[0].unionByName(lists[1]).unionByName(lists[2])
    valid = relational.having_parent(people.filter("c_acctbal < 5000").select("c_custkey", "c_nationkey"), united, "c_custkey", "k")
    return relational.orphans(valid, orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"), "c_custkey", "o_custkey").groupBy("c_nationkey").agg(count().alias("n"))


@query("""
WITH m AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), f AS (SELECT l_suppkey, count(*) AS parts FROM m GROUP BY 1), i AS (SELECT l_partkey, count(*) AS suppliers FROM m GROUP BY 1)
SELECT m.l_suppkey, max(parts) AS parts, count(*) FILTER (WHERE suppliers = 1) AS only_here FROM m JOIN f ON f.l_suppkey = m.l_suppkey JOIN i ON i.l_partkey = m.l_partkey GROUP BY 1""")
def inverted_lookup(s: SparkSession, d: str) -> DataFrame:
    """A multimap and its inverse: each supplier's parts, and those it alone has."""
    pairs = table(s, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    inverse = pairs.groupBy("l_partkey").agg(count().alias("suppliers"))
    return pairs.join(inverse, "l_partkey").groupBy("l_suppkey").agg(count().alias("parts"), F.count_if(F.col("suppliers") == 1).alias("only_here"))


@query("""
SELECT l_suppkey, round(sum(CASE l_linenumber % 3 WHEN 0 THEN l_quantity * 1.5 WHEN 1 THEN l_quantity + l_tax * 100 ELSE l_discount * 100 END), 2) AS stats FROM lineitem GROUP BY 1""")
def stat_scale(s: SparkSession, d: str) -> DataFrame:
    """Stats by the scale whose id matches, chosen in one pass."""
    slot, q = F.col("l_linenumber") % 3, F.col("l_quantity")
    return table(s, d, "lineitem").groupBy("l_suppkey").agg(total(F.when(slot == 0, q * 1.5).when(slot == 1, q + F.col("l_tax") * 100).otherwise(F.col("l_discount") * 100), "stats"))


@query("""
SELECT l_orderkey, l_linenumber, kind, round(v, 2) AS value FROM (SELECT l_orderkey, l_linenumber, unnest(['member', 'pet', 'charm']) AS kind, unnest([l_quantity, CASE WHEN l_discount > 0.05 THEN l_extendedprice END, CASE WHEN l_tax > 0.06 THEN l_tax END]) AS v FROM lineitem) WHERE v IS NOT NULL""")
def candidate_fanout(s: SparkSession, d: str) -> DataFrame:
    """Each member, and its pet and charm where it has them."""
    has = [("member", F.col("l_quantity")), ("pet", F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice"))), ("charm", F.when(F.col("l_tax") > 0.06, F.col("l_tax")))]
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("v")) for k, v in has])).alias("c"))
    return rows.filter("c.v IS NOT NULL").select("l_orderkey", "l_linenumber", "c.kind", F.round("c.v", 2).alias("value"))


@query("""
SELECT p_partkey, round((p_size + p_retailprice) * 1000 / 2 / (p_partkey % 4 * 500 + 1500), 4) AS dps,
  round(CASE WHEN p_size % 8 = 0 THEN 1.05 WHEN p_size % 8 < 6 THEN 1 + 0.1 * (p_size % 8) ELSE 1.0 END * (1 + 0.03 * (p_partkey % 3)), 4)::DOUBLE AS bonus, p_size * (p_partkey % 5 + 1) AS gear FROM part""")
def derived_stats(s: SparkSession, d: str) -> DataFrame:
    """Damage per second, set and socket bonuses, level by quality."""
    size, key = F.col("p_size"), F.col("p_partkey")
    worn = size % 8
    bonus = F.when(worn == 0, 1.05).when(worn < 6, 1 + 0.1 * worn).otherwise(1.0) * (1 + 0.03 * (key % 3))
    return table(s, d, "part").select("p_partkey", F.round((size + F.col("p_retailprice")) * 1000 / 2 / (key % 4 * 500 + 1500), 4).alias("dps"), F.round(bonus, 4).alias("bonus"), (size * (key % 5 + 1)).alias("gear"))


@query("""
WITH t AS (SELECT c_custkey, str_split(c_custkey || '-' || c_nationkey || '-' || CAST(floor(abs(c_acctbal)) AS BIGINT), '-') AS tabs FROM customer WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL),
x AS (SELECT c_custkey, list_transform(tabs, lambda t: list_sum(list_transform(str_split(t, ''), lambda c: c::BIGINT))) AS points FROM t)
SELECT c_custkey, CAST(points[1] AS BIGINT) AS first_tab, CAST(list_sum(points) AS BIGINT) AS spent, CAST(list_position(points, list_max(points)) AS INTEGER) AS heaviest FROM x""")
def talent_digits(s: SparkSession, d: str) -> DataFrame:
    """Digits per tab, and the heaviest tab, the first among equals."""
    link = F.concat_ws("-", "c_custkey", "c_nationkey", F.floor(F.abs("c_acctbal")))
    valid = table(s, d, "customer").filter("c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL").select("c_custkey", link.alias("link")).filter(F.col("link").rlike("^[0-9-]*[0-9][0-9-]*$"))
    points = F.transform(F.split("link", "-"), lambda t: F.aggregate(F.split(t, ""), F.lit(0).cast("long"), lambda a, c: a + F.coalesce(F.try_to_number(c, F.lit("9")).cast("long"), F.lit(0))))
    rows = valid.withColumn("points", points)
    return rows.select("c_custkey", F.col("points")[0].alias("first_tab"), F.aggregate("points", F.lit(0).cast("long"), lambda a, p: a + p).alias("spent"), F.array_position("points", F.array_max("points")).cast("int").alias("heaviest"))


@query("""
SELECT event_type, max(event_id) AS top_id, count(DISTINCT user_id) AS owners, CAST(min(value) FILTER (WHERE value > 0) * 0 AS INTEGER) AS floor_zero, round(sum(abs(coalesce(value, 0) - 50)), 2) AS apart,
  CAST(sum(user_id & 6) AS BIGINT) AS masked FROM events GROUP BY 1""")
def owner_figures(s: SparkSession, d: str) -> DataFrame:
    """Largest id, distinct owners, absolute values, a mask."""
    v = F.col("value")
    return table(s, d, "events").groupBy("event_type").agg(F.max("event_id").alias("top_id"), F.countDistinct("user_id").alias("owners"), (F.min(F.when(v > 0, v)) * 0).cast("int").alias("floor_zero"), total(F.abs(F.coalesce(v, F.lit(0.0)) - 50), "apart"), F.sum(F.col("user_id").bitwiseAND(6)).alias("masked"))


@query("""
SELECT event_id, CAST(user_id % 97 // 24 AS BIGINT) || 'd ' || CAST(user_id % 97 % 24 AS BIGINT) || 'h' AS lasting, strftime(ts, '%Y-%m-%d %H:%M') AS at, ts + to_seconds(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) AS due FROM events""")
def delayed_queue(s: SparkSession, d: str) -> DataFrame:
    """Each of a user's commands is due a second after the one before; durations and dates as text."""
    hours = F.col("user_id") % 97
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    lasting = F.concat(F.floor(hours / 24).cast("string"), F.lit("d "), (hours % 24).cast("string"), F.lit("h"))
    return table(s, d, "events").select("event_id", lasting.alias("lasting"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("at"), (F.col("ts") + F.make_dt_interval(secs=place)).alias("due"))


@query("""
WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey < 3), l AS (SELECT c_custkey, c_nationkey, c_custkey // 500 AS link, EXISTS (SELECT 1 FROM n WHERE n_nationkey = c_nationkey) AS ok FROM customer)
SELECT c_nationkey, link, count(*) AS points, bool_or(NOT ok) AS regenerate, string_agg(CASE WHEN ok THEN c_custkey::VARCHAR END, '>' ORDER BY c_custkey) AS path FROM l GROUP BY ALL""")
def graph_load(s: SparkSession, d: str) -> DataFrame:
    """Links of a node with their ordered points (500 at most); dangling ones have no path and ask for a new build."""
    nodes = table(s, d, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(True).alias("ok")).distinct()
    links = table(s, d, "customer").select("c_custkey", "c_nationkey", F.floor(F.col("c_custkey") / 500).alias("link")).join(nodes, "c_nationkey", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    points = F.sort_array(F.collect_list(F.when(F.col("ok"), F.col("c_custkey"))))
    grouped = links.groupBy("c_nationkey", "link").agg(count().alias("points"), F.bool_or(~F.col("ok")).alias("regenerate"), points.alias("_p"))
    return grouped.select("c_nationkey", "link", "points", "regenerate", F.when(F.size("_p") > 0, F.array_join(F.col("_p").cast("array<string>"), ">")).alias("path"))


@query("""
WITH p AS (SELECT p_partkey, p_size::DOUBLE AS x, p_retailprice / 50 AS y FROM part)
SELECT count(*) AS n FROM p WHERE ((x - 40) * (5 - 30) - (10 - 40) * (y - 30) < 0) = ((x - 10) * (40 - 5) - (30 - 10) * (y - 5) < 0) AND ((x - 10) * (40 - 5) - (30 - 10) * (y - 5) < 0) = ((x - 30) * (30 - 40) - (40 - 30) * (y - 40) < 0)""")
def point_in_triangle(s: SparkSession, d: str) -> DataFrame:
    """Inside where all three signs agree."""
    x, y = F.col("p_size").cast("double"), F.col("p_retailprice") / 50
    corners = [(40, 30), (10, 5), (30, 40)]
    sides = [(x - ax) * (by - ay) - (bx - ax) * (y - ay) < 0 for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True)]
    return table(s, d, "part").filter((sides[0] == sides[1]) & (sides[1] == sides[2])).agg(count().alias("n"))


@query("""
WITH u AS (SELECT user_id, max(ts) AS seen, count(*) AS n FROM events GROUP BY 1), m AS (SELECT max(ts) AS now FROM events)
SELECT CAST(user_id % 4 AS BIGINT) AS kind, count(*) FILTER (WHERE datesub('second', seen, now) < 172800) AS fresh, CAST(greatest(0, 20 - count(*) FILTER (WHERE datesub('second', seen, now) < 172800)) AS BIGINT) AS missing, CAST(sum(n) AS BIGINT) AS spans FROM u, m GROUP BY 1""")
def population_target(s: SparkSession, d: str) -> DataFrame:
    """Unexpired owners of a kind against the target of twenty."""
    users = table(s, d, "events").groupBy("user_id").agg(F.max("ts").alias("seen"), count().alias("n"))
    now = table(s, d, "events").agg(F.max("ts").alias("now"))
    fresh = F.count_if(F.expr("timestampdiff(SECOND, seen, now)") < 172800)
    return users.crossJoin(F.broadcast(now)).groupBy((F.col("user_id") % 4).alias("kind")).agg(fresh.alias("fresh"), F.greatest(F.lit(0), 20 - fresh).cast("long").alias("missing"), F.sum("n").alias("spans"))


@query("SELECT c_mktsegment, count(DISTINCT 'R' || replace(replace(upper(c_mktsegment), 'A', 'E'), 'EE', 'I')) AS names, min(replace(replace(upper(c_mktsegment), 'A', 'E'), 'EE', 'I')) AS rewritten FROM customer GROUP BY 1")
def rewritten_names(s: SparkSession, d: str) -> DataFrame:
    """Rules rewrite a name one after the other."""
    name = F.replace(F.replace(F.upper("c_mktsegment"), F.lit("A"), F.lit("E")), F.lit("EE"), F.lit("I"))
    return table(s, d, "customer").groupBy("c_mktsegment").agg(F.countDistinct(F.concat(F.lit("R"), name)).alias("names"), F.min(name).alias("rewritten"))


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey > 0 AND l_discount > 0.05")
def vendor_items(s: SparkSession, d: str) -> DataFrame:
    """S7."""
    return table(s, d, "lineitem").filter("l_partkey > 0 AND l_discount > 0.05").select("l_partkey").distinct()


@query("""
SELECT p_partkey, CAST(greatest(0, CASE WHEN p_partkey % 2 = 0 THEN p_size * 3 + p_partkey % 7 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN p_size * 2 ELSE 0 END - 40) AS BIGINT) AS weight FROM part""")
def gated_weight(s: SparkSession, d: str) -> DataFrame:
    """Whole-number weights behind gates, never below 0."""
    size, key = F.col("p_size"), F.col("p_partkey")
    weight = F.when(key % 2 == 0, size * 3 + key % 7).otherwise(0) + F.when(key % 3 == 0, size * 2).otherwise(0) - 40
    return table(s, d, "part").select("p_partkey", F.greatest(F.lit(0), weight).cast("long").alias("weight"))


@query("""
SELECT p_partkey, CAST(p_size AS INTEGER) AS low, CAST(p_size + 5 AS INTEGER) AS high, n::BIGINT AS spell FROM part, unnest([p_partkey, p_partkey + 1]) AS t(n) WHERE p_size IS NOT NULL""")
def buff_matrix(s: SparkSession, d: str) -> DataFrame:
    """X19: '#name:meta:...:spells' taken apart: one row per spell, with the metadata as numbers."""
    key, size = F.col("p_partkey"), F.col("p_size")
    line = F.concat(F.lit("#"), F.concat_ws(":", key, F.lit(0), F.lit(0), F.lit(0), size, size + 5, F.concat_ws(",", key, key + 1)))
    rows = table(s, d, "part").filter("p_size IS NOT NULL").select(line.alias("line"))
    field = F.split(F.expr("substring(line, 2)"), ":")
    parsed = rows.filter(F.col("line").startswith("#")).select(field[0].cast("long").alias("p_partkey"), field[4].cast("int").alias("low"), field[5].cast("int").alias("high"), F.explode(F.split(field[6], ",")).alias("spell"))
    return parsed.withColumn("spell", F.col("spell").cast("long"))


@query("""
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 AND l_discount < 0.08 AND l_tax > 0.01 AND l_returnflag IN ('A', 'N') AND l_linestatus = 'O' AND l_linenumber < 6
  AND l_partkey % 11 <> 0 AND NOT (l_suppkey % 13 = 0 AND l_quantity > 30) AND l_shipdate IS NOT NULL GROUP BY 1""")
def eligible_lines(s: SparkSession, d: str) -> DataFrame:
    """a long conjunction, as far as possible pushed to the scan."""
    ok = (
        F.col("l_quantity").between(5, 45) & (F.col("l_discount") < 0.08) & (F.col("l_tax") > 0.01) & F.col("l_returnflag").isin("A", "N") & (F.col("l_linestatus") == "O")
        & (F.col("l_linenumber") < 6) & (F.col("l_partkey") % 11 != 0) & ~((F.col("l_suppkey") % 13 == 0) & (F.col("l_quantity") > 30)) & F.col("l_shipdate").isNotNull()
    )
    return table(s, d, "lineitem").filter(ok).groupBy("l_suppkey").agg(count().alias("n"))
