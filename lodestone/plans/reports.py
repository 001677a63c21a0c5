"""Named queries: reports, exports, picks, and commands under a stream; each with its SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import graph, ranges, relational, scoring
from lodestone.plans.catalogue import EDGES_SQL, POSITIONS, all_edges, count, doubled, positions, query
from lodestone.session import shared_folder
from lodestone.sources import tables
from lodestone.sources.tables import table
from lodestone.streaming import keyed, replay


@query(f"""
WITH p AS ({POSITIONS}), r AS (SELECT 'RND' AS kind, c_name AS name, c_custkey AS id, c_nationkey AS race, c_custkey % 11 AS class, c_acctbal AS money FROM customer UNION ALL SELECT 'PLR', s_name, s_suppkey, s_nationkey, s_suppkey % 11, s_acctbal FROM supplier)
SELECT kind, name, concat('POINT(', round(x, 2) + 0.0, ' ', round(y, 2) + 0.0, ')') AS wkt, round(z, 2) + 0.0 AS orientation, race, class, map_id, CAST(r.id % 80 + 1 AS BIGINT) AS level, CAST(floor(abs(money)) AS BIGINT) AS money,
  CASE kind WHEN 'RND' THEN CASE WHEN r.id % 10 = 0 THEN 'active' ELSE 'inactive' END ELSE 'player' END AS activity, CASE WHEN money < 0 THEN 'combat' ELSE 'safe' END AS fight, CASE WHEN r.id % 17 = 0 THEN CASE WHEN r.id % 2 = 0 THEN 'ghost' ELSE 'dead' END ELSE 'alive' END AS life
FROM r JOIN p ON p.id = r.id % 200""")
def location_log(s: SparkSession, d: str) -> DataFrame:
    """Where everybody is, random ones and players in one list, positions as WKT."""
    columns = lambda kind, p, of: of.select(F.lit(kind).alias("kind"), F.col(f"{p}_name").alias("name"), F.col({"c": "c_custkey", "s": "s_suppkey"}[p]).alias("id"), F.col(f"{p}_nationkey").alias("race"), F.col(f"{p}_acctbal").alias("cash"))
    both = columns("RND", "c", table(s, d, "customer")).unionByName(columns("PLR", "s", table(s, d, "supplier")))
    at = positions(s, d).select(F.col("id").alias("_at"), "map_id", *[(F.round(c, 2) + 0.0).alias(n) for c, n in (("x", "x"), ("y", "y"), ("z", "orientation"))])
    rows = both.join(at, F.col("id") % 200 == F.col("_at"))
    activity = F.when(F.col("kind") == "RND", F.when(F.col("id") % 10 == 0, "active").otherwise("inactive")).otherwise("player")
    life = F.when(F.col("id") % 17 == 0, F.when(F.col("id") % 2 == 0, "ghost").otherwise("dead")).otherwise("alive")
    return rows.select(
        "kind", "name", X.wkt(F.array(F.struct("x", "y")), "POINT").alias("wkt"), "orientation", "race", (F.col("id") % 11).alias("class"), "map_id", (F.col("id") % 80 + 1).alias("level"),
        F.floor(F.abs("cash")).alias("money"), activity.alias("activity"), F.when(F.col("cash") < 0, "combat").otherwise("safe").alias("fight"), life.alias("life"),
    )


@query("""
WITH p AS (SELECT s_nationkey AS k, s_suppkey // 100 AS part, string_agg(concat(s_suppkey, ' ', s_suppkey % 7), ',' ORDER BY s_suppkey) AS pts, arg_min(concat(s_suppkey, ' ', s_suppkey % 7), s_suppkey) AS first FROM supplier GROUP BY ALL)
SELECT k, part, concat('POINT(', first, ')') AS point, concat('MULTIPOINT(', pts, ')') AS points, concat('LINESTRING(', pts, ')') AS line, concat('POLYGON((', pts, ',', first, '))') AS area FROM p""")
def wkt_shapes(s: SparkSession, d: str) -> DataFrame:
    """A nation's suppliers as points, lines and closed areas; a shape holds those of a hundred keys."""
    corners = F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("x"), (F.col("s_suppkey") % 7).alias("y"))))
    rows = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("k"), F.floor(F.col("s_suppkey") / 100).alias("part")).agg(corners.alias("p"))
    return rows.select("k", "part", *[X.wkt(F.col("p"), shape).alias(name) for shape, name in (("POINT", "point"), ("MULTIPOINT", "points"), ("LINESTRING", "line"), ("POLYGON", "area"))])


FACETS = {"nation": "c_nationkey::VARCHAR", "class": "(c_custkey % 11)::VARCHAR", "role": "['tank', 'heal', 'dps'][c_custkey % 3 + 1]", "segment": "c_mktsegment", "status": "CASE WHEN c_acctbal < 0 THEN 'dead' WHEN c_custkey % 9 = 0 THEN 'combat' ELSE 'alive' END", "zone": "(c_custkey % 40)::VARCHAR", "engine": "['combat', 'non-combat'][c_custkey % 2 + 1]", "side": "CASE WHEN c_nationkey < 12 THEN 'one' ELSE 'other' END"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS facet, {v} AS value, count(*) AS n, CAST(sum(c_custkey % 80 + 1) AS BIGINT) AS levels FROM customer GROUP BY 2" for k, v in FACETS.items()))
def population_facets(s: SparkSession, d: str) -> DataFrame:
    """The population by eight facets in one pass, with the sum of levels."""
    key = F.col("c_custkey")
    pick = lambda words, i: F.element_at(F.array(*[F.lit(w) for w in words]), (i + 1).cast("int"))
    facets = {
        "nation": F.col("c_nationkey").cast("string"), "class": (key % 11).cast("string"), "role": pick(("tank", "heal", "dps"), key % 3), "segment": F.col("c_mktsegment"),
        "status": F.when(F.col("c_acctbal") < 0, "dead").when(key % 9 == 0, "combat").otherwise("alive"), "zone": (key % 40).cast("string"), "engine": pick(("combat", "non-combat"), key % 2),
        "side": F.when(F.col("c_nationkey") < 12, "one").otherwise("other"),
    }
    rows = table(s, d, "customer").select((key % 80 + 1).alias("level"), F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in facets.items()])).alias("f"))
    return rows.groupBy("f.facet", "f.value").agg(count().alias("n"), F.sum("level").alias("levels"))


@query("""
SELECT p_partkey FROM part WHERE p_size * 2 > 0 AND p_size <= 40 AND p_size >= 40 - 20 AND (p_partkey % 3 = 0 OR p_partkey % 3 = 1) AND p_brand LIKE '%2' AND p_partkey % 5 > 0
  AND p_retailprice > 950 AND NOT (p_size = 21 AND p_partkey % 2 = 0) AND (p_partkey % 7 <> 2 OR p_partkey % 4 = 1) AND NOT (p_retailprice < 1000 AND p_type LIKE 'SMALL%')""")
def upgrade_candidates(s: SparkSession, d: str) -> DataFrame:
    """ten conditions on a candidate: a weight, level window, team, slot, quality, a better score, sources and quests."""
    key, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    conditions = [size * 2 > 0, size <= 40, size >= 40 - 20, key % 3 < 2, F.col("p_brand").endswith("2"), key % 5 > 0, price > 950, ~((size == 21) & (key % 2 == 0)), (key % 7 != 2) | (key % 4 == 1), ~((price < 1000) & F.col("p_type").startswith("SMALL"))]
    return table(s, d, "part").filter(scoring.all_of(conditions)).select("p_partkey")


@query("SELECT p_size AS level, p_brand AS type, count(*) AS n, max(p_partkey) AS best FROM part WHERE p_retailprice > 950 AND p_size BETWEEN 10 AND 12 GROUP BY ALL")
def items_by_predicate(s: SparkSession, d: str) -> DataFrame:
    """a query by level and type with a predicate of the caller's."""
    return relational.by_level_and_type(table(s, d, "part"), "p_size", "p_brand", 10, 12, F.col("p_retailprice") > 950).groupBy(F.col("p_size").alias("level"), F.col("p_brand").alias("type")).agg(count().alias("n"), F.max("p_partkey").alias("best"))


@query("""
SELECT p_brand, p_partkey AS picked FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 40) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY md5('pick' || p_partkey), p_partkey) = 1""")
def random_unused(s: SparkSession, d: str) -> DataFrame:
    """A random one of each brand's unused parts; the roll is a hash of the key."""
    unused = relational.orphans(table(s, d, "part").select("p_partkey", "p_brand"), table(s, d, "lineitem").filter("l_quantity > 40"), "p_partkey", "l_partkey")
    return unused.groupBy("p_brand").agg(F.min(F.struct(F.md5(F.concat(F.lit("pick"), F.col("p_partkey").cast("string"))), F.col("p_partkey"))).alias("p")).select("p_brand", F.col("p.p_partkey").alias("picked"))


@query("""
WITH x AS (SELECT doc_id, lang, concat(source, ':', n_chars % 20) AS subject FROM documents), t AS (SELECT subject, lang, max(doc_id) AS top FROM x GROUP BY ALL) SELECT doc_id FROM x d WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.subject = d.subject AND d.doc_id <> t.top)""")
def dedupe_by_subject(s: SparkSession, d: str) -> DataFrame:
    """J7, M8 as a join on the subject alone has it: a row goes if the largest id of any group of its subject is another."""
    rows = table(s, d, "documents").select("doc_id", "lang", F.concat("source", F.lit(":"), (F.col("n_chars") % 20).cast("string")).alias("subject"))
    return relational.keep_max_of_group(rows, "subject", ["lang"], "doc_id", on_subject_only=True).select("doc_id")


@query("""
WITH k(scale, stat, weight) AS (VALUES (0, 'price', 0.5::DOUBLE), (0, 'size', 2.0), (1, 'price', 0.25), (2, 'size', 3.0)), v AS (SELECT p_partkey, p_partkey % 4 AS scale, 'price' AS stat, p_retailprice AS v FROM part UNION ALL SELECT p_partkey, p_partkey % 4, 'size', p_size FROM part)
SELECT v.p_partkey, v.stat, round(v * weight, 4) AS scaled FROM v JOIN k ON k.scale = v.scale AND k.stat = v.stat""")
def scale_join(s: SparkSession, d: str) -> DataFrame:
    """Stats joined to the scale with their id."""
    scales = s.createDataFrame([(0, "price", 0.5), (0, "size", 2.0), (1, "price", 0.25), (2, "size", 3.0)], "scale long, stat string, weight double")
    stats = F.explode(F.array(F.struct(F.lit("price").alias("stat"), F.col("p_retailprice").alias("v")), F.struct(F.lit("size").alias("stat"), F.col("p_size").cast("double").alias("v"))))
    rows = table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 4).alias("scale"), stats.alias("x")).select("p_partkey", "scale", "x.*")
    return rows.join(scales, ["scale", "stat"]).select("p_partkey", "stat", F.round(F.col("v") * F.col("weight"), 4).alias("scaled"))


_ROLL = "CAST(('0x' || substr(md5('{0}:' || c_custkey), 1, 8)) AS BIGINT)"
_FORMS, _LETTERS, _RULES = ["CV", "CVC", "VCV", "CVCV"], {"C": "bdkS", "V": "aeoA"}, [("S", "sh"), ("A", "ai"), ("kk", "ck")]


def _letter(i: int) -> str:
    cases = " ".join(f"WHEN '{c}' THEN substr('{of}', {_ROLL.format(i)} % {len(of)} + 1, 1)" for c, of in _LETTERS.items())
    return f"CASE substr(form, {i + 1}, 1) {cases} ELSE '' END"


@query(f"""
WITH f AS (SELECT c_custkey, {_FORMS}[{_ROLL.format('form')} % 4 + 1] AS form FROM customer), n AS (SELECT c_custkey, replace(replace(replace(concat({', '.join(_letter(i) for i in range(4))}), 'S', 'sh'), 'A', 'ai'), 'kk', 'ck') AS n FROM f)
SELECT c_custkey, upper(n[1]) || n[2:] AS name FROM n""")
def generated_names(s: SparkSession, d: str) -> DataFrame:
    """Made-up names: forms, letters by category, rewriting rules."""
    return table(s, d, "customer").select("c_custkey", X.generated_name(F.col("c_custkey"), _FORMS, _LETTERS, _RULES).alias("name"))


@query("""
WITH l AS (SELECT p_brand, p_size, max(p_partkey) AS best FROM part WHERE p_size % 2 = 0 GROUP BY ALL), w AS (SELECT s_suppkey, 'Brand#' || (s_suppkey % 5 + 1) || (s_suppkey % 7 + 1) AS brand, s_suppkey % 60 AS want FROM supplier),
h AS (SELECT s_suppkey, best FROM w JOIN l ON p_brand = brand AND p_size BETWEEN want - 3 AND want QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY p_size DESC) = 1), g AS (SELECT p_size, max(p_partkey) AS best FROM part GROUP BY 1)
SELECT w.s_suppkey, coalesce(h.best, g.best) AS item, h.best IS NOT NULL AS own FROM w LEFT JOIN h ON h.s_suppkey = w.s_suppkey LEFT JOIN g ON g.p_size = want""")
def slot_fallback(s: SparkSession, d: str) -> DataFrame:
    """The best item at or up to three levels below the wanted one, or else the general one of that level."""
    levels = table(s, d, "part").filter("p_size % 2 = 0").groupBy(F.col("p_brand").alias("brand"), F.col("p_size").cast("long").alias("p_size")).agg(F.max("p_partkey").alias("best"))
    key = F.col("s_suppkey")
    wanted = table(s, d, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (key % 5 + 1).cast("string"), (key % 7 + 1).cast("string")).alias("brand"), (key % 60).alias("want"))
    found = relational.asof_floor(wanted, levels, ["brand"], "want", "p_size", 3, "best").select("s_suppkey", "best")
    general = table(s, d, "part").groupBy(F.col("p_size").cast("long").alias("want")).agg(F.max("p_partkey").alias("general"))
    both = wanted.join(found, "s_suppkey", "left").join(general, "want", "left")
    return both.select("s_suppkey", F.coalesce("best", "general").alias("item"), F.col("best").isNotNull().alias("own"))


@query(f"""
WITH {EDGES_SQL}, k AS (SELECT src, dst, cost FROM e WHERE src NOT IN (3, 4, 5) AND dst NOT IN (3, 4, 5) AND cost < 800), {doubled('h', 'SELECT src, dst, 1 AS hops FROM k', 'hops')}
SELECT src, dst, CAST(hops AS INTEGER) AS hops FROM h6 WHERE dst % 2 = 0""")
def graph_important(s: SparkSession, d: str) -> DataFrame:
    """Reachability over cheap flows that leaves ignored nations out and gives important ones only."""
    nodes = table(s, d, "nation").select(F.col("n_nationkey").alias("node"))
    return graph.closure(all_edges(s, d).filter("cost < 800"), ignored=nodes.filter("node IN (3, 4, 5)"), important=nodes.filter("node % 2 = 0"))


@query("""
WITH w AS (SELECT max(ts) AS now FROM events), q AS (SELECT user_id::VARCHAR AS key, event_id AS seq, epoch_us(ts) + event_id % 5 * 86400000000 AS due FROM events)
SELECT key, seq, due FROM q, w WHERE (due + 999) // 1000 <= epoch_ms(now)""")
def stream_delayed_commands(s: SparkSession, d: str) -> DataFrame:
    """K3, K4: commands that are due none to four days after they come, delivered as the watermark of a stream passes them."""
    # all files in one trigger: the rows of a file that overlaps an earlier one in time are not late then
    stream = replay.event_stream(s, d, 2**31 - 1).select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), (F.col("event_id") % 5 * 86_400).alias("delay"))
    return keyed.emitted(keyed.delayed(stream)).select("key", "seq", "due")


@query("""
WITH RECURSIVE o AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, epoch_us(ts) AS us FROM events),
f AS (SELECT event_id, user_id, n, TRUE AS let, us AS last FROM o WHERE n = 1 UNION ALL SELECT o.event_id, o.user_id, o.n, us - last >= 43200000000, CASE WHEN us - last >= 43200000000 THEN us ELSE last END FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT user_id::VARCHAR AS key, event_id AS seq FROM f WHERE let""")
def stream_throttled(s: SparkSession, d: str) -> DataFrame:
    """K5: triggers of a user at most every twelve hours, as a stream lets them through."""
    stream = replay.event_stream(s, d).select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    return keyed.emitted(keyed.throttled(stream, 43_200)).select("key", "seq")


@query("""
WITH t AS (SELECT source, lang, text FROM documents) SELECT source, CAST(sum(strlen(text) - strlen(ltrim(text))) AS BIGINT) AS led, count(*) FILTER (WHERE contains(lower(text), 'the')) AS said, CAST(sum(len(str_split(text, '.'))) AS BIGINT) AS parts FROM t GROUP BY 1""")
def text_figures(s: SparkSession, d: str) -> DataFrame:
    """Trimmed, lower-cased and split texts in figures."""
    t = F.col("text")
    return table(s, d, "documents").groupBy("source").agg(F.sum(F.octet_length(t) - F.octet_length(F.ltrim(t))).cast("long").alias("led"), F.count_if(F.contains(F.lower(t), F.lit("the"))).alias("said"), F.sum(F.size(F.split(t, r"\."))).cast("long").alias("parts"))


@query("""
WITH c AS (SELECT c.i AS class, l.i AS level, q.i AS quality FROM range(1, 12) c(i), range(1, 81) l(i), range(0, 5) q(i)), p AS (SELECT p_partkey % 11 + 1 AS class, p_size AS level, p_partkey % 5 AS quality, count(*) AS n FROM part GROUP BY ALL)
SELECT c.class, c.level, c.quality, coalesce(n, 0) AS n FROM c LEFT JOIN p ON p.class = c.class AND p.level = c.level AND p.quality = c.quality""")
def enumerated_cells(s: SparkSession, d: str) -> DataFrame:
    """Cross join, F2: all classes, levels and qualities (a fixed 4,400 cells) with what there is of each."""
    axes = [s.range(a, b).select(F.col("id").alias(c)) for c, a, b in (("class", 1, 12), ("level", 1, 81), ("quality", 0, 5))]
    key = F.col("p_partkey")
    have = table(s, d, "part").groupBy((key % 11 + 1).alias("class"), F.col("p_size").cast("long").alias("level"), (key % 5).alias("quality")).agg(count().alias("n"))
    return ranges.enumerated(*axes).join(have, ["class", "level", "quality"], "left").na.fill(0, ["n"])


@query("""
SELECT 'replaced' AS what, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS keys FROM nation UNION ALL SELECT 'before', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation WHERE n_regionkey < 2
UNION ALL SELECT 'cached', count(*), CAST(sum(r_regionkey) AS BIGINT) FROM region UNION ALL SELECT 'logged', 2 * count(*), CAST(2 * sum(r_regionkey) AS BIGINT) FROM region
UNION ALL SELECT 'saved', count(*), CAST(sum(CASE WHEN n_regionkey = 1 THEN n_nationkey + 100 ELSE n_nationkey END) AS BIGINT) FROM nation""")
def stored_tables(s: SparkSession, d: str) -> DataFrame:
    """A table replaced under a reader that keeps its rows, a cache that is built once, a log that grows, a partition that is saved anew."""
    folder = f"{shared_folder(s).rstrip('/')}/store-{uuid.uuid4().hex}"
    nations, regions = table(s, d, "nation").select("n_nationkey", "n_regionkey"), table(s, d, "region").select("r_regionkey")
    tables.replace_table(nations.filter("n_regionkey < 2"), f"{folder}/t")
    before = tables.read_table(s, f"{folder}/t")
    tables.replace_table(nations, f"{folder}/t")
    cached = tables.load_or_build(s, f"{folder}/c", lambda: regions)
    cached = tables.load_or_build(s, f"{folder}/c", lambda: regions.filter("false"))
    for _ in range(2):
        tables.append_log(regions, f"{folder}/log")
    logged = s.read.schema("r_regionkey int, written timestamp").csv(f"{folder}/log", header=True)
    tables.save_partitions(nations, f"{folder}/p", "n_regionkey")
    tables.save_partitions(nations.filter("n_regionkey = 1").withColumn("n_nationkey", F.col("n_nationkey") + 100), f"{folder}/p", "n_regionkey")
    saved = s.read.parquet(f"{folder}/p")
    parts = [("replaced", tables.read_table(s, f"{folder}/t"), "n_nationkey"), ("before", before, "n_nationkey"), ("cached", cached, "r_regionkey"), ("logged", logged, "r_regionkey"), ("saved", saved, "n_nationkey")]
    return reduce(DataFrame.unionByName, [df.agg(F.lit(what).alias("what"), count().alias("n"), F.sum(key).cast("long").alias("keys")) for what, df, key in parts])


@query("""
SELECT 'region.' || r_regionkey AS key, CASE r_regionkey % 3 WHEN 0 THEN r_name WHEN 1 THEN concat(r_regionkey::BIGINT * 1000000007, ' x') ELSE 'a = b' END AS value, CASE r_regionkey % 3 WHEN 1 THEN r_regionkey::BIGINT * 1000000007 ELSE 0 END AS number FROM region""")
def settings_read(s: SparkSession, d: str) -> DataFrame:
    """A file of settings with comments and blank lines, read as keys, values and numbers."""
    path = f"{shared_folder(s).rstrip('/')}/settings-{uuid.uuid4().hex}"
    key = F.col("r_regionkey").cast("long")
    value = F.when(key % 3 == 0, F.col("r_name")).when(key % 3 == 1, F.concat((key * 1000000007).cast("string"), F.lit(" x"))).otherwise("a = b")
    lines = F.explode(F.array(F.lit("# note = none"), F.lit(""), F.concat(F.lit("region."), key.cast("string"), F.lit(" =  "), value)))
    table(s, d, "region").select(lines.alias("value")).write.text(path)
    return tables.settings(s, path)


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal >= 1000 AND c_nationkey IN (1, 2, 3) AND c_name LIKE 'Customer%' GROUP BY 1")
def bound_parameters(s: SparkSession, d: str) -> DataFrame:
    """A query with bound parameters; nothing is spliced into its text."""
    sql = "SELECT c_mktsegment, count(*) AS n FROM parquet.`{}` WHERE c_acctbal >= :low AND array_contains(:nations, c_nationkey) AND startswith(c_name, :prefix) GROUP BY 1"
    return tables.parameterised(s, sql.format(f"{d}/customer.parquet"), low=1000, nations=F.array(F.lit(1), F.lit(2), F.lit(3)), prefix="Customer")
