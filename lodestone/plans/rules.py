"""Named queries over rules, texts, scores and small dimensions; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import ranges, relational, scoring, sequences, spatial
from lodestone.plans.catalogue import POSITIONS, count, positions, query
from lodestone.sources import tables
from lodestone.sources.tables import table


@query("""
WITH a AS (SELECT l_partkey, l_suppkey AS entry, l_linenumber % 3 AS grp, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_discount * 100 END AS chance FROM lineitem),
g AS (SELECT entry, grp, sum(chance) FILTER (WHERE chance > 0) AS taken, count(*) FILTER (WHERE chance = 0) AS unset FROM a GROUP BY ALL)
SELECT l_partkey, round(avg(CASE WHEN a.grp = 0 OR chance > 0 THEN chance ELSE coalesce(100 - taken, 100) * coalesce(1 / nullif(unset, 0), 1) END), 4) AS chance FROM a JOIN g ON g.entry = a.entry AND g.grp = a.grp GROUP BY 1""")
def skinning_chance(s: SparkSession, d: str) -> DataFrame:
    """The mean chance of a part: its own, or an equal part of what its group leaves of 100, times 1 / count."""
    chance = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_discount") * 100)
    rows = table(s, d, "lineitem").select("l_partkey", F.col("l_suppkey").alias("entry"), (F.col("l_linenumber") % 3).alias("grp"), chance.alias("chance"))
    groups = rows.groupBy("entry", "grp").agg(F.sum(F.when(F.col("chance") > 0, F.col("chance"))).alias("taken"), F.count_if(F.col("chance") == 0).alias("unset"))
    share = F.coalesce(100 - F.col("taken"), F.lit(100.0)) * F.coalesce(1 / F.nullif("unset", F.lit(0)), F.lit(1.0))
    own = F.when((F.col("grp") == 0) | (F.col("chance") > 0), F.col("chance")).otherwise(share)
    return rows.join(groups, ["entry", "grp"]).groupBy("l_partkey").agg(F.round(F.avg(own), 4).alias("chance"))


@query("SELECT c_nationkey, count(*) AS n, (CAST(sum(CAST(floor(abs(c_acctbal) / 100) AS BIGINT)) AS BIGINT) * 10 // count(*)) / 10.0 AS mean FROM customer GROUP BY 1")
def average_level(s: SparkSession, d: str) -> DataFrame:
    """A10: a mean cut to one decimal in whole numbers."""
    level = F.floor(F.abs("c_acctbal") / 100)
    return table(s, d, "customer").groupBy("c_nationkey").agg(count().alias("n"), (F.floor(F.sum(level) * 10 / count()) / 10).alias("mean"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) AS c FROM lineitem")
def spawn_counts(s: SparkSession, d: str) -> DataFrame:
    """Every row with the count of its key; counted before rows are joined, so no key's rows meet in a window."""
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(lines.groupBy("l_partkey").agg(count().alias("c")), "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "c")


LINK = "concat('x |Hitem:', p_partkey, ':', array_to_string(list_transform(range(1, p_size % 9 + 1), lambda i: (p_partkey * i % 100)::VARCHAR), ':'), '|h[', p_name, ']|h end')"


@query(f"""
WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN p_name ELSE {LINK} END AS t FROM part), x AS (SELECT p_partkey, CASE WHEN strpos(t, 'Hitem:') > 0 THEN str_split(substr(t, strpos(t, 'Hitem:') + 6), ':') END AS p FROM l),
y AS (SELECT p_partkey, p, list_concat(p[2:len(p) - 1], CASE WHEN len(p) > 1 AND contains(p[-1], '|h') THEN [str_split(p[-1], '|h')[1]] ELSE [] END) AS q FROM x)
SELECT p_partkey, CASE WHEN len(p) > 1 THEN CAST(p[1] AS BIGINT) END AS item, CASE WHEN len(q) >= 6 THEN CAST(q[6] AS BIGINT) END AS property FROM y""")
def link_property(s: SparkSession, d: str) -> DataFrame:
    """Item links taken apart: the id and the sixth parameter."""
    key, size = F.col("p_partkey"), F.col("p_size")
    n = (size % 9).cast("int")
    params = F.array_join(F.transform(F.filter(F.sequence(F.lit(0), n), lambda i: i > 0), lambda i: (key * i % 100).cast("string")), ":")
    link = F.concat(F.lit("x |Hitem:"), key.cast("string"), F.lit(":"), params, F.lit("|h["), F.col("p_name"), F.lit("]|h end"))
    rows = table(s, d, "part").select("p_partkey", X.item_link(F.when(key % 11 == 0, F.col("p_name")).otherwise(link)).alias("x"))
    return rows.select("p_partkey", "x.item", "x.property")


@query("""
WITH l AS (SELECT n_nationkey, concat(n_name, CASE WHEN n_nationkey % 7 = 3 THEN '' ELSE '>' END, 'look!', n_regionkey, '.5,', CASE WHEN n_nationkey % 6 = 5 THEN '' ELSE 'go' END, CASE WHEN n_nationkey % 8 = 1 THEN '!1!2' ELSE '' END, ',rest') AS line FROM nation),
ok AS (SELECT * FROM l WHERE n_nationkey % 7 <> 3 AND n_nationkey % 6 <> 5 AND n_nationkey % 8 <> 1), t AS (SELECT n_nationkey, str_split(line, '>') AS s FROM ok)
SELECT n_nationkey, s[1] AS trigger, str_split(a, '!')[1] AS action, CASE WHEN contains(a, '!') THEN CAST(str_split(a, '!')[2] AS DOUBLE) ELSE 10.0 END AS rel FROM (SELECT n_nationkey, s, unnest(str_split(s[2], ',')) AS a FROM t)""")
def custom_rules(s: SparkSession, d: str) -> DataFrame:
    """Rules of the form trigger>action!relevance,action; a line with a fault gives nothing."""
    key = F.col("n_nationkey")
    sign = F.when(key % 7 == 3, "").otherwise(">")
    line = F.concat(F.col("n_name"), sign, F.lit("look!"), F.col("n_regionkey").cast("string"), F.lit(".5,"), F.when(key % 6 == 5, "").otherwise("go"), F.when(key % 8 == 1, "!1!2").otherwise(""), F.lit(",rest"))
    rows = table(s, d, "nation").select("n_nationkey", X.rule(line).alias("r")).filter("r IS NOT NULL")
    return rows.select("n_nationkey", "r.trigger", F.explode("r.actions").alias("a")).select("n_nationkey", "trigger", "a.action", "a.rel")


@query(f"""
WITH p AS ({POSITIONS}), c AS (SELECT a.id AS bot, b.id AS target, b.id % 5 AS assists, round(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2), 6) AS d FROM p a JOIN p b ON a.map_id = b.map_id AND a.id <> b.id
  WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.0225 AND b.id % 60 BETWEEN 10 AND 50 AND b.x > -0.3 AND b.id % 5 < 3)
SELECT bot, target, CAST(assists AS BIGINT) AS assists FROM c QUALIFY row_number() OVER (PARTITION BY bot ORDER BY assists, d, target) = 1""")
def grind_target(s: SparkSession, d: str) -> DataFrame:
    """everybody's nearest target in reach that nobody fights; if there is none, one that one other fights, and so on up to
    two. The least level that has a target decides, so one ordering says it."""
    near = spatial.within(positions(s, d), "id", "map_id", 0.15).select(F.col("a").alias("bot"), F.col("b").alias("target"), (F.col("b") % 5).alias("assists"), F.round("d2", 6).alias("d"))
    able = positions(s, d).filter("id % 60 BETWEEN 10 AND 50 AND x > -0.3 AND id % 5 < 3").select(F.col("id").alias("target"))
    found = near.join(able, "target", "left_semi").groupBy("bot").agg(F.min(F.struct("assists", "d", "target")).alias("t"))
    return found.select("bot", "t.target", "t.assists")


@query("""
WITH l AS (SELECT unnest(range(1, 81)) AS level)
SELECT level, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS keys FROM part JOIN l ON p_size <= level AND (level <= 13 OR p_size >= level - 13) GROUP BY 1""")
def level_windows(s: SparkSession, d: str) -> DataFrame:
    """for each level the parts that need it or less, from level 14 on not more than 13 less."""
    levels = s.range(1, 81).select(F.col("id").cast("int").alias("level"))
    used = ranges.windowed_levels(table(s, d, "part").select("p_partkey", "p_size"), "p_size", levels, "level")
    return used.groupBy(F.col("level").cast("long").alias("level")).agg(count().alias("n"), F.sum("p_partkey").alias("keys"))


@query("""
SELECT p_partkey, lower(p_name) LIKE '%qa%' OR lower(p_name) LIKE '%test%' OR lower(p_name) LIKE '%deprecated%' OR lower(p_name) LIKE '%blue%' AS listed,
  p_brand IN ('Brand#11', 'Brand#23') AS exact, p_name LIKE '%a%' OR p_name LIKE '%#%' AS part, p_type LIKE 'STANDARD%' OR p_type LIKE 'LARGE%' AS begins,
  p_size >= 2 AND (p_partkey & 8192) = 0 AND (p_partkey % 5 = 1 OR p_partkey % 7 = 1 OR p_partkey % 11 = 1 OR p_size % 3 = 1 OR p_size % 4 = 1) AS fits FROM part""")
def name_lists(s: SparkSession, d: str) -> DataFrame:
    """lists of words in any case, exact names, parts and beginnings; a bit mask with five columns to choose from."""
    name, key, size = F.col("p_name"), F.col("p_partkey"), F.col("p_size")
    any_of = lambda conditions: F.exists(F.array(*conditions), lambda x: x)
    return table(s, d, "part").select(
        "p_partkey", any_of([F.lower(name).contains(w) for w in ("qa", "test", "deprecated", "blue")]).alias("listed"), F.col("p_brand").isin("Brand#11", "Brand#23").alias("exact"),
        any_of([name.contains(w) for w in ("a", "#")]).alias("part"), any_of([F.col("p_type").startswith(w) for w in ("STANDARD", "LARGE")]).alias("begins"),
        ((size >= 2) & (key.bitwiseAND(8192) == 0) & F.array_contains(F.array(key % 5, key % 7, key % 11, (size % 3).cast("long"), (size % 4).cast("long")), 1)).alias("fits"),
    )


@query("""
WITH m AS (SELECT conv_id, turn, CASE (conv_id + turn) % 11 WHEN 0 THEN '@tank ' WHEN 1 THEN '@dps ' WHEN 2 THEN '@heal ' WHEN 3 THEN '@ranged ' WHEN 4 THEN '@melee ' WHEN 5 THEN '@10-40 ' WHEN 6 THEN '@group2 ' WHEN 7 THEN '@mage ' WHEN 8 THEN '@star ' WHEN 9 THEN '@aura7 ' ELSE '' END AS tag, substr(text, 1, 20) AS body,
  ['tank', 'dps', 'heal'][conv_id % 3 + 1] AS role, turn % 2 = 0 AS ranged, conv_id % 60 + 1 AS level, turn % 3 + 1 AS sub, ['mage', 'priest'][conv_id % 2 + 1] AS cls, conv_id % 4 = 0 AS star, conv_id % 9 AS aura FROM conversations)
SELECT conv_id, turn, kept FROM (SELECT conv_id, turn, CASE tag WHEN '@tank ' THEN CASE WHEN role = 'tank' THEN body ELSE '' END WHEN '@dps ' THEN CASE WHEN role = 'dps' THEN body ELSE '' END WHEN '@heal ' THEN CASE WHEN role = 'heal' THEN body ELSE '' END
  WHEN '@ranged ' THEN CASE WHEN ranged THEN body ELSE '' END WHEN '@melee ' THEN CASE WHEN NOT ranged THEN body ELSE '' END WHEN '@10-40 ' THEN CASE WHEN level BETWEEN 10 AND 40 THEN body ELSE '@10-40 ' || body END
  WHEN '@group2 ' THEN CASE WHEN sub = 2 THEN body ELSE '' END WHEN '@mage ' THEN CASE WHEN cls = 'mage' THEN body ELSE '' END WHEN '@star ' THEN CASE WHEN star THEN body ELSE '' END WHEN '@aura7 ' THEN CASE WHEN aura = 7 THEN body ELSE '' END ELSE body END AS kept FROM m) WHERE kept <> ''""")
def message_selectors(s: SparkSession, d: str) -> DataFrame:
    """selectors of role, reach, level, subgroup, class, target sign and aura in front of a message; one that does not fit blanks it, but for the level's, which lets it pass unfiltered."""
    conv, turn = F.col("conv_id"), F.col("turn")
    tags = ["@tank ", "@dps ", "@heal ", "@ranged ", "@melee ", "@10-40 ", "@group2 ", "@mage ", "@star ", "@aura7 ", ""]
    tag = F.element_at(F.array(*[F.lit(t) for t in tags]), ((conv + turn) % 11 + 1).cast("int"))
    rows = table(s, d, "conversations").select(
        "conv_id", "turn", F.concat(tag, F.expr("substring(text, 1, 20)")).alias("message"), F.element_at(F.array(*[F.lit(r) for r in ("tank", "dps", "heal")]), (conv % 3 + 1).cast("int")).alias("role"),
        (turn % 2 == 0).alias("ranged"), (conv % 60 + 1).alias("level"), (turn % 3 + 1).alias("sub"), F.element_at(F.array(F.lit("mage"), F.lit("priest")), (conv % 2 + 1).cast("int")).alias("cls"), (conv % 4 == 0).alias("star"), (conv % 9).alias("aura"),
    )
    message = X.selected(
        F.col("message"),
        {"@tank": F.col("role") == "tank", "@dps": F.col("role") == "dps", "@heal": F.col("role") == "heal", "@ranged": F.col("ranged"), "@melee": ~F.col("ranged"), "@star": F.col("star")},
        level=F.col("level"), numbered={"@group": F.col("sub"), "@aura": F.col("aura")}, named=F.col("cls"), names=("mage", "priest"),
    )
    return rows.select("conv_id", "turn", message.alias("kept")).filter("kept <> ''")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN 'none' WHEN c_custkey % 13 = 0 THEN 'all' WHEN c_acctbal < 0 THEN 'deny' WHEN c_nationkey % 5 = 0 THEN 'talk' WHEN c_acctbal > 5000 THEN 'invite' ELSE 'talk' END AS level,
  CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_custkey % 13 = 0 THEN 'owner' WHEN c_acctbal < 0 THEN 'in debt' WHEN c_nationkey % 5 = 0 THEN 'opposing' WHEN c_acctbal > 5000 THEN 'trusted' ELSE 'stranger' END AS reason FROM customer""")
def access_levels(s: SparkSession, d: str) -> DataFrame:
    """the first condition that holds gives the level and the reason."""
    bal = F.col("c_acctbal")
    found = scoring.first_match([(bal.isNull(), "none", "unknown"), (F.col("c_custkey") % 13 == 0, "all", "owner"), (bal < 0, "deny", "in debt"), (F.col("c_nationkey") % 5 == 0, "talk", "opposing"), (bal > 5000, "invite", "trusted")], ("talk", "stranger"))
    return table(s, d, "customer").select("c_custkey", found.alias("f")).select("c_custkey", "f.level", "f.reason")


@query("""
WITH w(brand, stat, weight) AS (VALUES ('1', 'size', 1.5::DOUBLE), ('1', 'price', 0.01), ('1', 'key', 0.0), ('2', 'size', 0.5), ('2', 'price', 0.02), ('3', 'size', 2.0)),
v AS (SELECT p_partkey, substr(p_brand, 7, 1) AS brand, 'size' AS stat, p_size::DOUBLE AS v FROM part UNION ALL SELECT p_partkey, substr(p_brand, 7, 1), 'price', p_retailprice FROM part UNION ALL SELECT p_partkey, substr(p_brand, 7, 1), 'key', p_partkey % 10 FROM part)
SELECT p_partkey, round(coalesce(sum(v * weight), 0), 4) AS score FROM v LEFT JOIN w ON w.brand = v.brand AND w.stat = v.stat GROUP BY 1""")
def table_weights(s: SparkSession, d: str) -> DataFrame:
    """Scores by a table of weights for each class and stat."""
    weights = s.createDataFrame([("1", "size", 1.5), ("1", "price", 0.01), ("1", "key", 0.0), ("2", "size", 0.5), ("2", "price", 0.02), ("3", "size", 2.0)], "brand string, stat string, weight double")
    rows = table(s, d, "part").select("p_partkey", F.substring("p_brand", 7, 1).alias("brand"), F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"), (F.col("p_partkey") % 10).cast("double").alias("key"))
    return scoring.weighted(rows, "p_partkey", "brand", ["size", "price", "key"], weights).select("p_partkey", F.round("score", 4).alias("score"))


@query("""
WITH c(event_type, low, high) AS (VALUES ('click', 10, 19), ('click', 20, 29), ('view', 10, 19), ('purchase', 30, 39), ('chat', 10, 19)), q AS (SELECT event_type, user_id % 40 // 10 * 10 AS low, count(DISTINCT user_id) AS instances, max((value > 90)::INT) AS active FROM events GROUP BY ALL)
SELECT c.event_type, c.low::BIGINT AS low, coalesce(instances, 0) AS instances, coalesce(active, 0) = 1 AS active, CASE WHEN coalesce(active, 0) = 0 AND coalesce(instances, 0) < 12 THEN 12 - coalesce(instances, 0) ELSE 0 END AS missing FROM c LEFT JOIN q ON q.event_type = c.event_type AND q.low = c.low""")
def bracket_census(s: SparkSession, d: str) -> DataFrame:
    """For each configured queue and bracket its instances, whether it is active, and what it lacks of twelve if it is not."""
    asked = s.createDataFrame([("click", 10), ("click", 20), ("view", 10), ("purchase", 30), ("chat", 10)], "event_type string, low long")
    have = table(s, d, "events").groupBy("event_type", (F.floor(F.col("user_id") % 40 / 10) * 10).alias("low")).agg(F.countDistinct("user_id").alias("instances"), F.bool_or(F.col("value") > 90).alias("active"))
    both = asked.join(have, ["event_type", "low"], "left").na.fill(0, ["instances"]).na.fill(False, ["active"])
    return both.withColumn("missing", F.when(~F.col("active") & (F.col("instances") < 12), 12 - F.col("instances")).otherwise(F.lit(0)))


@query("""
WITH n AS (SELECT n_nationkey AS slug, n_name, n_regionkey FROM nation), x AS (SELECT s_nationkey AS slug, min(s_suppkey) AS abbrev FROM supplier GROUP BY 1), t AS (SELECT c_nationkey AS slug, max(c_mktsegment) AS strategy FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
SELECT n_name AS name, n_regionkey AS difficulty, CAST(abbrev AS VARCHAR) AS abbreviation, strategy FROM n LEFT JOIN x ON x.slug = n.slug LEFT JOIN t ON t.slug = n.slug WHERE n_regionkey <= 2""")
def dungeon_suggestions(s: SparkSession, d: str) -> DataFrame:
    """Definitions up to a bound expansion, with an abbreviation and a strategy where there are any: two left joins on the slug."""
    names = table(s, d, "nation").select(F.col("n_nationkey").alias("slug"), "n_name", "n_regionkey")
    short = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("slug")).agg(F.min("s_suppkey").alias("abbrev"))
    plans = table(s, d, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("slug")).agg(F.max("c_mktsegment").alias("strategy"))
    return names.filter(F.col("n_regionkey") <= 2).join(short, "slug", "left").join(plans, "slug", "left").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("difficulty"), F.col("abbrev").cast("string").alias("abbreviation"), "strategy")


@query("""
WITH o(opcode, trigger) AS (VALUES (1, 'loot'), (2, 'trade'), (3, 'invite'), (5, 'death')) SELECT event_id, user_id, trigger FROM events JOIN o ON opcode = event_id % 6""")
def packet_triggers(s: SparkSession, d: str) -> DataFrame:
    """Packets with a known opcode and the trigger they fire."""
    codes = s.createDataFrame([(1, "loot"), (2, "trade"), (3, "invite"), (5, "death")], "opcode long, trigger string")
    return table(s, d, "events").select("event_id", "user_id", (F.col("event_id") % 6).alias("opcode")).join(codes, "opcode").select("event_id", "user_id", "trigger")


SEEDS = "INSERT INTO `seeds` (`id`, `name`, `note`, `share`) VALUES\n(1, 'O''Neil, (a)', NULL, 0.5),\n(2, 'back\\\\slash', '', -1.25),\n(3, '', 'x;y', 3);"


@query("SELECT r_regionkey, coalesce(name, 'none') AS name, note, share FROM region LEFT JOIN (VALUES (1, 'O''Neil, (a)', NULL, 0.5::DOUBLE), (2, 'back\\slash', '', -1.25), (3, '', 'x;y', 3.0)) s(id, name, note, share) ON id = r_regionkey")
def seed_rows(s: SparkSession, d: str) -> DataFrame:
    """Seed rows of a multi-row INSERT, joined to what they describe."""
    rows = [(a, b, c, float(e)) for a, b, c, e in X.inserted_rows(SEEDS, "seeds")]
    seeds = s.createDataFrame(rows, "r_regionkey int, name string, note string, share double")
    return table(s, d, "region").select("r_regionkey").join(seeds, "r_regionkey", "left").withColumn("name", F.coalesce("name", F.lit("none")))


@query("SELECT r_regionkey, r_name, 0::INTEGER AS level, 'x' AS tag, TRUE AS known FROM region")
def added_columns(s: SparkSession, d: str) -> DataFrame:
    """Columns are added where they are missing, r_name is there already; and a probe for the table."""
    rows = relational.with_columns(table(s, d, "region").select("r_regionkey", "r_name"), {"r_name": ("string", "none"), "level": ("int", 0), "tag": ("string", "x")})
    return rows.withColumn("known", F.lit(tables.table_exists(s, f"{d}/region.parquet") and not tables.table_exists(s, f"{d}/absent.parquet")))


@query("""
WITH b AS (SELECT p_brand AS slot, 0 AS faction, max(p_partkey) AS item FROM part WHERE p_size < 30 GROUP BY 1 UNION ALL SELECT p_brand, 1, min(p_partkey) FROM part WHERE p_size > 48 GROUP BY 1)
SELECT slot, item, faction FROM b QUALIFY row_number() OVER (PARTITION BY slot ORDER BY faction DESC) = 1""")
def slot_overrides(s: SparkSession, d: str) -> DataFrame:
    """Each slot's item of the faction, or the general one."""
    parts = table(s, d, "part")
    general = parts.filter("p_size < 30").groupBy(F.col("p_brand").alias("slot")).agg(F.max("p_partkey").alias("item")).withColumn("faction", F.lit(0))
    own = parts.filter("p_size > 48").groupBy(F.col("p_brand").alias("slot")).agg(F.min("p_partkey").alias("item")).withColumn("faction", F.lit(1))
    return relational.override_lookup(general.unionByName(own), ["slot"], "faction").select("slot", "item", "faction")


@query("""
WITH l AS (SELECT DISTINCT s_nationkey AS a, (s_suppkey % 25)::INTEGER AS b FROM supplier), e AS (SELECT a AS one, b AS other FROM l UNION SELECT b, a FROM l)
SELECT one, count(*) AS linked, sum(c) AS members FROM e JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON c_nationkey = other WHERE one <> other GROUP BY 1""")
def linked_accounts(s: SparkSession, d: str) -> DataFrame:
    """Links read in both directions, and whom they reach."""
    links = table(s, d, "supplier").select(F.col("s_nationkey").alias("a"), (F.col("s_suppkey") % 25).cast("int").alias("b")).distinct()
    sizes = table(s, d, "customer").groupBy(F.col("c_nationkey").alias("other")).agg(count().alias("c"))
    both = relational.either_way(links.select("a", "b"), "a", "b").distinct().filter("one <> other")
    return both.join(sizes, "other").groupBy("one").agg(count().alias("linked"), F.sum("c").alias("members"))


@query("""
SELECT doc_id, CASE WHEN lang = 'fr' AND source LIKE '%1' THEN source WHEN lang = 'de' THEN lang ELSE 'base' END AS said, replace(replace(replace(concat('a', replace('xaabbx', 'x', lang), 'b'), 'ab', ''), 'ab', ''), 'ab', '') AS erased FROM documents""")
def localised_texts(s: SparkSession, d: str) -> DataFrame:
    """The text of a language, or the base text where that is null or empty; parts erased until none is left."""
    own = F.when((F.col("lang") == "fr") & F.col("source").endswith("1"), F.col("source")).when(F.col("lang") == "de", F.col("lang")).when(F.col("lang") == "en", "")
    messy = F.concat(F.lit("a"), F.replace(F.lit("xaabbx"), F.lit("x"), F.col("lang")), F.lit("b"))
    return table(s, d, "documents").select("doc_id", X.localised([own, F.lit("base")]).alias("said"), X.erased(messy, "ab").alias("erased"))


@query("SELECT DISTINCT p_size FROM part WHERE p_size > 10 ORDER BY 1 LIMIT 10")
def top_distinct(s: SparkSession, d: str) -> DataFrame:
    """The ten smallest distinct sizes above ten (a top-k report)."""
    return table(s, d, "part").filter("p_size > 10").select("p_size").distinct().orderBy("p_size").limit(10)


@query("""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer), q AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN concat('state ', coalesce(o_orderstatus, 'none')) WHEN 1 THEN concat('position ', c_nationkey) WHEN 2 THEN concat('budget ', CAST(floor(c_acctbal) AS BIGINT)) WHEN 3 THEN concat('target ', coalesce(o_orderkey::VARCHAR, 'none')) ELSE 'invalid request' END AS reply FROM c LEFT JOIN q ON o_custkey = c_custkey""")
def remote_replies(s: SparkSession, d: str) -> DataFrame:
    """Remote commands: what each entity's snapshot answers to state, position, budget and target; other commands are invalid."""
    key = F.col("c_custkey")
    last = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.struct("o_orderkey", "o_orderstatus")).alias("o"))
    command = F.element_at(F.array(*[F.lit(c) for c in ("state", "position", "budget", "target", "dance")]), (key % 5 + 1).cast("int"))
    told = {"state": F.coalesce("o.o_orderstatus", F.lit("none")), "position": F.col("c_nationkey").cast("string"), "budget": F.floor("c_acctbal").cast("string"), "target": F.coalesce(F.col("o.o_orderkey").cast("string"), F.lit("none"))}
    return table(s, d, "customer").join(last, "c_custkey", "left").select("c_custkey", X.reply(command, told).alias("reply"))


@query("""
SELECT p_partkey, round((p_size * 1.0 + 2) * CASE WHEN p_size % 3 = 0 THEN 3 WHEN p_size % 3 = 1 THEN 9 ELSE 1 END * CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 0.75 WHEN 2 THEN 0.6 WHEN 3 THEN 0.4 ELSE 11 END, 4)::DOUBLE AS score FROM part""")
def speed_and_stacks(s: SparkSession, d: str) -> DataFrame:
    """Matched speeds times 3, matched off-hands times 9, the ladder of stacks."""
    size, key = F.col("p_size"), F.col("p_partkey")
    speed = F.when(size % 3 == 0, 3.0).when(size % 3 == 1, 9.0).otherwise(1.0)
    stack = F.element_at(F.array(*[F.lit(x) for x in (1.0, 0.75, 0.6, 0.4, 11.0)]), (key % 5 + 1).cast("int"))
    return table(s, d, "part").select("p_partkey", F.round((size * 1.0 + 2) * speed * stack, 4).alias("score"))


@query("""
WITH x AS (SELECT p_partkey, unnest([1, 2, -3, -4]) AS enchant, p_size, p_retailprice FROM part), c AS (SELECT p_partkey, enchant, round(CASE WHEN enchant > 0 THEN p_size * enchant ELSE p_retailprice / 100 * -enchant END, 4) AS score FROM x)
SELECT p_partkey, enchant, score FROM c QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, list_position([1, 2, -3, -4], enchant)) = 1""")
def best_enchant(s: SparkSession, d: str) -> DataFrame:
    """Of a pool of properties (below 0 a suffix) the one with the best score; the first of equals."""
    e = F.col("c.enchant")
    pool = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(v).alias("enchant")) for i, v in enumerate((1, 2, -3, -4))])
    rows = table(s, d, "part").select("p_partkey", "p_size", "p_retailprice", F.explode(pool).alias("c"))
    score = F.round(F.when(e > 0, F.col("p_size") * e).otherwise(F.col("p_retailprice") / 100 * -e), 4)
    best = rows.groupBy("p_partkey").agg(F.max(F.struct(score.alias("score"), (-F.col("c.place")).alias("p"), e.alias("enchant"))).alias("b"))
    return best.select("p_partkey", "b.enchant", "b.score")


@query("""
WITH p AS (SELECT p_partkey, p_brand, p_size, CAST(round(p_retailprice * 100) AS BIGINT) AS score, CAST(round(p_retailprice * 100) AS BIGINT) + p_partkey % 3 * 500 - 500 AS other FROM part),
u AS (SELECT a.p_partkey, a.p_size, min(b.score) AS closest, bool_or(b.other > b.score) AS elsewhere FROM p a LEFT JOIN p b ON b.p_brand = a.p_brand AND abs(b.p_size - a.p_size) <= 10 AND b.score > a.score GROUP BY ALL)
SELECT p_partkey, CASE WHEN p_size > 40 AND coalesce(elsewhere, FALSE) THEN 0 ELSE closest END AS closest FROM u""")
def closest_upgrade(s: SparkSession, d: str) -> DataFrame:
    """The closest higher score within ten levels; above level 40 none (0) if another spec scores higher on one of them."""
    score = F.round(F.col("p_retailprice") * 100).cast("long")
    parts = table(s, d, "part").select("p_partkey", "p_brand", "p_size", score.alias("score"), (score + F.col("p_partkey") % 3 * 500 - 500 > score).alias("elsewhere"))
    found = sequences.upgrades(parts, "p_brand", "p_size", "score", "p_partkey", 10).select("p_partkey", "closest")
    # the other spec's rows alone, asked by all: does any of them lie above?
    others = sequences.upgrades(parts, "p_brand", "p_size", "score", "p_partkey", 10, has=F.col("elsewhere")).select("p_partkey", (F.col("upgrades") > 0).alias("abort"))
    both = parts.select("p_partkey", "p_size").join(found, "p_partkey").join(others, "p_partkey")
    return both.select("p_partkey", F.when((F.col("p_size") > 40) & F.col("abort"), F.lit(0).cast("long")).otherwise(F.col("closest")).alias("closest"))


@query("""
WITH r AS (SELECT l_suppkey AS quest, l_returnflag AS flag, l_partkey % 10 AS entry, l_orderkey AS guid FROM lineitem WHERE l_quantity > 49), d AS (SELECT quest, flag, entry, guid FROM r UNION ALL SELECT r.quest, 'objective', s_nationkey, r.guid FROM r JOIN supplier ON s_suppkey = quest)
SELECT quest, flag, CAST(entry AS BIGINT) AS entry, string_agg(guid::VARCHAR, ',' ORDER BY guid) AS guids FROM (SELECT DISTINCT quest, flag, entry, guid FROM d) GROUP BY ALL""")
def quest_relations(s: SparkSession, d: str) -> DataFrame:
    """quests' givers and takers, and objectives by way of what drops them, as sorted lists of guids."""
    direct = table(s, d, "lineitem").filter("l_quantity > 49").select(F.col("l_suppkey").alias("quest"), F.col("l_returnflag").alias("flag"), (F.col("l_partkey") % 10).cast("long").alias("entry"), F.col("l_orderkey").alias("guid"))
    needs = direct.join(table(s, d, "supplier").select(F.col("s_suppkey").alias("quest"), F.col("s_nationkey").cast("long").alias("drop")), "quest").select("quest", F.lit("objective").alias("flag"), F.col("drop").alias("entry"), "guid")
    rows = direct.unionByName(needs)
    return rows.groupBy("quest", "flag", "entry").agg(F.array_join(F.sort_array(F.collect_set("guid")).cast("array<string>"), ",").alias("guids"))


def listened(run, before=None, after=None):
    """Execution listeners: a query with what is to be called before it and, with its result, after it; either may give another result."""

    def with_listeners(s: SparkSession, d: str) -> DataFrame:
        early = before(s, d) if before else None
        result = early if early is not None else run(s, d)
        late = after(result) if after else None
        return late if late is not None else result

    return with_listeners


@query("SELECT n_regionkey, count(*) AS n, 'after' AS seen FROM nation GROUP BY 1")
def listened_report(s: SparkSession, d: str) -> DataFrame:
    """Execution listeners around a report: the one after it marks its rows."""
    report = lambda s, d: table(s, d, "nation").groupBy("n_regionkey").agg(count().alias("n"))
    return listened(report, after=lambda df: df.withColumn("seen", F.lit("after")))(s, d)



@query("""
WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS low, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) AS high FROM customer WHERE c_acctbal > 0),
n AS (SELECT n_nationkey, n_regionkey + 1 AS need FROM nation)
SELECT c_nationkey, c_custkey, CASE WHEN low <= need THEN 'first' ELSE 'last' END AS taken FROM r JOIN n ON n_nationkey = c_nationkey WHERE low <= need OR high <= need""")
def pool_assignment(s: SparkSession, d: str) -> DataFrame:
    """From each nation's pool as many of the lowest and of the highest places as it needs; pools are cut to the most that any needs before they are ordered."""
    needs = table(s, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") + 1).alias("need"))
    pool = table(s, d, "customer").filter("c_acctbal > 0").select("c_nationkey", "c_custkey", "c_acctbal")
    return scoring.from_both_ends(pool, "c_nationkey", needs, "need", "c_acctbal", "c_custkey").select("c_nationkey", "c_custkey", "taken")


@query("""
SELECT p_partkey, round((p_size * 2 + p_retailprice / 100) * CASE WHEN p_type LIKE 'SMALL%' THEN 0.1::DOUBLE ELSE 1 END * CASE WHEN p_size % 8 = 0 THEN 1.05::DOUBLE WHEN p_size % 8 < 6 THEN 1 + 0.1::DOUBLE * (p_size % 8) ELSE 1 END * (1 + 0.03::DOUBLE * (p_partkey % 4))
  * CASE WHEN p_partkey % 6 = 0 THEN 3 ELSE 1 END::DOUBLE * (0.25::DOUBLE * (p_partkey % 5) / 4 + 0.75::DOUBLE), 12)::DOUBLE AS score FROM part""")
def modified_scores(s: SparkSession, d: str) -> DataFrame:
    """A score times its modifiers: a penalty by type, the set, the sockets, a matched speed, and a blend by quality."""
    size, key = F.col("p_size"), F.col("p_partkey")
    worn = size % 8
    factors = [
        F.when(F.col("p_type").startswith("SMALL"), 0.1).otherwise(1.0), F.when(worn == 0, 1.05).when(worn < 6, 1 + 0.1 * worn).otherwise(1.0), 1 + 0.03 * (key % 4),
        F.when(key % 6 == 0, 3.0).otherwise(1.0), 0.25 * (key % 5) / 4 + 0.75,
    ]
    return table(s, d, "part").select("p_partkey", F.round(scoring.product([size * 2 + F.col("p_retailprice") / 100, *factors]), 12).alias("score"))


@query("""
WITH q AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'state' WHEN 1 THEN 'state,x' WHEN 2 THEN 'state,-5' WHEN 3 THEN 'dance,' || o_custkey WHEN 4 THEN 'budget,' || o_custkey ELSE 'state,' || o_custkey END AS request, o_custkey FROM orders)
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'invalid request' WHEN 1 THEN 'invalid id' WHEN 2 THEN 'invalid id' WHEN 3 THEN 'invalid request' WHEN 4 THEN concat('budget ', CAST(floor(c_acctbal) AS BIGINT)) ELSE concat('state ', c_mktsegment) END AS reply
FROM q JOIN customer ON c_custkey = o_custkey""")
def remote_requests(s: SparkSession, d: str) -> DataFrame:
    """Remote requests 'command,entity id': taken apart, looked up in the snapshot, answered, or refused as invalid request or id."""
    n, cust = F.col("o_orderkey") % 7, F.col("o_custkey").cast("string")
    request = F.when(n == 0, "state").when(n == 1, "state,x").when(n == 2, "state,-5").when(n == 3, F.concat(F.lit("dance,"), cust)).when(n == 4, F.concat(F.lit("budget,"), cust)).otherwise(F.concat(F.lit("state,"), cust))
    asked = table(s, d, "orders").select("o_orderkey", request.alias("request"))
    parts = asked.withColumn("_p", F.split("request", ",")).withColumn("entity", F.get("_p", F.lit(1)).try_cast("long"))
    snapshot = table(s, d, "customer").select(F.col("c_custkey").alias("entity"), "c_mktsegment", "c_acctbal", F.lit(True).alias("known"))
    told = {"state": F.col("c_mktsegment"), "budget": F.floor("c_acctbal").cast("string")}
    answer = F.when((F.size("_p") != 2) | ~F.col("_p")[0].isin(*told), "invalid request").when(F.col("known").isNull(), "invalid id").otherwise(X.reply(F.col("_p")[0], told))
    return parts.join(snapshot, "entity", "left").select("o_orderkey", answer.alias("reply"))


RULE_LINES = ["click>attack!10,flee!9.5", "view>look!5,wait", "purchase>loot!20", "signup>greet!7,", "error>>broken", "error>a!1!2"]


@query("""
WITH r(event_type, act, rel) AS (VALUES ('click', 'attack', 10.0::DOUBLE), ('click', 'flee', 9.5), ('view', 'look', 5.0), ('view', 'wait', 10.0), ('purchase', 'loot', 20.0), ('signup', 'greet', 7.0))
SELECT event_type, act, count(*) AS fired, round(max(rel * value), 3) AS best FROM events JOIN r USING (event_type) GROUP BY ALL""")
def rules_from_text(s: SparkSession, d: str) -> DataFrame:
    """X15, user-defined rules: lines of text are the rule table; faulty lines give no rules."""
    lines = s.createDataFrame([(x,) for x in RULE_LINES], "line string").select(X.rule(F.col("line")).alias("r")).filter("r IS NOT NULL")
    rules = lines.select(F.col("r.trigger").alias("event_type"), F.explode("r.actions").alias("a")).select("event_type", F.col("a.action").alias("act"), "a.rel")
    fired = table(s, d, "events").select("event_type", "value").join(rules, "event_type")
    return fired.groupBy("event_type", "act").agg(count().alias("fired"), F.round(F.max(F.col("rel") * F.col("value")), 3).alias("best"))
