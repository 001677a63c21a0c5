"""Named queries over ordered folds, queues and keyed state; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators import folds, scoring
from lodestone.plans.catalogue import SQL, count, query
from lodestone.sources.tables import table
from lodestone.streaming import keyed, replay


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


ORDERED = "o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, epoch_us(ts) AS us FROM events)"


@query(f"""
WITH RECURSIVE {ORDERED}, f AS (
  SELECT event_id, user_id, n, TRUE AS runs, us AS last, (event_id % 5 + 1) * 3600000000 AS delay FROM o WHERE n = 1
  UNION ALL SELECT o.event_id, o.user_id, o.n, us - last >= delay, CASE WHEN us - last >= delay THEN us ELSE last END, CASE WHEN us - last >= delay THEN (o.event_id % 5 + 1) * 3600000000 ELSE delay END FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT event_id, runs FROM f""")
def gated_ticks(s: SparkSession, d: str) -> DataFrame:
    """K1, K5: a user's tick runs when the delay that the last run set (one to five hours) is over."""
    rows = table(s, d, "events").select("user_id", "event_id", micros("ts").alias("at"), ((F.col("event_id") % 5 + 1) * 3_600_000_000).alias("delay"))
    return folds.gated(rows, "user_id", ["at", "event_id"], "at", "delay").select("event_id", "runs")


@query(f"""
WITH RECURSIVE {ORDERED}, f AS (
  SELECT user_id, n, us AS last, value AS cached, 1 AS refreshes FROM o WHERE n = 1
  UNION ALL SELECT o.user_id, o.n, CASE WHEN us - last >= (3600 + o.user_id % 501) * 1000000 THEN us ELSE last END, CASE WHEN us - last >= (3600 + o.user_id % 501) * 1000000 THEN o.value ELSE cached END, refreshes + (us - last >= (3600 + o.user_id % 501) * 1000000)::INT FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT user_id, CAST(max(refreshes) AS BIGINT) AS refreshes, arg_max(cached, n) AS cached, count(*) AS checks FROM f GROUP BY 1""")
def cached_checks(s: SparkSession, d: str) -> DataFrame:
    """A check is served from cache until the key's own time (an hour and up to 500 s of jitter by key) is over."""
    rows = table(s, d, "events").select("user_id", "event_id", "value", micros("ts").alias("at"), ((3600 + F.col("user_id") % 501) * 1_000_000).alias("delay"))
    checked = folds.gated(rows, "user_id", ["at", "event_id"], "at", "delay")
    return checked.groupBy("user_id").agg(F.count_if("runs").alias("refreshes"), F.max_by("value", F.when(F.col("runs"), F.struct("at", "event_id"))).alias("cached"), count().alias("checks"))


@query(f"""
WITH {ORDERED}, r AS (SELECT *, coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM o)
SELECT event_id, CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id, run ORDER BY n) AS BIGINT) AS total FROM r""")
def running_reset(s: SparkSession, d: str) -> DataFrame:
    """A user's running total, set back to 0 by each purchase."""
    rows = table(s, d, "events").select("user_id", "event_id", micros("ts").alias("at"), F.floor("value").cast("long").alias("v"), (F.col("event_type") == "purchase").alias("reset"))
    return folds.running_with_reset(rows, "user_id", ["at", "event_id"], "v", "reset").select("event_id", "total")


@query("""
WITH RECURSIVE t AS (SELECT event_type, time_bucket(INTERVAL 6 hours, ts) AS tick, count(*) AS a FROM events GROUP BY ALL), o AS (SELECT event_type, a, row_number() OVER (PARTITION BY event_type ORDER BY tick) AS n FROM t),
f AS (SELECT event_type, 0::BIGINT AS n, 0::BIGINT AS size, 0::BIGINT AS done, 0::BIGINT AS lost, 0::BIGINT AS warned FROM (SELECT DISTINCT event_type FROM events)
  UNION ALL SELECT f.event_type, o.n, size + least(a, 20 - size) - least(8, size + least(a, 20 - size)), done + least(8, size + least(a, 20 - size)), lost + a - least(a, 20 - size), warned + (size + least(a, 20 - size) > 16)::INT FROM f JOIN o ON o.event_type = f.event_type AND o.n = f.n + 1)
SELECT event_type, arg_max(done, n) AS processed, arg_max(lost, n) AS dropped, arg_max(size, n) AS left, CAST(arg_max(warned, n) AS BIGINT) AS warned FROM f GROUP BY 1""")
def bounded_queue(s: SparkSession, d: str) -> DataFrame:
    """K8: queues of 20 per type; each six hours' events come in while there is room, 8 are worked off, what finds no room is dropped."""
    tick = F.floor(micros("ts") / 21_600_000_000).alias("at")
    ticks = table(s, d, "events").select("event_type", tick).groupBy("event_type", "at").agg(count().alias("arrivals"))
    return folds.bounded_queue(ticks, "event_type", "at", "arrivals", capacity=20, batch=8)


LOOT = f"""
WITH RECURSIVE {ORDERED}, f AS (
  SELECT user_id, 0::BIGINT AS n, []::STRUCT(item BIGINT, seen BIGINT)[] AS kept FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT user_id, n, CASE WHEN list_contains(list_transform(kept, lambda x: x.item), item) THEN kept ELSE list_append(kept, {{'item': item, 'seen': us}}) END FROM (
    SELECT user_id, n, item, us, CASE WHEN len(kept) >= 4 THEN []::STRUCT(item BIGINT, seen BIGINT)[] ELSE kept END AS kept FROM (
      SELECT f.user_id, o.n, CAST(floor(value) AS BIGINT) % 9 AS item, us, CASE WHEN len(kept) >= 4 THEN list_filter(kept, lambda x: x.seen > us - 172800000000) ELSE kept END AS kept FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1))),
k AS (SELECT user_id, unnest(arg_max(kept, n)) AS x FROM f GROUP BY 1)"""


def _loot(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "events").select("user_id", "event_id", micros("ts").alias("at"), (F.floor("value").cast("long") % 9).alias("item"))
    return folds.loot_sets(rows, "user_id", ["at", "event_id"], "item", "at", 4, 172_800_000_000).withColumnRenamed("at", "seen")


@query(LOOT + " SELECT user_id, x.item AS item, x.seen AS seen FROM k")
def loot_set(s: SparkSession, d: str) -> DataFrame:
    """Each user's set of at most four items: when full, what is older than two days goes, or else all."""
    return _loot(s, d)


@query(LOOT + ", w AS (SELECT max(epoch_us(ts)) AS now FROM events) SELECT user_id, x.item AS nearest FROM k, w WHERE x.seen > now - 172800000000 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY abs(x.item - user_id % 9), x.item) = 1")
def nearest_loot(s: SparkSession, d: str) -> DataFrame:
    """Of the items that are not too old the nearest one."""
    now = F.broadcast(table(s, d, "events").agg(F.max(micros("ts")).alias("now")))
    fresh = _loot(s, d).crossJoin(now).filter(F.col("seen") > F.col("now") - 172_800_000_000)
    return scoring.best(fresh, ["user_id"], F.abs(F.col("item") - F.col("user_id") % 9), F.col("item")).select("user_id", F.col("item").alias("nearest"))


@query(f"""
WITH RECURSIVE {ORDERED}, f AS (
  SELECT user_id, 0::BIGINT AS n, []::VARCHAR[] AS stack, NULL::BIGINT AS event_id, NULL::VARCHAR AS stack_name FROM (SELECT DISTINCT user_id FROM events)
  UNION ALL SELECT f.user_id, o.n, CASE WHEN floor(value) % 3 = 0 THEN stack[:-2] ELSE list_append(stack, event_type) END, CASE WHEN floor(value) % 3 = 0 THEN NULL ELSE o.event_id END, concat(event_type, CASE WHEN len(stack) > 0 THEN concat(' [', array_to_string(list_reverse(stack), '|'), ']') ELSE '' END)
  FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1)
SELECT event_id, stack_name FROM f WHERE event_id IS NOT NULL""")
def span_stack(s: SparkSession, d: str) -> DataFrame:
    """Spans that start, with the spans open around them; every third value finishes the innermost one."""
    rows = table(s, d, "events").select("user_id", "event_id", micros("ts").alias("at"), "event_type", (F.floor("value") % 3 == 0).alias("ends"))
    return folds.span_names(rows, "user_id", ["at", "event_id"], "event_type", "ends").select("event_id", "stack_name")


@query("""
WITH w AS (SELECT max(ts) AS now FROM events), a AS (SELECT user_id, event_type, value, event_id FROM events, w WHERE ts > now - INTERVAL 5 days),
k AS (SELECT user_id, event_type, max(value) AS rel, min(event_id) AS first FROM a GROUP BY ALL)
SELECT user_id, event_type, rel FROM k QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rel DESC, first) = 1""")
def queue_expiry(s: SparkSession, d: str) -> DataFrame:
    """Candidates older than five days are removed; equal names keep the largest relevance; the largest is popped."""
    events = table(s, d, "events").select("user_id", "event_type", "value", "event_id", "ts")
    now = F.broadcast(events.agg(F.max("ts").alias("now")))
    alive = events.crossJoin(now).filter("ts > now - INTERVAL 5 DAYS").groupBy("user_id", "event_type").agg(F.max("value").alias("rel"), F.min("event_id").alias("first"))
    return scoring.best(alive, ["user_id"], F.desc("rel"), F.asc("first")).select("user_id", "event_type", "rel")


@query("""
WITH e AS (SELECT event_id, event_type, floor(value * 8) / 8 AS rel, floor(value) % 4 AS how FROM events WHERE value >= 1),
c AS (SELECT event_id, 'before ' || event_type AS act, rel + 0.002 AS rel FROM e WHERE how = 0 UNION ALL SELECT event_id, event_type, rel + 0.001 FROM e WHERE how = 0
  UNION ALL SELECT event_id, 'else ' || event_type, rel + 0.003 FROM e WHERE how IN (1, 2) UNION ALL SELECT event_id, 'after ' || event_type, rel FROM e WHERE how = 3)
SELECT event_id, act, round(rel, 4) AS rel FROM c""")
def candidate_offsets(s: SparkSession, d: str) -> DataFrame:
    """K6: what an action pushes: its prerequisite and its own retry, alternatives when it failed or was impossible, continuers when it was done."""
    events = table(s, d, "events").filter("value >= 1").select("event_id", "event_type", (F.floor(F.col("value") * 8) / 8).alias("rel"), (F.floor("value") % 4).alias("how"))
    name, rel, how = F.col("event_type"), F.col("rel"), F.col("how")
    pushed = scoring.pushed(name, rel, needs=how == 0, done=how == 3)
    return events.select("event_id", F.explode(pushed).alias("c")).select("event_id", "c.act", F.round("c.rel", 4).alias("rel"))


@query("""
WITH w AS (SELECT max(ts) AS now FROM events), l AS (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id || ':' || event_type AS key, v AS value FROM l, w WHERE v <> 0 AND (user_id % 3 = 0 OR date_trunc('millisecond', ts + to_seconds(user_id % 3 * 432000) + INTERVAL 999 microseconds) > date_trunc('millisecond', now))""")
def stream_value_store(s: SparkSession, d: str) -> DataFrame:
    """A store of each user's last value per type, kept by a stream: 0 deletes it, a lifetime of five or ten days (none for every third user) ends it."""
    key = F.concat_ws(":", "user_id", "event_type").alias("key")
    stream = replay.event_stream(s, d).select(key, F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.floor("value").cast("long").alias("value"), (F.col("user_id") % 3 * 432_000).alias("lifetime"))
    return keyed.last_changes(keyed.value_store(stream)).filter("alive").select("key", "value")


@query(f"""
WITH RECURSIVE {ORDERED}, f AS (
  SELECT user_id, n, pow(value - 50, 2) AS least, pow(value - 50, 2) AS total, value AS before, event_id AS entry FROM o WHERE n = 1
  UNION ALL SELECT user_id, n, CASE WHEN hit THEN near ELSE least END, CASE WHEN hit THEN near ELSE total END, value, CASE WHEN hit THEN event_id ELSE entry END FROM (
    SELECT o.user_id, o.n, o.value, o.event_id, least, entry, pow(o.value - 50, 2) AS near, total + pow(o.value - before, 2) AS total, pow(o.value - 50, 2) < 4 OR pow(o.value - 50, 2) < least OR (pow(o.value - 50, 2) < 100 AND pow(o.value - 50, 2) < (total + pow(o.value - before, 2)) / 2) AS hit
    FROM f JOIN o ON o.user_id = f.user_id AND o.n = f.n + 1))
SELECT user_id, arg_max(entry, n) AS entry, arg_max(least, n) <= 100 AS worth FROM f GROUP BY 1""")
def path_shortcut(s: SparkSession, d: str) -> DataFrame:
    """Where each user's path is entered from 50."""
    rows = table(s, d, "events").select("user_id", F.col("event_id").alias("entry"), micros("ts").alias("at"), "value")
    return folds.shortcuts(rows, "user_id", ["at", "entry"], "entry", "value", 50.0, 2.0, 10.0)


@query("""
WITH RECURSIVE b AS (SELECT c_nationkey AS k, min(c_acctbal) AS x0, max(c_acctbal) AS x1, min(c_custkey % 1000) AS y0, max(c_custkey % 1000) AS y1 FROM customer GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY k) AS n FROM b),
f AS (SELECT 0::BIGINT AS n, -13000.0::DOUBLE AS x, -13000.0::DOUBLE AS y, 0.0::DOUBLE AS high, NULL::BIGINT AS k, NULL::DOUBLE AS dx, NULL::DOUBLE AS dy
  UNION ALL SELECT o.n, CASE WHEN x + x1 - x0 + 500 > 3000 THEN -13000 ELSE x + x1 - x0 + 500 END, CASE WHEN x + x1 - x0 + 500 > 3000 THEN y - greatest(high, y1 - y0 + 500) ELSE y END, greatest(high, y1 - y0 + 500), o.k, x - x0, y - y1 FROM f JOIN o ON o.n = f.n + 1)
SELECT k AS nation, round(dx, 2) AS dx, round(dy, 2) AS dy FROM f WHERE k IS NOT NULL""")
def map_layout(s: SparkSession, d: str) -> DataFrame:
    """The boxes of the nations' customers on shelves."""
    y = (F.col("c_custkey") % 1000).cast("double")
    boxes = table(s, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.min("c_acctbal").alias("x0"), F.min(y).alias("y0"), F.max("c_acctbal").alias("x1"), F.max(y).alias("y1"))
    return folds.shelves(boxes, "nation").select("nation", F.round("dx", 2).alias("dx"), F.round("dy", 2).alias("dy"))


def sibling_states(ops: DataFrame, entity: str, name: str, group: str, adds: str, *order: str) -> DataFrame:
    """(entity, name) that are on at the end: a name's last change added it, and no other name of its group was added later."""
    last = ops.groupBy(entity, group, name).agg(F.max_by(adds, F.struct(*order)).alias("_on"), F.max(F.struct(*order)).alias("_at"))
    added = ops.filter(adds).groupBy(entity, group).agg(F.max(F.struct(*order)).alias("_newest"))
    return last.filter("_on").join(added, [entity, group]).filter(F.col("_at") == F.col("_newest")).select(entity, name)


@query(f"""
WITH {ORDERED}, c AS (SELECT user_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN 'a' WHEN event_type IN ('error', 'signup') THEN 'b' ELSE 'c' END AS g, floor(value) % 2 = 0 AS adds, n FROM o),
l AS (SELECT user_id, g, event_type, arg_max(adds, n) AS is_on, max(n) AS n FROM c GROUP BY ALL), m AS (SELECT user_id, g, max(n) AS n FROM c WHERE adds GROUP BY ALL)
SELECT l.user_id, l.event_type FROM l JOIN m ON m.user_id = l.user_id AND m.g = l.g AND m.n = l.n WHERE is_on""")
def sibling_strategies(s: SparkSession, d: str) -> DataFrame:
    """Strategies added (even values) and removed; adding one removes its siblings."""
    kind = F.col("event_type")
    rows = table(s, d, "events").select("user_id", "event_type", F.when(kind.isin("click", "view"), "a").when(kind.isin("error", "signup"), "b").otherwise("c").alias("siblings"), (F.floor("value") % 2 == 0).alias("adds"), micros("ts").alias("at"), "event_id")
    return sibling_states(rows, "user_id", "event_type", "siblings", "adds", "at", "event_id")


@query(f"""
WITH {ORDERED}, s AS (SELECT *, coalesce(abs(value - lag(value) OVER w), 0) AS step, abs(value - 50) AS gap FROM o WINDOW w AS (PARTITION BY user_id ORDER BY n)),
c AS (SELECT *, min(n) FILTER (WHERE gap = least) OVER (PARTITION BY user_id) AS enter FROM (SELECT *, min(gap) OVER (PARTITION BY user_id) AS least FROM s)),
r AS (SELECT *, sum(CASE WHEN n = enter THEN least WHEN n > enter THEN step ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS run FROM c)
SELECT user_id, coalesce(min(n) FILTER (WHERE gap > 60), max(n)) AS first_out, max(n) FILTER (WHERE n >= enter AND round(run, 6) <= 200) AS last_in FROM r GROUP BY 1""")
def path_ranges(s: SparkSession, d: str) -> DataFrame:
    """The first point farther than 60 from the start (else the last one), and the last point within 200 along the path from its nearest point on."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(s, d, "events").select("user_id", "event_id", "ts", "value").withColumn("n", F.row_number().over(w)).withColumn("gap", F.abs(F.col("value") - 50))
    rows = rows.withColumn("step", F.coalesce(F.abs(F.col("value") - F.lag("value").over(w)), F.lit(0.0)))
    near = rows.groupBy("user_id").agg(F.min(F.struct("gap", "n")).alias("_e")).select("user_id", F.col("_e.gap").alias("least"), F.col("_e.n").alias("enter"))
    joined = rows.join(near, "user_id").withColumn("run", F.sum(F.when(F.col("n") == F.col("enter"), F.col("least")).when(F.col("n") > F.col("enter"), F.col("step")).otherwise(0.0)).over(Window.partitionBy("user_id").orderBy("n")))
    inside = (F.col("n") >= F.col("enter")) & (F.round("run", 6) <= 200)
    return joined.groupBy("user_id").agg(F.coalesce(F.min(F.when(F.col("gap") > 60, F.col("n"))), F.max("n")).cast("long").alias("first_out"), F.max(F.when(inside, F.col("n"))).cast("long").alias("last_in"))


@query(SQL["bounded_queue"].replace("SELECT event_type, arg_max(done, n)", "SELECT event_type AS key, arg_max(done, n)"))
def stream_bounded_queue(s: SparkSession, d: str) -> DataFrame:
    """K8: the queues of bounded_queue, as a stream keeps them."""
    stream = replay.event_stream(s, d).select(F.col("event_type").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    return keyed.last_batches(keyed.bounded_queues(stream, 21_600, capacity=20, batch=8))


@query(SQL["loot_set"].replace("SELECT user_id, x.item AS item", "SELECT user_id::VARCHAR AS key, x.item AS item"))
def stream_loot_set(s: SparkSession, d: str) -> DataFrame:
    """The sets of loot_set, as a stream keeps them; items really expire."""
    stream = replay.event_stream(s, d).select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), (F.floor("value").cast("long") % 9).alias("item"))
    return keyed.last_batches(keyed.loot_sets(stream, 4, 172_800))
