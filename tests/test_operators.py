import datetime as dt
import heapq
import math

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.operators import folds, graph, relational, scoring, sequences, spatial
from lodestone.plans import catalogue, extended, reports, rules, state, travel  # noqa: F401  (they register their queries)
from lodestone.sources import tables
from lodestone.streaming import keyed, replay


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_lifetimes(spark):
    rows = spark.createDataFrame([(1, 0, 5), (2, 10, 5), (3, 5, 5), (4, None, 9)], "id int, valid int, age int")
    assert values(rows.filter(relational.unexpired(F.col("age"), F.col("valid"))).select("id")) == [(1,), (2,), (4,)]
    assert values(rows.filter("id < 4").select("id", relational.task_value(F.lit(7), F.col("age"), F.col("valid")))) == [(1, 0), (2, 7), (3, 0)]


def test_null_keys_are_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, parent int")
    parent = spark.createDataFrame([(1,), (None,)], "key int")
    assert values(relational.orphans(child, parent, "parent", "key").select("id")) == [(2,), (3,)]


def test_keep_max_on_subject_only(spark):
    rows = spark.createDataFrame([("s", "a", 1), ("s", "a", 2), ("s", "b", 3)], "subject string, receiver string, id int")
    assert values(relational.keep_max_of_group(rows, "subject", ["receiver"], "id").select("id")) == [(2,), (3,)]
    assert values(relational.keep_max_of_group(rows, "subject", ["receiver"], "id", on_subject_only=True).select("id")) == []


def test_asof_floor(spark):
    want = spark.createDataFrame([("a", 10), ("a", 3)], "g string, at int")
    have = spark.createDataFrame([("a", 8, 80), ("a", 5, 50), ("a", 11, 110)], "g string, level int, v int")
    assert values(relational.asof_floor(want, have, ["g"], "at", "level", 4, "v")) == [("a", 10, 80, 8)]
    twice = want.unionByName(want)  # equal requests are answered each
    assert values(relational.asof_floor(twice, have, ["g"], "at", "level", 4, "v")) == [("a", 10, 80, 8)] * 2


@pytest.mark.parametrize(("text", "copper"), [("12g3s4c", 120304), ("5s", 500), ("x", 0), ("1g 5s", 10000), ("3s1g", 0)])
def test_money(spark, text, copper):
    assert spark.createDataFrame([(text,)], "t string").select(X.copper(F.col("t"))).first()[0] == copper


def test_splits_and_erase(spark):
    row = spark.createDataFrame([("a,,b,", "aabb")], "t string, e string")
    assert row.select(X.split_keep_inner(F.col("t"), ",")).first()[0] == ["a", "", "b"]
    assert row.select(X.split_drop_empty(F.col("t"), ",")).first()[0] == ["a", "b"]
    assert row.select(X.erased(F.col("e"), "ab")).first()[0] == ""
    deep = spark.createDataFrame([("a" * 300 + "b" * 300,), ("",), (None,)], "e string")
    assert [r[0] for r in deep.select(X.erased(F.col("e"), "ab")).collect()] == ["", "", None]


def test_routed_commands_of_any_length(spark):
    commands = spark.createDataFrame([("go",), ("go to the old mill now",), ("go",)], "command string")
    said = spark.createDataFrame([(1, "go to the old mill now please"), (1, "go to the old mill now please"), (2, "go to town"), (3, "stay"), (4, "")], "id int, text string")
    got = values(X.routed(said, commands, "text", "command").select("id", "command", "param"))
    assert got == [(1, "go to the old mill now", "please")] * 2 + [(2, "go", "to town")]


def test_product_stops_at_zero(spark):
    rows = spark.createDataFrame([(2.0, 3.0), (2.0, 0.0), (2.0, -1.0)], "a double, b double")
    assert [r[0] for r in rows.select(scoring.product([F.col("a"), F.col("b")])).collect()] == [6.0, None, None]


def test_graph(spark):
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (0, 2, 3.0), (2, 3, -1.0)], "src int, dst int, cost double")
    assert values(graph.closure(edges, 5)) == [(0, 1, 1), (0, 2, 1), (0, 3, 2), (1, 2, 1), (1, 3, 2), (2, 3, 1)]
    assert values(graph.cheapest(edges, 3)) == [(0, 1, 1.0), (0, 2, 2.0), (1, 2, 1.0)]
    assert values(graph.without_detours(edges.filter("cost > 0")).select("src", "dst")) == [(0, 1), (1, 2)]
    close = spark.createDataFrame([(0, 1, 1.0), (0, 2, 1.0), (1, 2, 0.05), (2, 1, 0.05)], "src int, dst int, cost double")
    assert values(graph.without_detours(close).select("src", "dst")) == [(0, 1), (1, 2), (2, 1)]  # not both of two that replace each other
    chain = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (0, 3, 2.9), (3, 0, 1.0)], "src int, dst int, cost double")
    assert (0, 3) not in values(graph.without_detours(chain).select("src", "dst"))  # a way of three
    route = spark.createDataFrame([(1, [0, 1, 2])], "path_id int, path array<int>")
    assert values(graph.route_length(route, edges)) == [(1, 2.0)]


def test_pid_holds_the_integral_while_clamped(spark):
    rows = spark.createDataFrame([(1, i, 10.0) for i in range(5)], "k long, i int, e double")
    assert folds.controlled(rows, "k", "i", "e", 1.0, 1.0, 0.0, -15.0, 15.0).first()["out"] == 15.0


def test_partitions_are_replaced_alone(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "a", "x")], "guid long, key string, value string")
    tables.save_partitions(old, f"{tmp_path}/kv", "guid")
    tables.save_partitions(spark.createDataFrame([(1, "c", "y")], old.schema), f"{tmp_path}/kv", "guid")
    assert values(spark.read.parquet(f"{tmp_path}/kv").select("guid", "key", "value")) == [(1, "c", "y"), (2, "a", "x")]


def test_sources(spark, tmp_path):
    df = spark.range(3)
    assert tables.load_or_build(spark, f"{tmp_path}/c", lambda: df).count() == 3
    assert tables.load_or_build(spark, f"{tmp_path}/c", lambda: spark.range(9)).count() == 3
    assert not tables.table_exists(spark, f"{tmp_path}/t")
    tables.replace_table(spark.range(5), f"{tmp_path}/t")
    old = tables.read_table(spark, f"{tmp_path}/t")
    tables.replace_table(spark.range(7), f"{tmp_path}/t")
    assert (old.count(), tables.read_table(spark, f"{tmp_path}/t").count()) == (5, 7)  # a reader keeps its version
    assert tables.expire_versions(spark, f"{tmp_path}/t") == 1 and tables.table_exists(spark, f"{tmp_path}/t")
    (tmp_path / "conf").write_text("# note\na.b = 12\nc = x\nd = a=b\ne = 12345678901 x\nf = -7z\n")
    assert values(tables.settings(spark, str(tmp_path / "conf"))) == [("a.b", "12", 12), ("c", "x", 0), ("d", "a=b", 0), ("e", "12345678901 x", 12345678901), ("f", "-7z", -7)]
    assert tables.parameterised(spark, "SELECT :x + 1 AS y", x=1).first()[0] == 2
    tables.append_log(spark.createDataFrame([(1, "a")], "id int, what string"), f"{tmp_path}/log")
    tables.append_log(spark.createDataFrame([(2, "b")], "id int, what string"), f"{tmp_path}/log")
    assert [r["id"] for r in spark.read.csv(f"{tmp_path}/log", header=True).orderBy("id").collect()] == ["1", "2"]
    points = spark.createDataFrame([(1, 2, 0.5, 1.0), (1, 1, 0.0, 0.0)], "path int, nr int, x double, y double")
    tables.export_paths(points, "path", "nr", f"{tmp_path}/wkt")
    assert spark.read.csv(f"{tmp_path}/wkt", header=True).first()["wkt"] == "LINESTRING(0.0 0.0,0.5 1.0)"


def test_socket_commands(spark):
    import socketserver
    import threading

    class Lines(socketserver.BaseRequestHandler):
        def handle(self):
            self.request.sendall(b"state,1\ntarget,2\n")

    with socketserver.TCPServer(("127.0.0.1", 0), Lines) as server:
        threading.Thread(target=server.handle_request, daemon=True).start()
        stream = tables.commands(spark, "127.0.0.1", server.server_address[1])
        query = stream.writeStream.format("memory").queryName("commands_seen").start()
        try:
            for _ in range(40):
                query.processAllAvailable()
                if spark.table("commands_seen").count() == 2:
                    break
                threading.Event().wait(0.25)
            assert sorted(r[0] for r in spark.table("commands_seen").collect()) == ["state,1", "target,2"]
        finally:
            query.stop()


def test_pruned_and_budgeted_flows_against_plain_loops(spark, sf):
    cost = {(r["src"], r["dst"]): r["cost"] for r in catalogue.all_edges(spark, sf).collect()}

    def useless(left, e):
        """Whether a way of edges before e is shorter than 1.1 times e."""
        (a, b), c = e, left[e]
        best, todo = {a: 0.0}, [(0.0, a)]
        while todo:
            d, at = heapq.heappop(todo)
            if at == b and d > 0:
                return True
            for (x, y), w in left.items():
                if x == at and (w, x, y) < (c, a, b) and y != a and d + w < 1.1 * c and d + w < best.get(y, math.inf):
                    best[y] = d + w
                    heapq.heappush(todo, (d + w, y))
        return False

    left = dict(cost)
    while gone := [e for e in left if useless(left, e)]:
        left = {e: c for e, c in left.items() if e not in gone}
    assert set(values(catalogue.QUERIES["graph_prune"](spark, sf))) == set(left)

    def dearest(a, gold=90.0):
        """The least (cost, price) to every node over all labels that no other beats."""
        labels, todo = {}, [(0.0, 0.0, a)]
        while todo:
            c, p, at = heapq.heappop(todo)
            if any(x <= c and q <= p for x, q in labels.get(at, [])):
                continue
            labels.setdefault(at, []).append((c, p))
            for (x, y), w in cost.items():
                if x == at and y != a and p + abs(x - y) * 10 <= gold:
                    heapq.heappush(todo, (c + w, p + abs(x - y) * 10.0, y))
        return {y: min(some) for y, some in labels.items() if y != a}

    want = {(a, b): cp for a in {x for x, _ in cost} for b, cp in dearest(a).items()}
    got = {(r["src"], r["dst"]): (r["cost"], r["price"]) for r in catalogue.QUERIES["graph_budget"](spark, sf).collect()}
    assert got.keys() == want.keys() and all(abs(got[e][0] - want[e][0]) < 0.0051 and abs(got[e][1] - want[e][1]) < 1e-6 for e in got)


@pytest.mark.parametrize("whole", [1_000, 0])
def test_nearest_in_widening_cells(spark, monkeypatch, whole):
    import random

    monkeypatch.setattr(spatial, "WHOLE_GROUP", whole)

    random.seed(4)
    rows = [(i, i % 3, random.choice([0.0, random.random() * 10 ** random.randint(-3, 2)]), random.random(), 0.0) for i in range(240)] + [(900, 7, 1.0, 1.0, 1.0), (901, 8, 0.0, 0.0, 0.0), (902, 8, 500.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, g int, x double, y double, z double")
    got = values(spatial.nearest(df, df, "id", "id", "g", 4).select("a", "b", "rank"))
    want = []
    for a in rows:
        near = sorted((round(sum((p - q) ** 2 for p, q in zip(a[2:], b[2:], strict=True)), 6), b[0]) for b in rows if b[1] == a[1] and b[0] != a[0])[:4]
        want += [(a[0], i, k + 1) for k, (_, i) in enumerate(near)]
    assert got == sorted(want)
    assert spatial.nearest(df.filter("false"), df, "id", "id", "g", 4).count() == 0


def test_running_sums_by_buckets(spark):
    rows = spark.createDataFrame([(g, i, i % 7) for g in ("a", "b") for i in range(3000)], "g string, i long, v int")
    got = {(r["g"], r["i"]): r["s"] for r in sequences.running(rows, ["g"], F.floor(F.col("i") / 2), ["i"], F.col("v"), "s").collect()}
    assert all(got[g, i] == sum(k % 7 for k in range(i)) for g in "ab" for i in (0, 1, 2, 999, 2999)) and len(got) == 6000


def test_folds_keep_keys_apart(spark):
    rows = spark.createDataFrame([(k, i, 1) for k in (1, 2, None) for i in range(2500)], "k long, i long, v long").repartition(7)
    counted = folds.folded(rows, ["k"], ["i"], lambda: 0, lambda s, r: (s + r[2], [(r[0], r[1], s)]), "k long, i long, n long", lambda k, s: [(k[0], -1, s)])
    got = values(counted.filter("i = -1").select(F.coalesce("k", F.lit(0)), "n"))
    assert got == [(0, 2500), (1, 2500), (2, 2500)] and counted.filter("i <> n AND i >= 0").count() == 0


def test_value_store_over_several_batches(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    batches = [[(0, 0, 1, "x", 5.0), (1, 10, 4, "x", 7.0), (2, 20, 2, "x", 1.0)], [(3, 30, 2, "x", 0.0), (4, 86_400 * 6, 3, "x", 2.0)], [(5, 86_400 * 6 + 1, 4, "x", 0.5), (6, 86_400 * 6 + 2, 6, "x", 9.0)]]
    for i, rows in enumerate(batches):
        made = spark.createDataFrame([(e, at + dt.timedelta(seconds=t), u, k, v, "") for e, t, u, k, v in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        made.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
        for f in (tmp_path / "events.parquet").glob("*.parquet"):
            if f.stat().st_mtime > 1000:
                __import__("os").utime(f, (i + 1, i + 1))  # files are read in the order of their times
    # 1: expired after five days; 2: deleted by 0; 3 and 6: for ever; 4: replaced, then deleted by a value below 1
    assert values(catalogue.QUERIES["stream_value_store"](spark, str(tmp_path))) == [("3:x", 2), ("6:x", 9)]


def events_in_files(spark, folder, batches):
    """events.parquet, a file for each batch of (event_id, seconds or none, user_id), read in this order."""
    at = dt.datetime(2024, 1, 1)
    for i, rows in enumerate(batches):
        made = spark.createDataFrame([(e, None if t is None else at + dt.timedelta(seconds=t), u, "x", 1.0, "") for e, t, u in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
        made.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        for f in (folder / "events.parquet").glob("*.parquet"):
            if f.stat().st_mtime > 1000:
                __import__("os").utime(f, (i + 1, i + 1))
    return int(at.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000


def test_delayed_commands_of_overlapping_files(spark, tmp_path):
    """No command is lost for coming after later ones, or for being like another one; one without a time is never due."""
    day = 86_400
    zero = events_in_files(spark, tmp_path, [[(0, 0, 1), (5, day * 6, 1)], [(2, day, 1), (1, day * 2, None), (4, day * 3, 2), (4, day * 3, 3)], [(0, 0, 1), (10, None, 1), (3, day * 2, 1)]])
    got = catalogue.QUERIES["stream_delayed_commands"](spark, str(tmp_path))
    want = [("1", 0, 0), ("1", 0, 0), ("1", 2, 3), ("1", 3, 5), ("1", 5, 6), (None, 1, 3)]  # 4 is due on the seventh day
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((k, e, zero + n * day * 1_000_000)) for k, e, n in want)


def test_delayed_commands_wait_for_the_watermark(spark, tmp_path):
    zero = events_in_files(spark, tmp_path, [[(0, 0, 1), (30, 10, 1)], [(7, 20, 1), (-9, 21, 1)], [(15, 40, 2)]])
    stream = replay.event_stream(spark, str(tmp_path)).select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.col("event_id").alias("delay"))
    got = keyed.emitted(keyed.delayed(stream))
    due = {seq: (r - zero) // 1_000_000 for seq, r in got.select("seq", "due").collect()}
    assert due == {0: 0, 7: 27, 30: 40, -9: 12}  # the one due at 55 waits still
    assert [r["seq"] for r in got.orderBy("batch", "due").collect()] == [0, -9, 7, 30] and got.select("batch").distinct().count() == 3


def test_delayed_commands_of_one_key(spark, tmp_path):
    """The work grows in proportion to the commands of a key."""
    import time

    spark.range(1, 20_000, 1, 1).select(F.lit("k").alias("key"), F.timestamp_millis(F.col("id") * 1000).alias("at"), F.col("id").alias("seq"), (F.col("id") % 7).alias("delay")).write.parquet(f"{tmp_path}/c")
    began = time.perf_counter()
    got = keyed.emitted(keyed.delayed(spark.readStream.schema("key string, at timestamp, seq long, delay long").parquet(f"{tmp_path}/c")))
    assert {r["seq"] for r in got.collect()} == {i for i in range(1, 20_000) if i + i % 7 <= 19_999}
    assert time.perf_counter() - began < 60


def test_flee_grid_over_all_points(spark, sf):
    def brute(rows):
        best = {}
        for g in {r[0] for r in rows}:
            at = [(x, y) for h, x, y in rows if h == g]
            for x, y in set(at):
                for a in range(8):
                    for r in (1, 2):
                        fx, fy = x + 0.1 * r * math.cos(a * math.pi / 4), y + 0.1 * r * math.sin(a * math.pi / 4)
                        gaps = [math.sqrt((fx - u) ** 2 + (fy - v) ** 2) for u, v in at]
                        if min(gaps) > 0.02:
                            best[g] = max(best.get(g, 0.0), sum(gaps))
        return best

    rows = [(r["map_id"], r["x"], r["y"]) for r in catalogue.positions(spark, sf).collect()]
    got = {r["map_id"]: r["away"] for r in catalogue.flee_grid(spark, sf).collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 2e-4 for g in got)
    # points on a lattice of the step: the grids' outer places are taken or free, equal points count each
    rows = [(1, i * 0.05, j * 0.05) for i in range(9) for j in range(9)] + [(1, 0.0, 0.0)] * 5 + [(2, 0.0, 0.0)]
    got = {r["g"]: r["away"] for r in spatial.farthest_flight(spark.createDataFrame(rows, "g int, x double, y double"), "g").collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-6 for g in got)


def test_graph_searches_end_with_their_frontier(spark, sf):
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(9)] + [(0, 9, 100.0), (9, 0, 1.0)], "src int, dst int, cost double")
    hops = {(a, b): n for a, b, n in values(graph.closure(chain))}
    assert len(hops) == 90 and hops[0, 8] == 8 and hops[8, 7] == 9
    paths = {(a, b): p for a, b, p in values(graph.shortest_paths(graph.undirected(chain)))}
    assert len(paths) == 90 and paths[0, 5] == [0, 1, 2, 3, 4, 5]
    assert {(a, b): c for a, b, c in values(graph.cheapest(chain))}[0, 9] == 9.0
    cost = {(r["src"], r["dst"]): r["cost"] for r in catalogue.all_edges(spark, sf).collect()}
    nodes = {a for e in cost for a in e}
    for k in nodes:
        for a in nodes:
            for b in nodes:
                if a != b and (a, k) in cost and (k, b) in cost:
                    cost[a, b] = min(cost.get((a, b), math.inf), cost[a, k] + cost[k, b])
    got = {(r["src"], r["dst"]): r["cost"] for r in catalogue.graph_cheapest(spark, sf).collect()}
    assert got.keys() == cost.keys() and all(abs(got[e] - cost[e]) < 0.0051 for e in got)
