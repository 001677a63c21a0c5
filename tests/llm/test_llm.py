"""The ten operators on odd inputs (nulls, empty and long texts, repeats, empty tables, clashing columns) and against brute force."""

import hashlib
import os
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import exact_dedup, fixity, mixing, multiset, near_dedup, pages, pieces, private, registry, sharding, toxicity
from tests.conftest import same_rows

LONG = "word " * 300_000
ODD = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1, "x"), (2, "alpha  beta gamma\tdelta epsilon zeta", "en", "a", 1, "x"), (3, None, None, None, None, None), (4, "", "en", "b", 0, "x"),
    (5, "one two", "en", None, 7, "x"), (6, "ONE two", "en", "b", 7, "x"), (7, LONG, "en", "a", len(LONG), "x"), (8, "   ", "en", "b", 3, "x"), (8, "   ", "en", "b", 3, "x"),
    (None, "one two", "en", "b", 7, "x"), (9, "mail a.b@c.example.org or +1 (523) 555-1055, 10.0.0.300 10.0.0.30 é4111 1111 1111 1111", "en", "b", 7, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumn("component", F.lit(1)).withColumn("_b", F.lit("clash")).withColumn("row", F.lit(0)).withColumn("key", F.lit(None).cast("int"))


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def test_sql(spark, duck, sf):
    for name, sql in registry.SQL.items():
        same_rows(registry.QUERIES[name](spark, sf), duck, sql)


def test_exact_dedup(odd, none):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.verdicts(odd).collect()}
    assert {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 2, True), (None, 5, 2, False), (8, 8, 2, True), (6, 6, 1, True)} <= got
    assert {tuple(r) for r in exact_dedup.verdicts(odd, max_words=1).collect()} == {tuple(r) for r in exact_dedup.verdicts(odd).collect()}  # slices
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicate(odd, max_words=1).collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert exact_dedup.verdicts(none).count() == exact_dedup.deduplicate(none).count() == 0


def test_slices_keep_the_rows_that_one_filter_keeps(spark):
    texts = [f"text {i} of many" for i in range(12_000)]  # three slices at the least number of words
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)] + [(20_000 + i, t) for i, t in enumerate(texts[:50])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = exact_dedup.deduplicate(docs, max_words=1024).collect()
    assert exact_dedup._size(len(rows), 1024)[1] > 1
    assert sorted(r["text"] for r in kept) == sorted(texts)
    assert sorted(map(repr, kept)) == sorted(map(repr, exact_dedup.deduplicate(docs).collect()))


def test_near_dedup(odd, none):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(odd).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (1, 5, True), 6: (1, 5, False), 7: (1, 7, True), 8: (0, 8, True), None: (1, None, True), 9: (8, 9, True)}
    assert near_dedup.near_duplicates(odd).count() == len(ODD)
    assert near_dedup.deduplicate(odd).columns[0] == "doc_id"
    assert near_dedup.near_duplicates(none).count() == 0


def test_blocks_and_chains(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):  # a chain: neighbours alike, ends not; all in large buckets
        words = [f"x{j}" if j < i // 3 else w for j, w in enumerate(base)]
        rows.append((i, " ".join(words) + f" {i % 3}"))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert got == dict(enumerate(root))


def test_sketch_fills_every_coordinate():
    import numpy as np

    for n in (1, 7, 5000):
        items = near_dedup.mix(np.arange(n, dtype=np.uint64))
        assert (near_dedup.sketch(items) == near_dedup.sketch(items.copy())).all()
    a, b = near_dedup.mix(np.arange(4000, dtype=np.uint64)), near_dedup.mix(np.arange(1000, 5000, dtype=np.uint64))
    assert abs((near_dedup.sketch(a) == near_dedup.sketch(b)).mean() - 0.6) < 0.15


def test_sharding(odd, none):
    rows = sharding.shard(odd).collect()
    assert sorted(r["shard"] + 16 * r["slot"] for r in rows) == list(range(len(ODD)))
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["size"] == 1 and by[3]["text_crc32"] == 0
    assert (by[9]["size"], by[9]["text_crc32"]) == (len(ODD[-1][1].encode()) + 1, zlib.crc32(ODD[-1][1].encode()))
    assert sharding.shard(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 17, 1000])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))


def test_private(odd, none):
    by = {r["doc_id"]: r for r in private.find(odd).collect()}
    assert by[9]["spans"] == "email:5:22,phone:26:43,ip:56:65,card:67:86"
    assert by[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (by[9]["n_added"], by[9]["n_spans"], by[3]["n_spans"]) == (0, 4, 0)
    assert private.find(odd).count() == len(ODD) and private.find(none).count() == 0


def test_private_against_plain_patterns(spark, sf):
    plain = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[ -]", "", m)) <= 19 and private.luhn(re.sub("[ -]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want = [(m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(plain.items()) for m in re.finditer(p, r["text"]) if ok(m[0])]
        assert [(s, e, k) for s, _, e, k in sorted(want)] == private.base_spans(r["text"])


def test_private_learns_a_pattern(spark):
    rows = [(i, f"please call us at {'+1 (523) 555-10%02d' % i} for more") for i in range(20)] + [(99, "please call us at 523-555-1099 for more"), (98, "version 523-555-1098 came out")]
    got = {r["doc_id"]: r["spans"] for r in private.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == "phone:18:30" and got[98] == ""


def test_multiset(spark, odd, none):
    rows = spark.createDataFrame([(0, "a b.\nc d.\na b."), (1, "c d.\na b.\na b."), (2, "a b.\nc d.")], "i int, t string").select("i", multiset.fingerprint(F.col("t")).alias("f"), multiset.fingerprint(F.lit("a b.")).alias("g"))
    got = rows.select("i", "f", multiset.plus(F.col("f"), F.col("g")).alias("p"), multiset.minus(F.col("f"), F.col("g")).alias("m")).orderBy("i").collect()
    assert got[0]["f"] == got[1]["f"] == got[2]["p"] != got[2]["f"] == got[0]["m"]
    assert multiset.with_next(none).count() == 0 and multiset.with_next(odd).count() == len(ODD)


def test_fingerprints(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in multiset.op8_fingerprints(spark, sf).collect()}
    for i, r in enumerate(docs):
        cut = len(r["text"]) // 4
        edited = r["text"][: len(r["text"]) - cut] + docs[(i + 1) % len(docs)]["text"][:cut]
        assert got[r["doc_id"]]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert sum(r["near_edited"] for r in got.values()) > 5 * sum(r["near_next"] for r in got.values())


def test_mixing(odd, none):
    rows = mixing.plan(odd, repetition=1.5).collect()
    assert len([r for r in rows if r["epoch"] == 0]) == len(ODD)
    assert abs(sum({r["source"]: r["weight"] for r in rows}.values()) - 1) < 1e-9
    assert mixing.mix(odd).columns == odd.columns and mixing.mix(odd).count() >= len(ODD)
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_reaches_the_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 15_000, "big").when(F.col("id") < 19_000, "mid").otherwise("small").alias("source"))
    rows = mixing.plan(docs, repetition=3.0)
    tokens = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    weights = {r["source"]: r["weight"] for r in rows.select("source", "weight").distinct().collect()}
    assert all(abs(t / sum(tokens.values()) - weights[s]) < 0.002 for s, t in tokens.items())
    assert 2.9 < tokens["small"] / 4000 <= 3.0
    totals = docs.groupBy("source").agg((F.count("*") / 20_000).alias("share"))
    alpha = mixing.solve(totals, entropy=1.0, repetition=None)
    assert abs(mixing.measures(totals, alpha, 1.0)[0][1] - 1.0) < 1e-4


def test_fixity(spark, none):
    rows = [(i, f"http://h/{i}", None if i == 3 else f"<p>{i}" + "x" * (200_000 if i == 4 else 0)) for i in range(64)] + [(7, "http://h/7", "<p>7"), (9, "http://h/9", "other"), (None, None, None), (None, "http://h/n", "<p>n")]
    schema = "page_id long, url string, html string"
    first = fixity.records(spark.createDataFrame(rows, schema).withColumn("at", F.lit("clash")).withColumn("_b", F.lit(1)), 16)
    laid = {(r["page_id"], r["sha256"]): r for r in first.collect()}
    assert sum(r["copies"] for r in laid.values()) == len(rows)
    at = 0
    for r in sorted((r for r in laid.values() if r["archive"] == 0), key=lambda r: (r["at"], r["sha256"])):
        assert r["offset"] == at  # records lie one behind the other
        at += r["length"] * r["copies"]

    def compared(changed):
        second = fixity.records(spark.createDataFrame(changed, schema), 16)
        report = fixity.audit(fixity.tree(first, 16, 4), fixity.tree(second, 16, 4), 16, 4)
        found = fixity.differences(first, second, report.found).collect()
        return {(r["page_id"], r["status"], r["copies"]) for r in found}, report.visited

    assert compared(rows) == (set(), [5, 0, 0])  # four archives and that of null ids: one comparison each
    # a record lost or added in the middle moves no other; the untouched archives cost one comparison
    assert compared([r for r in rows if r[0] != 5]) == ({(5, "missing", 1)}, [5, 4, 4])
    assert compared([*rows, (5, "http://h/5", "more")]) == ({(5, "extra", 1)}, [5, 4, 4])
    assert compared([(p, u, "<b>20" if p == 20 else h) for p, u, h in rows]) == ({(20, "corrupt", 1)}, [5, 4, 4])
    assert compared([r for r in rows if r[0] is not None]) == ({(None, "missing", 1)}, [5, 1, 1])
    assert compared(rows[:-3] + [(7, "http://h/7", "<p>7")] + rows[-2:])[0] == {(7, "extra", 1), (9, "missing", 1)}
    assert fixity.records(spark.createDataFrame([], schema)).count() == 0
    empty = fixity.tree(fixity.records(spark.createDataFrame([], schema), 16), 16, 4)
    assert fixity.audit(empty, empty, 16, 4).visited == [0, 0, 0]


def test_trees_against_plain_hashing(spark, sf):
    """Every node, from the runs of records up, as plain Python hashes it."""
    runs = fixity.records(spark.read.parquet(f"{sf}/pages.parquet"), 64)
    got = {(r["level"], r["archive"], r["node"]): (r["hash"], r["lo"], r["hi"]) for r in fixity.tree(runs, 64, 8).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want, slots = {}, {}
    for r in runs.collect():
        slots.setdefault((r["archive"], r["at"]), []).append(r)
    for (archive, at), rows in slots.items():
        sums = [sum(int(r["sha256"][13 * i : 13 * i + 13] or "0", 16) * r["copies"] for r in rows) for i in range(5)]
        told = [sum(r["copies"] for r in rows), sum(r["length"] * r["copies"] for r in rows), *sums]
        want[0, archive, at] = sha(":".join(map(str, told))), min(r["offset"] for r in rows), max(r["offset"] + r["length"] * r["copies"] for r in rows)
    for level in (1, 2):
        for _, archive, node in sorted(k for k in want if k[0] == level - 1):
            children = sorted((n, *want[k, a, n]) for k, a, n in want if (k, a, n // 8) == (level - 1, archive, node // 8))
            want[level, archive, node // 8] = sha(",".join(f"{n}:{hi - lo}:{h}" for n, h, lo, hi in children)), min(c[2] for c in children), max(c[3] for c in children)
    assert got == want


def test_warc_file(spark, tmp_path):
    records = [b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(x), x) for i, x in enumerate((b"one", b"two\r\n\r\nWARC/1.0", b"three"))]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "a.warc").write_bytes(b"".join(records))
    got = fixity.read_warc(spark, str(tmp_path / "a")).orderBy("at").collect()
    assert [(r["offset"], r["length"], r["sha256"], r["record_id"]) for r in got][:2] == [(0, len(records[0]), hashlib.sha256(records[0]).hexdigest(), "<urn:0>"), (len(records[0]), len(records[1]), hashlib.sha256(records[1]).hexdigest(), "<urn:1>")]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.warc").write_bytes(records[0] + records[2])
    one, two = (fixity.by_record_id(fixity.read_warc(spark, str(tmp_path / x)).withColumn("archive", F.lit("a.warc"))) for x in "ab")
    found = fixity.audit(fixity.tree(one), fixity.tree(two)).found
    assert [(r["record_id"], r["status"]) for r in fixity.differences(one, two, found, "record_id").collect()] == [("<urn:1>", "missing")]


def test_pieces(odd, none):
    from sentencepiece import SentencePieceProcessor

    peer = SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    rows = pieces.encode(odd)
    assert all(r["parity"] and r["round_trip"] and r["ids"] == peer.encode(dict((x[0], x[1]) for x in ODD)[r["doc_id"]] or "") for r in rows.collect())
    assert {(r["doc_id"], r["text"]) for r in pieces.decode(rows).collect()} == {(x[0], x[1] or "") for x in ODD}
    assert pieces.encode(none).count() == 0


def test_parts_give_what_whole_texts_give():
    data = open(pieces.MODEL_PATH, "rb").read()
    texts = ["", " ", "   ", "a", " a", "a  b   c ", "\u2581a \u2581\u2581b", "\u00e9\x00\n\ta\u3000d", "\U0001f600 \U0001f600\U0001f600", "word " * 5000, "x" * 3000, "\ufffd \u2581", "a\r\n b\u00a0c"]
    column = pa.array(texts)
    for some in (column, column.slice(3, 5), column.slice(0, 0)):
        fast, slow = pieces._by_parts(data, some), pieces._by_texts(data, some)
        assert fast[0].to_pylist() == slow[0].to_pylist() and fast[1].to_pylist() == slow[1].to_pylist()
    wrong = pa.array([[1, 2], [], [3]], pa.list_(pa.int32()))
    assert pieces._equal_lists(wrong, pa.array([[1, 3], [], [3, 3]], pa.list_(pa.int32()))).tolist() == [False, True, False]


def test_unigram_model():
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    kinds = {"<unk>": 2, "<s>": 3, "</s>": 3}
    table = [("<unk>", 0.0), ("<s>", 0.0), ("</s>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256)), ("▁", -3.0), ("a", -3.5), ("b", -3.6), ("ab", -4.0), ("▁ab", -4.2), ("▁a", -4.4), ("ba", -6.0)]
    for piece, score in table:
        proto.pieces.add(piece=piece, score=score, type=kinds.get(piece, 6 if piece.startswith("<0x") else 1))
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback, proto.trainer_spec.vocab_size = 1, True, len(table)
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = "identity", True, True
    data = proto.SerializeToString()
    peer, mine = SentencePieceProcessor(model_proto=data), pieces.build(pieces.parse(data))
    texts = ["ab ab", "abba  baab", "a é b", "bab ", "", "  ", " ab  é\u2581 "]
    for text in texts:
        assert mine.encode(text, add_special_tokens=False).ids == peer.encode(text)
    assert pieces._by_parts(data, pa.array(texts))[0].to_pylist() == [peer.encode(t) for t in texts]


def test_pages(spark, none):
    html = """<!DOCTYPE html><title>t</title><body><header>top</header><nav><a>menu</a></nav><div class="ad">buy</div><script>var x="</p>";</script>
    <article><h1>Head&nbsp;&amp; more</h1><p><b>bold<br><p>two  words <i>in</i>line</p><ul><li>x<li>y</ul><div id=comments>no</div></article><aside>side</aside><form>f</form><footer>&copy;</footer>"""
    rows = [(1, "http://h.example/a", html, "x"), (2, None, None, "x"), (3, "x", "", "x"), (4, "http://h.example/b", "plain <unclosed", "x"), (4, "http://h.example/b", "plain <unclosed", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, low string").withColumn("host", F.lit(3))
    got = [tuple(r) for r in pages.extract(df).orderBy("page_id").collect()]
    text = "Head & more\n\nbold\n\ntwo words inline\n\nx\n\ny"
    assert got[0] == (1, "http://h.example/a", text, len(text))
    assert [(g[2], g[3]) for g in got[1:]] == [("", 0), ("", 0), ("plain <unclosed", 15), ("plain <unclosed", 15)]
    assert pages.extract(df.filter("false")).count() == 0


def test_style_tree_removes_what_all_pages_share(spark):
    rows = [(i, f"https://s.example/{i}", f"<body><div class=top><span>Home</span> <span>News</span></div><div class=x><p>Text {i} of its own</p><p>{'more ' * i}</p></div><div class=end>All rights</div>") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Text 3 of its own\n\nmore more more"


def test_style_tree_reaches_into_articles_and_spares_what_is_beside(spark):
    more = "<div class=strip>Read on at our site</div>"
    shared = [(i, f"https://a.example/{i}", f"<body><article><h1>Head {i}</h1><p>Text {i} is <b>bold {i}</b></p>{more}</article></body>") for i in range(8)]
    cards = [(20 + i, f"https://b.example/{i}", f"<body><div class=story><p>Story {i} itself</p></div><article class=card>Teaser</article></body>") for i in range(8)]
    few = [(40, "https://c.example/0", "<body><div class=story>Story</div><article>Teaser</article></body>")]
    copies = [(50 + i, "https://d.example/0", "<body><article>Same</article></body>") for i in range(7)] + [(60, "https://d.example/1", "<body><article>Other</article><p>Beside</p></body>")]
    # closed inline elements are without a block of their own: they say nothing of the texts of unclosed ones
    unclosed = [(70 + i, f"https://e.example/{i}", f"<body><article><p>Text {i} <b>x</b></p></article></body>") for i in range(30)] + [(100, "https://e.example/u", "<body><article><p><b>Open text<p>Last text</article></body>")]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(shared + cards + few + copies + unclosed, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head 3\n\nText 3 is bold 3"
    assert got[23] == "Story 3 itself"
    assert got[40] == "Story\n\nTeaser"
    assert got[50] == "Same" and got[60] == "Other\n\nBeside"
    assert got[100] == "Open text\n\nLast text"


def test_names_of_noise_are_matched_whole():
    text = lambda html: pages.Page(html).text()
    kept = """<article><h2 id="related-work">Related work</h2><h2 id="comments">On comments</h2><section id="legal-history">History</section><div class="search-results-study">Study</div>
    <section class="related legal notice" role="alert">Part</section><p>Let <math><mi>x</mi></math> be</p><p><label>Label</label></p><object>Object</object><dialog>Dialog</dialog></article>"""
    assert text(kept) == "Related work\n\nOn comments\n\nHistory\n\nStudy\n\nPart\n\nLet x be\n\nLabel\n\nObject\n\nDialog"
    assert text('<body><div id="legal-history">History</div><p>Let <math>x</math> be</p><div class="box legal">no</div><div class="site-footer">no</div><div role=alert>no</div><div id="cookie_banner">no</div></body>') == "History\n\nLet x be"
    assert text('<main><p>Text</p><div class="wide comments">no</div><div class="share-buttons">no</div><nav>no</nav></main>') == "Text"


def test_pages_against_plain_cut(spark, sf):
    import html as h

    got = {r["page_id"]: r["text"] for r in pages.op10_html_extraction(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)
        if inner:
            blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p|li|ul)>", inner[1])]
            assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_toxicity(spark, odd, none, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    empty = toxicity.fit(docs, labels.filter("false"))
    assert {r["score"] for r in toxicity.score(odd, empty).collect()} == {0.0}
    train = spark.createDataFrame([(i, ("you are an idiot and scum " if i % 4 == 0 else "a quiet day in town ") + f"w{i % 50}") for i in range(600)], "doc_id long, text string")
    model = toxicity.fit(train, train.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0).alias("toxic")))
    rows = toxicity.score(train, model).collect()
    held = [(r["doc_id"] % 4 == 0, r["predicted"]) for r in rows if r["held_out"]]
    assert held and all(int(a) == p for a, p in held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert toxicity.reject(odd, model).columns == odd.columns and toxicity.score(none, model).count() == 0


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf).persist()
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() >= before if name == "mixing" else docs.count() <= before
    columns = ["doc_id", "ids", "round_trip", "parity"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))


def test_pipeline_by_hand(spark, sf):
    """Every stage's result, as plain loops over the stage's input give it."""
    from sentencepiece import SentencePieceProcessor

    sf = os.path.join(os.path.dirname(sf), "sf0.01")  # the smaller tables have no document that is toxic beyond doubt
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    schema, stages = docs.schema, dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in docs.collect()]

    def staged(name):
        got = [tuple(r) for r in stages[name](spark, spark.createDataFrame(rows, schema), sf).collect()]
        return got

    model = toxicity.fit(docs, labels)
    want = [r for r in rows if score_by_hand(model, r[1] or "") < 0.5]
    assert sorted(staged("toxicity")) == sorted(want) and len(want) < len(rows)
    rows, least = want, {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0d]+", " ", r[1])
        least[key] = min(least.get(key, r), r)
    want = list(least.values())
    assert sorted(staged("exact_dedup")) == sorted(want) and len(want) < len(rows)
    rows = sorted(want)
    want = [rows[i] for i, r in enumerate(all_pairs([r[1] for r in rows])) if r == i]
    assert sorted(staged("near_dedup")) == want and len(want) < len(rows)
    rows = want
    alpha = mixing.plan(spark.createDataFrame(rows, schema), repetition=corpus_pipeline.MIX_REPETITION).first()["alpha"]
    copies, _ = mixed_by_hand([(r[0], r[3], r[1]) for r in rows], alpha, corpus_pipeline.MIX_REPETITION, mixing.BLOCK_TOKENS)
    by = {r[0]: r for r in rows}
    want = [by[i] for _, _, i in sorted((block, slot, i) for i, _, _, block, slot in copies)]
    assert staged("mixing") == want
    rows, peer = want, SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    assert sorted(staged("tokens")) == sorted((r[0], peer.encode(r[1]), peer.decode(peer.encode(r[1])) == r[1], True) for r in rows)


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    """Nulls in any column, empty and very long texts, ties and repeated rows, clashing names, empty tables."""
    docs = odd.withColumn("block", F.lit(None).cast("string")).withColumn("_row", F.lit("x")).withColumn("score", F.lit(0.5)).withColumn("tie", F.lit(1))
    labels = spark.createDataFrame([(1, 0, 0), (2, None, None), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    labels.filter("false").write.parquet(f"{tmp_path}/none/labels.parquet")
    for table, folder in ((docs, tmp_path), (docs, tmp_path / "none"), (docs.filter("false"), tmp_path)):
        kept = table
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, str(folder))
            assert name == "tokens" or kept.columns == table.columns
        rows = kept.collect()
        assert len(rows) == 0 if table is not docs else {r["doc_id"] for r in rows} == {1, 3, 5, 7, 8, 9}
        assert all(r["parity"] and r["round_trip"] for r in rows)


def score_by_hand(model, text):
    """The score of one text: the trees walked node by node, the calibration by plain interpolation."""
    import math

    if model.trees is None:
        return model.share
    x = toxicity.features(text, model.lexicon)
    margin = model.trees.start
    for feature, cut, left, right, value in model.trees.trees:
        at = 0
        while feature[at] >= 0:
            below = sum(c < x[feature[at]] for c in model.trees.cuts[feature[at]])  # bins by their upper cuts
            at = left[at] if below <= cut[at] else right[at]
        margin += value[at]
    p = 1 / (1 + math.exp(-margin))
    level = p
    if model.knots:
        xs, ys = model.knots
        level = ys[0] if margin <= xs[0] else ys[-1]
        for i in range(1, len(xs)):
            if xs[i - 1] < margin <= xs[i]:
                level = ys[i - 1] + (ys[i] - ys[i - 1]) * (margin - xs[i - 1]) / (xs[i] - xs[i - 1])
                break
    return min(1.0, max(0.0, 0.98 * level + 0.02 * p))


def test_toxicity_scores_by_hand(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        want = score_by_hand(model, r["text"] or "")
        assert abs(got[r["doc_id"]][0] - want) < 1e-9 and got[r["doc_id"]][1] == int(got[r["doc_id"]][0] >= 0.5)
    ties = toxicity.Model({}, None, None, 0.5)  # exactly one half counts as toxic, for scores and for the filter
    assert {r["predicted"] for r in toxicity.score(docs.limit(3), ties).collect()} == {1} and toxicity.reject(docs, ties).count() == 0
    long = spark.createDataFrame([(1, "you idiot " * 200_000), (2, None), (2, ""), (None, "x")], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(long, model).collect())


def test_trees_split_where_the_gain_is_largest():
    import numpy as np

    random = np.random.default_rng(5)
    x = np.round(random.normal(size=(80, 3)), 1)
    y = (x[:, 1] + 0.3 * random.normal(size=80) > 0.2).astype(float)
    trees = toxicity.Trees(rounds=3, depth=2).fit(x, y)
    margin = np.full(80, trees.start)
    for feature, cut, left, right, value in trees.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)

        def grown(rows, node, depth):
            total_g, total_h = sum(g[r] for r in rows), sum(h[r] for r in rows)
            assert abs(value[node] - trees.rate * total_g / (total_h + trees.l2)) < 1e-9
            gains = {}
            for j in range(3):
                for k, c in enumerate(trees.cuts[j]):
                    low = [r for r in rows if x[r, j] <= c]
                    if trees.least <= len(low) <= len(rows) - trees.least:
                        a, b = sum(g[r] for r in low), sum(h[r] for r in low)
                        gains[j, k] = a**2 / (b + trees.l2) + (total_g - a) ** 2 / (total_h - b + trees.l2) - total_g**2 / (total_h + trees.l2)
            if feature[node] < 0:
                assert depth == trees.depth or len(rows) < 2 * trees.least or max(gains.values(), default=0) <= 1e-6
                for r in rows:
                    margin[r] += value[node]
                return
            assert abs(gains[feature[node], cut[node]] - max(gains.values())) < 1e-9
            at = trees.cuts[feature[node]][cut[node]]
            grown([r for r in rows if x[r, feature[node]] <= at], left[node], depth + 1)
            grown([r for r in rows if x[r, feature[node]] > at], right[node], depth + 1)

        grown(range(80), 0, 0)
    assert np.allclose(margin, trees.margins(x))


def test_isotonic_against_the_minimax_formula():
    import numpy as np

    random = np.random.default_rng(3)
    x = random.permutation(60).astype(float)
    y = (x + 25 * random.normal(size=60) > 30).astype(float)
    xs, ys = toxicity.isotonic(x, y)
    o = np.argsort(x)
    means = [max(min(y[o][j : k + 1].mean() for k in range(i, 60)) for j in range(i + 1)) for i in range(60)]
    want_x, want_y = [], []
    for level in sorted(set(round(m, 12) for m in means)):
        inside = [i for i, m in enumerate(means) if abs(m - level) < 1e-9]
        want_x += [x[o][inside[0]], x[o][inside[-1]]]
        want_y += [(level * len(inside) + 0.05) / (len(inside) + 0.5)] * 2
    # the counts of a block pull its level towards the middle, never past the one before
    assert np.allclose(xs, want_x) and np.allclose(ys, np.maximum.accumulate(want_y))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abß1@ _é.-!*$0"), max_size=40))
def test_mixed_words_are_found_as_the_plain_pattern_finds_them(text):
    plain = re.findall(r"[^\W\d_]+(?:[0-9@$!*.\-]+[^\W\d_]+)+", text)
    assert toxicity._MIXED.findall(text) == plain and bool(toxicity._SOME_MIXED.search(text)) == bool(plain)


def test_features_by_hand(spark, sf):
    lexicon = {"that": 3.0, "ininin": 1.5, "theco*": 2.0}
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect():
        text = (r["text"] or "") + " You ID1OT! st*pid"
        got = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon), strict=True))
        words = re.findall(r"[^\W\d_]+", text.lower())
        raw = text.encode()
        count = lambda chars: sum(b in chars for b in raw)
        upper, lower = count(range(65, 91)), count(range(97, 123))
        assert abs(got["fixed_density"] - sum(w in toxicity.INSULTS for w in words) / len(words)) < 1e-12
        assert abs(got["learned_density"] - sum(lexicon.get(w, 0) for w in words) / len(words)) < 1e-12
        assert abs(got["prefix_density"] - sum(lexicon.get(w[:5] + "*", 0) for w in words if len(w) > 5) / len(words)) < 1e-12
        assert abs(got["second_density"] - sum(w in toxicity.SECOND for w in words) / len(words)) < 1e-12
        assert (got["capitals"], got["shouts"], got["digits"]) == (upper / max(1, upper + lower), count(b"!?") / len(raw), count(b"0123456789") / len(raw))
        assert got["mixed_hits"] >= __import__("math").log1p(1)  # ID1OT, undone


def test_repeated_ids_with_other_texts_keep_their_links(spark):
    rows = [(1, "a b c d e f g h i j"), (1, "k l m n o p q r s t"), (3, "k l m n o p q r s t u"), (4, "a b c d e f g h i j"), (2, "other words that stand alone in here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect())
    assert got == [(1, 6, 1, True), (1, 6, 1, True), (2, 3, 2, True), (3, 7, 1, False), (4, 6, 1, False)]
    assert sorted(map(tuple, near_dedup.deduplicate(docs).collect())) == sorted([rows[0], rows[1], rows[4]])
    crossed = spark.createDataFrame([(5, "a b c d e f"), (5, "k l m n o p q r s t"), (3, "k l m n o p q r s t u")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(crossed).collect()) == [(3, 3), (5, 3), (5, 5)]
    assert sorted(r["text"] for r in near_dedup.deduplicate(crossed).collect()) == ["a b c d e f", "k l m n o p q r s t u"]


def all_pairs(rows):
    """The component of each row, by holding every text against every other."""
    words = [[w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] for t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * min(len(sets[i]), len(sets[j])) >= 75 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_near_dedup_against_all_pairs(spark, sf, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)  # several blocks in a group
    monkeypatch.setattr("lodestone.llm._shared.HOT_ROWS", 3)  # hot keys
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = [f"w{i}" for i in range(60)]
    rows += [(10_000 + i, " ".join(f"x{j}" if j < i // 3 else w for j, w in enumerate(base)) + f" {i % 3}") for i in range(90)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {rows[i][0]: rows[r][0] for i, r in enumerate(all_pairs([t for _, t in rows]))}


def test_hot_texts_and_slices(spark):
    texts = [("hot", i) for i in range(1000)] + [(f"text {i % 150}", 2000 + i % 400) for i in range(1200)] + [(f"lone {i}", 7) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for t, i in texts], "doc_id long, text string, text_sha256 string")
    one, many = (sorted(map(tuple, exact_dedup.verdicts(docs, max_words=w).collect())) for w in (exact_dedup.MAX_WORDS, 64))
    assert one == many and exact_dedup._size(len(texts), 64)[1] > 5
    least, size = {}, {}
    for t, i in texts:
        least[t], size[t] = min(i, least.get(t, i)), size.get(t, 0) + 1
    assert one == sorted((i, least[t], size[t], i == least[t], hashlib.sha256(t.encode()).hexdigest()) for t, i in texts)
    kept = [sorted(map(tuple, exact_dedup.deduplicate(docs, max_words=w).collect())) for w in (exact_dedup.MAX_WORDS, 64)]
    assert kept[0] == kept[1] == sorted((least[t], t, "x") for t in least)


def scored_by_hand(texts):
    """The accepted patterns and the spans, as plain loops over the occurrences give them."""
    found = [list(private.occurrences(t, private.base_spans(t))) for t in texts]
    graph, seeds = {}, set()
    for rows in found:
        for pattern, instance, kind, seed, _, _ in rows:
            graph.setdefault((pattern, kind), set()).add(instance)
            if seed:
                seeds.add((instance, kind))
    accepted, trust = {}, dict.fromkeys(seeds, 1.0)
    while True:
        new = {}
        for (pattern, kind), instances in graph.items():
            given = [trust.get((i, kind), 0.0) for i in instances]
            if (pattern, kind) not in accepted and sum(x >= 0.5 for x in given) >= private.SUPPORT and sum(given) / len(given) >= private.CONFIDENCE:
                new[pattern, kind] = sum(given) / len(given)
        if not new:
            break
        accepted |= new
        doubt = {}
        for key, confidence in accepted.items():
            for i in graph[key]:
                doubt[i, key[1]] = doubt.get((i, key[1]), 1.0) * max(1e-9, 1 - confidence)
        trust = {k: 1.0 if k in seeds else 1 - d for k, d in doubt.items()} | dict.fromkeys(seeds, 1.0)
    order = {k: i for i, k in enumerate(private.ALL_KINDS)}
    spans = []
    for text, rows in zip(texts, found, strict=True):
        more = {}
        for pattern, _, kind, seed, start, end in rows:
            if (not seed or kind == "secret") and (pattern, kind) in accepted:
                more[start, end] = min(more.get((start, end), kind), kind, key=order.get)
        every = [(s, order[k], e, k) for s, e, k in private.base_spans(text)] + [(s, order[k], e, k) for (s, e), k in more.items()]
        spans.append(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(every)))
    return set(accepted), spans


def test_private_finds_unseen_identifiers(spark, sf):
    """Identifiers that no base pattern knows, in contexts that seeds have, directly and through others: recall of the added spans."""
    planted, texts = [], []

    def plant(i, before, unseen, after, kind):
        text = f"Note {'abcdefghij'[i % 10]} says: {before}{unseen}{after} and more words follow"
        planted.append((len(texts), f"{kind}:{text.index(unseen)}:{text.index(unseen) + len(unseen)}"))
        texts.append(text)

    for i in range(30):
        texts += [f"word{i} call us at +1 (523) 555-10{i:02d} for help", f"word{i} write to user{i}@mail.example.org for help", f"the host 10.0.{i}.7 went down, {i}", f'x token = "{hashlib.sha1(str(i).encode()).hexdigest()}" y']
        plant(i, "call us at ", f"0523 555 12{i:02d}", " for help", "phone")
        plant(i, "write to ", f"user{i} [at] host{i}.example.net", " for help", "email")
        plant(i, "the host ", f"2001:db8:0:0:0:0:0:{i:x}", " went down,", "ip")
        plant(i, 'x token = "', f"sk_live_{i:02d}ABCDEFGH{i:04d}", '"', "secret")
        plant(i, "ring Tel : ", f"0523 555 12{i:02d}", " now", "phone")  # a pattern that only unseen ones have
        plant(i, "ring Tel : ", f"0700 111 44{i:02d}", " now", "phone")
    clean = [f"version 523-555-10{i:02d} came out in {1990 + i} with part ABCD-{i:04d}-EFGH-0123" for i in range(30)]
    docs = [(i, t) for i, t in enumerate(texts + clean)]
    got = {r["doc_id"]: r["spans"] for r in private.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    recall = sum(span in got[i].split(",") for i, span in planted) / len(planted)
    print(f"recall of {len(planted)} planted identifiers: {recall:.3f}")
    assert recall >= 0.9, recall
    assert all(got[len(texts) + i] == "" for i in range(len(clean)))
    _, want = scored_by_hand([t for _, t in docs])
    assert [got[i] for i in range(len(docs))] == want


def test_private_against_plain_loops(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r["spans"] for r in private.op7_private_data(spark, sf).collect()}
    _, want = scored_by_hand([r["text"] or "" for r in rows])
    assert [got[r["doc_id"]] for r in rows] == want


def test_private_is_linear_in_the_text():
    import time

    began = time.process_time()
    for text in ("1 " * 100_000, "1:" * 50_000, "1.2.3.4.5" * 10_000, "a@" * 50_000, "é" * 100_000 + " 1", "é4111111111111111" * 5_000, "(" * 100_000 + "1"):
        list(private.occurrences(text, private.base_spans(text)))
    assert time.process_time() - began < 20


def page_text(html, low=frozenset()):
    return pages.Page(html, low).text()


def test_inline_noise_goes_and_layout_names_spare_the_article():
    assert page_text('<article><p>Text <span class="ad">BUY NOW</span> and <button>Click</button> more</p><button>Subscribe</button><p>End</p><svg><text>x</text></svg></article>') == "Text and more\n\nEnd"
    assert page_text('<div class="content with-sidebar"><article><p>One</p></article></div>') == "One"
    assert page_text('<div class="sidebar"><p>Links</p><article><p>One</p></article></div><div class="footer">f</div>') == "One"
    assert page_text('<form><div>Field</div><main><p>One</p><form>f</form></main></form>') == "One"
    assert page_text('<article><p>One</p></article><div class="sidebar"><article>Teaser</article></div>') == "One"
    assert page_text('<div id="comments"><article>Reader</article></div><p>One</p>') == "One"
    assert page_text("<head><title>t</title><body><p>One</p>") == "One"
    assert page_text("<p>a<table><tr><td>b</p>c<td>d</table>e") == "a\n\nb\n\nc\n\nd\n\ne"
    assert page_text("<div>a<b>b</div>c</b>d<i>e</div>f") == "ab\n\ncde\n\nf"


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "deep", "<p><b>" * 50_000 + "deep", "<ul><li>" * 30_000 + "x<li>deep", "<div><p>a</div>" * 30_000 + "deep", "<table><tr><td>" * 30_000 + "<p>deep", "<b>" * 50_000 + "</i>" * 50_000 + "deep", "<section>a " * 20_000 + "deep", "<" * 100_000 + "deep", "&amp;" * 50_000 + "deep", "<a href='" * 20_000 + "deep"])
def test_pages_take_linear_time(html):
    import time

    began = time.process_time()
    got = pages.Page(html, stats=True)
    assert time.process_time() - began < 10
    assert got.text().endswith("deep") or "href" in html
    assert sum(len(b[1]) for b in got.blocks) <= len(html)


def tree_by_hand(rows):
    """Texts as a plain recursion over whole trees gives them: html.parser, strings for hashes, counters for entropies."""
    import math
    from collections import Counter, defaultdict
    from html.parser import HTMLParser

    class Dom(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.root = ["", {}, []]
            self.open = [self.root]

        def handle_starttag(self, tag, attrs):
            while tag in pages.BLOCKS and any(e[0] == "p" for e in self.open):
                self.open.pop()
            node = [tag, dict(attrs), []]
            self.open[-1][2].append(node)
            if tag not in pages.VOID:
                self.open.append(node)

        def handle_endtag(self, tag):
            if any(e[0] == tag for e in self.open):
                while self.open.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            self.open[-1][2].append(data)

    def blocks(node, path, noise, out, looks):
        """Appends (path, text) blocks in order to out and to looks[path] the styles of the children; returns whether the node has text."""
        for child in node[2]:
            if isinstance(child, str):
                if not noise:
                    out.append((path, child))
                continue
            tag, attrs, _ = child
            block = tag in pages.BLOCKS or tag == "br"
            sign = tag if not attrs else f"{tag}.{attrs.get('class', '').split(' ')[0]}#{attrs.get('id', '')}"
            if block:
                out.append((path, None if tag != "br" else " "))
            if tag in pages.RAW or tag in pages.VOID:
                continue
            below = (*path, sign) if tag in pages.BLOCKS else path
            if tag in pages.BLOCKS:
                if not looks[path] or looks[path][-1] != sign:
                    looks[path].append(sign)
            blocks(child, below, noise or tag in pages.NOISE_TAGS or attrs.get("class") in pages.NOISE_NAMES, out, looks)
            if block:
                out.append((path, None))

    parsed, styles = {}, defaultdict(dict)
    for page_id, url, html in rows:
        dom, out, looks = Dom(), [], defaultdict(list)
        dom.feed(html)
        dom.close()
        blocks(dom.root, (), False, out, looks)
        folded, text = [], []
        for path, data in [*out, ((), None)]:
            if data is None:
                said = " ".join("".join(t for _, t in text).split())
                if said:
                    folded.append((text[-1][0] if text[-1][1].strip() else next(p for p, t in reversed(text) if t.strip()), said))
                text = []
            else:
                text.append((path, data))
        parsed[page_id] = folded
        contents = defaultdict(list)
        for path, said in folded:
            for k in range(1, len(path) + 1):
                contents[path[:k]].append((path[k:], said))
        host = re.sub(r"^[a-z]+://([^/?#:]*).*", r"\1", url.lower(), flags=re.S)
        for path, said in contents.items():
            styles[host, path][html] = (tuple(looks[path]), tuple(said))
    low = set()
    for (host, path), seen in styles.items():
        if (n := len(seen)) >= pages.PAGES:
            part = lambda i: 1 - sum(c * math.log(c) for c in Counter(v[i] for v in seen.values()).values()) / (n * math.log(n))
            if pages.GAMMA * part(1) + (1 - pages.GAMMA) * part(0) < pages.LEAST:
                low.add((host, path))
    got = {}
    for page_id, url, _ in rows:
        host = re.sub(r"^[a-z]+://([^/?#:]*).*", r"\1", url.lower(), flags=re.S)
        kept = [t for p, t in parsed[page_id] if not any((host, p[:k]) in low for k in range(1, len(p) + 1))]
        got[page_id] = "\n\n".join(kept or [t for _, t in parsed[page_id]])
    return got, low


def test_pages_against_whole_trees(spark, sf):
    """All given pages, and sites whose articles hold what the tree alone can tell: it changes their results."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    strip = "<div class=strip><p>Read on at our site</p><p>More</p></div>"
    rows += [(1_000_000 + i, f"https://t.example/{i}", f"<body><div class=top>Home</div><article><h1>Head {i}</h1><p>Text {i}</p>{strip}<div class=by>By {'AB'[i % 2]}</div><p>{'end ' * i}</p></article></body>") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want, low = tree_by_hand(rows)
    assert got == want
    assert got[1_000_003] == "Head 3\n\nText 3\n\nBy B\n\nend end end" and page_text(rows[-9][2]) != got[1_000_003]
    assert any(h == "t.example" and p[-1] == "div.strip#" for h, p in low)


def test_pages_of_large_hosts_are_dealt(spark, monkeypatch):
    rows = [(i, f"https://t.example/{i}", f"<div class=top>Home</div><p>Text {i}</p>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    one = sorted(map(tuple, pages.extract(df).collect()))
    monkeypatch.setattr(pages, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(pages, "PAGES_PER_PART", 10)
    assert sorted(map(tuple, pages.extract(df).collect())) == one and one[3][2] == "Text 3"


def xx(seed, *values):
    """Spark's xxhash64 over long and string values, from the seed on."""
    import xxhash

    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else v[0].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def mixed_by_hand(rows, alpha, repetition, block_tokens):
    """(doc_id, source, epoch, block, slot) of every copy, and the weights, with sorted lists; rows: (doc_id, source, text)."""
    counted = [(i, s or "", max(1, len(re.findall(r"[^\x20\x09-\x0d]+", t or "")))) for i, s, t in rows]
    total = sum(n for _, _, n in counted)
    of = {s: sum(n for _, q, n in counted if q == s) for _, s, _ in counted}
    shares = {s: t / total for s, t in of.items()}
    assert abs(alpha - max(0.0, 1 - __import__("math").log(repetition) / __import__("math").log(max(shares.values()) / min(shares.values())))) < 1e-6
    z = sum(x**alpha for x in shares.values())
    epochs = {s: x ** (alpha - 1) for s, x in shares.items()}
    least = min(epochs.values())
    blocks = max(1, round(total * z / least / block_tokens))
    out, filled = [], {}
    for source in of:
        before, times = 0, epochs[source] / least
        full = int(times + 1e-9)
        for key, i, n in sorted((xx(42, i, source, (mixing.SEED,)), i, n) for i, s, n in counted if s == source):
            for epoch in range(full + (before + n <= (times - full) * of[source])):
                block = min(blocks - 1, int((epoch * of[source] + before) / (times * of[source]) * blocks))
                filled.setdefault(block, []).append((xx(42, key, (epoch,), (mixing.SEED,)), i, epoch, source))
            before += n
    for block, some in filled.items():
        out += [(i, source, epoch, block, slot) for slot, (_, i, epoch, source) in enumerate(sorted(some))]
    return sorted(out), {s: x**alpha / z for s, x in shares.items()}


def test_mixing_against_sorted_lists(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    for block_tokens in (mixing.BLOCK_TOKENS, 5_000):
        got = mixing.plan(docs, block_tokens=block_tokens).collect()
        want, weights = mixed_by_hand(rows, got[0]["alpha"], mixing.REPETITION, block_tokens)
        assert sorted((r["doc_id"], r["source"], r["epoch"], r["block"], r["slot"]) for r in got) == want
        assert all(abs(weights[r["source"]] - r["weight"]) < 1e-9 for r in got)
    place = {(b, s): i for i, _, _, b, s in want}
    mixed = [r["doc_id"] for r in mixing.mix(docs, block_tokens=5_000).collect()]
    assert mixed == [place[k] for k in sorted(place)]  # in the order of block and slot
    tokens = {i: max(1, len((t or "").split())) for i, _, t in rows}
    for block in {b for b, _ in place} if len({b for b, _ in place}) > 3 else ():
        inside = [(s, tokens[i]) for i, s, _, b, _ in want if b == block]
        for source, weight in weights.items():  # every block has the weights, but for a document at either end
            part = sum(n for s, n in inside if s == source)
            largest = max(tokens[i] for i, s, _ in rows if s == source)
            assert abs(part - weight * 5_000) <= 2 * largest + 500


def test_mixing_query_tempers_uneven_sources(spark, tmp_path):
    """One source has ten times the tokens of each of the others; natural shares would leave it more than half."""
    docs = spark.range(19_000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 10_000, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = mixing.op9_mixing(spark, str(tmp_path)).persist()
    copies = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    assert rows.select("doc_id").distinct().count() == 19_000 and copies["big"] == 10_000
    assert all(3_990 <= n <= 4_000 for s, n in copies.items() if s != "big") and len(copies) == 10
    weights = {r["source"]: r["weight"] for r in rows.select("source", "weight").distinct().collect()}
    assert abs(rows.first()["alpha"] - 0.39794) < 1e-4 and weights["big"] < 0.22  # 1 - log 4 / log 10
    assert all(abs(n / sum(copies.values()) - weights[s]) < 0.002 for s, n in copies.items())


def test_pipeline_tempers_uneven_sources(spark, sf):
    docs = spark.range(1_900).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 1_000, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    copies = {r["source"]: r["count"] for r in dict(corpus_pipeline.STAGES)["mixing"](spark, docs, sf).groupBy("source").count().collect()}
    assert copies.pop("big") == 1_000 and len(copies) == 9 and all(390 <= n <= 400 for n in copies.values())


def test_mixing_repeats_rows_and_not_ids(spark):
    rows = [(1, "a b c", "big", "x")] * 3 + [(1, "other text", "big", "x"), (1, "a b c", "big", None), (None, "a b c", "small", "y"), (None, None, "small", "y"), (2, "w " * 40, "big", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, slot string")
    planned = mixing.plan(docs, repetition=1.0).collect()
    assert len(planned) == len(rows) and sorted(map(repr, mixing.mix(docs, repetition=1.0).collect())) == sorted(map(repr, docs.collect()))
    planned, mixed = mixing.plan(docs, repetition=4.0).count(), mixing.mix(docs, repetition=4.0).collect()
    assert planned == len(mixed) > len(rows) and {repr(r) for r in mixed} == {repr(r) for r in docs.collect()}


def test_shards_against_plain_permutation(spark, sf):
    """Numbers by bucket, hash and doc_id, the Feistel network and its walk, in plain Python."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n = len(docs)
    buckets = 1 << max(0, (-(-n // sharding.ROWS_PER_BUCKET) - 1).bit_length())
    order = sorted((xx(42, i) % buckets, xx(42, i), i) for i, _ in docs)
    a, b = sharding.factors(n)

    def passed(x):
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + xx(42, right, (i,), (sharding.SEED,)) % a) % a
            else:
                right = (right + xx(42, left, (i,), (sharding.SEED,)) % b) % b
        return left * b + right

    want, text = {}, dict(docs)
    for number, (_, _, i) in enumerate(order):
        place = passed(number)
        while place >= n:
            place = passed(place)
        size, crc = len(text[i].encode()) + 1, zlib.crc32(text[i].encode())
        want[i] = (size, crc, "rows", place % sharding.SHARDS, place // sharding.SHARDS, None)
    got = {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["shard"], r["slot"], r["grown_shard"]) for r in sharding.op6_sharding(spark, sf).collect()}
    assert got == want


def fingerprint_by_hand(text):
    parts = [p for p in re.split(r"\n+|(?<=[.!?])[ \t]+", text or "") if p]
    words = [0] * 61
    for p in parts:
        words[0] += 1
        for i in range(3):
            h = xx(42, p, (i,)) % (1 << 64)
            h -= (1 << 64) if h >> 63 else 0
            for j in range(20):
                words[1 + 20 * i + j] = (words[1 + 20 * i + j] + ((h >> j) & multiset.ONES)) & multiset.MASK
    return words


def likeness_by_hand(a, b):
    import math

    def inner(x, y):
        field = lambda w, k: 2.0 * ((w >> (20 * k)) & ((1 << 20) - 1))
        return math.fsum((field(v, k) - x[0]) * (field(w, k) - y[0]) for v, w in zip(x[1:], y[1:], strict=True) for k in range(3))

    if a == b:
        return 1.0
    if not a[0] or not b[0]:
        return 0.0
    ab = inner(a, b)
    return min(1.0, max(0.0, ab / (inner(a, a) + inner(b, b) - ab)))


def test_fingerprints_against_plain_sums(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    texts = [r["text"] or "" for r in docs]
    by = {r["doc_id"]: r for r in multiset.op8_fingerprints(spark, sf).collect()}
    for i, r in enumerate(docs):
        after, cut = texts[(i + 1) % len(docs)], len(texts[i]) // 4
        own, edited, following = (fingerprint_by_hand(t) for t in (texts[i], texts[i][: len(texts[i]) - cut] + after[:cut], after))
        got = by[r["doc_id"]]
        assert (got["n_chars"], got["fingerprint"], got["edited_fingerprint"]) == (len(texts[i]), *("".join(f"{w:015x}" for w in x) for x in (own, edited)))
        assert abs(got["near_edited"] - likeness_by_hand(own, edited)) < 1e-9 and abs(got["near_next"] - likeness_by_hand(own, following)) < 1e-9


def test_next_documents_of_repeated_ids_go_by_a_hash(spark):
    rows = [(1, "a"), (1, "b"), (None, "n"), (2, "c"), (2, "c")]
    got = [(r["doc_id"], r["text"], r["next_text"]) for r in multiset.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, xx(42, r[1])))
    assert sorted(map(repr, got)) == sorted(repr((*r, order[(i + 1) % 5][1])) for i, r in enumerate(order))


def test_buckets_follow_clustered_keys(spark):
    from lodestone.llm._shared import quantile_buckets

    keys = [i if i % 5 else 10**12 + i for i in range(20_000)] + [None] * 3 + [7] * 50
    got = quantile_buckets(spark.createDataFrame([(k,) for k in keys], "k long"), "k", "b", len(keys), 20).collect()
    assert all(r["b"] == -1 for r in got if r["k"] is None) and len(got) == len(keys)
    places = sorted((r["k"], r["b"]) for r in got if r["k"] is not None)
    assert all(x[1] <= y[1] for x, y in zip(places, places[1:], strict=False)) and len({b for k, b in places if k == 7}) == 1
    from collections import Counter

    assert max(Counter(b for _, b in places).values()) < 150
    few = spark.createDataFrame([(1,), (2,), (1,)], "k long")
    assert {r["b"] for r in quantile_buckets(few, "k", "b", 3).collect()} == {0}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab ▁\n\t\x00é☃😀1.  "), max_size=30) | st.text(max_size=30), max_size=6))
def test_any_text_is_encoded_as_sentencepiece_does(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    data = open(pieces.MODEL_PATH, "rb").read()
    ids, back = pieces._by_parts(data, pa.array(texts, pa.string()))
    peer = pieces._peer(data)
    assert ids.to_pylist() == [peer.encode(t) for t in texts]
    assert back.to_pylist() == [peer.decode(peer.encode(t)) == t for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from('0123456789012+-() .@ab:[]"/\n·'), max_size=80))
def test_added_instances_never_overlap_base_spans_or_each_other(text):
    base = private.base_spans(text)
    found = {(s, e, seed and k != "secret") for _, _, k, seed, s, e in private.occurrences(text, base)}
    more = sorted((s, e) for s, e, seed in found if not seed)
    assert all(0 <= s < e <= len(text) for s, e in more)
    assert all(a[1] <= b[0] for a, b in zip(more, more[1:], strict=False))
    assert not any(s < end and start < e for s, e in more for start, end, _ in base)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "<div>", "</div>", "<article>", "</article>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<td>", "<table>", "</table>", "<head>", "<body>", "<script>", "</script>", "x", " y ", "&lt;", "<", "<!--", "-->", "<br>", "<form>", "<main>", "<h1 id='a b'>", "<a href='"]), max_size=40))
def test_any_markup_gives_folded_blocks(parts):
    page = pages.Page("".join(parts), stats=True)
    for kept, whole, _ in page.blocks:
        assert whole and whole == " ".join(whole.split()) and kept == " ".join(kept.split())
    assert len(page._stack) == 1 and not any(page._at.values())
    text = page.text()
    assert text == text.strip() and "\n\n\n" not in text
