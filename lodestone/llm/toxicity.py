"""Toxicity (operator 1): gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a fixed insult lexicon and of lexicons of words and word beginnings learned from
labelled rows, nearness of second-person words to lexicon words, capitals, punctuation, and obfuscation (letters
mixed with digits and signs, undone before lookup). Labels come from at most `max_rows` labelled rows whose
crc32(doc_id) mod 5 is not 0 (those with the smallest hash of doc_id), split by hash: 2/5 teach the lexicons, 2/5 the
trees, 1/5 the calibration. So the lexicons, the trees and the calibration are each fitted on rows of their own. The
model is a few thousand numbers, shipped with the scoring task; scoring is one pass over all documents, no shuffle.

Defined cases: null and empty texts are scored as texts without words; rows with a null label teach nothing; repeated
rows get equal scores; without labels of both kinds every score is the share of label 1 (0 without labels); an empty
table gives an empty result. Only doc_id and text are read from the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import read, ship, slices, text_of, written

ship(__name__)

MAX_ROWS = 50_000
TERMS = 4_000
MIN_COUNT = 3
PREFIX = 5
HELD_OUT_OF = 5

INSULTS = frozenset(
    """arse arsehole ass asshole bastard bitch bimbo bollocks buffoon clown coward cretin crap creep cunt degenerate dickhead
    dimwit disgusting dolt douchebag dumb dumbass dunce filth filthy fool freak fuck fucker fucking garbage halfwit hate idiot
    idiotic idiots ignorant imbecile jackass jerk kill leech loser losers lowlife maggot moron moronic morons motherfucker nitwit
    pathetic pig prick rat retard retarded rubbish scum scumbag shit slut stupid subhuman swine trash trashy twat ugly useless
    vermin vile wanker weirdo whore worm worthless wretch idiota imbécil estúpido basura asco puta cabrón pendejo gilipollas
    dummkopf arschloch abschaum idioten trottel vollidiot wichser schlampe müll connard salope imbécile crétin ordure débile
    abruti merde putain""".split()
)
SECOND = frozenset("you your yours yourself youre u ur du dich dir dein deine deinen euch ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*.\-]++[^\W\d_]++)++")
#: Whether _MIXED matches anywhere: a sign or digit behind a letter, and then a letter; cheaper, and most texts have none.
_SOME_MIXED = re.compile(r"[0-9@$!*.\-](?<=[^\W\d_][0-9@$!*.\-])[0-9@$!*.\-]*+[^\W\d_]")
_LEET = str.maketrans("013457@$!", "oieastasi")
_SIGNS = re.compile(r"[0-9@$!*.\-]")
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
for _c in b"!?":
    _CLASS[_c] = 3
for _c in b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~":
    _CLASS[_c] = 4
for _c in b"0123456789":
    _CLASS[_c] = 5
FEATURES = (
    "words", "fixed_density", "fixed_hits", "learned_density", "learned_hits", "learned_best", "learned_kinds", "prefix_density", "prefix_best",
    "second_density", "second_near", "capitals", "shouts", "punctuation", "digits", "mixed", "mixed_hits", "fixed_or_learned",
)


def terms_of(words: list[str]) -> set[str]:
    """What the lexicons can hold: words, and beginnings of longer words, marked by a star."""
    return {*words, *(w[:PREFIX] + "*" for w in words if len(w) > PREFIX)}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    fixed = [] if INSULTS.isdisjoint(words) else [i for i, w in enumerate(words) if w in INSULTS]
    learned = [] if lexicon.keys().isdisjoint(words) else [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    begins = [lexicon[p] for w in words if len(w) > PREFIX and (p := w[:PREFIX] + "*") in lexicon]
    second = [] if SECOND.isdisjoint(words) else [i for i, w in enumerate(words) if w in SECOND]
    near = 0.0
    hits = fixed or [i for i, _ in learned]
    if second and hits:
        s, h = np.array(second), np.array(hits)
        at = np.searchsorted(h, s)
        left, right = np.abs(s - h[np.maximum(at - 1, 0)]), np.abs(s - h[np.minimum(at, len(h) - 1)])
        near = 1.0 / (1.0 + float(np.minimum(left, right).min()))
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6) if raw else np.zeros(6, np.int64)
    size = max(1, len(raw))
    mixed = _MIXED.findall(low) if _SOME_MIXED.search(low) else []
    undone = 0
    for token in mixed:
        a, b = _SIGNS.sub("", token), token.translate(_LEET)
        undone += a in INSULTS or b in INSULTS or a in lexicon or b in lexicon
    best = max((w for _, w in learned), default=0.0)
    return [
        np.log1p(len(words)), len(fixed) / n, np.log1p(len(fixed)), sum(w for _, w in learned) / n, np.log1p(len(learned)), best, np.log1p(len({words[i] for i, _ in learned})),
        sum(begins) / n, max(begins, default=0.0), len(second) / n, near, kinds[1] / max(1, kinds[1] + kinds[2]), kinds[3] / size, kinds[4] / size, kinds[5] / size,
        len(mixed) / n, np.log1p(undone), float(bool(fixed) or best > 2.5),
    ]


@dataclass
class Trees:
    """Boosted regression trees on binned features, logistic loss. A tree is arrays of (feature, bin, left, right, value)."""

    rounds: int = 60
    depth: int = 4
    rate: float = 0.12
    bins: int = 48
    l2: float = 2.0
    least: int = 5
    cuts: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            middle = (values[1:] + values[:-1]) / 2
            if len(middle) >= self.bins:
                middle = np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)))
            self.cuts.append(middle)
        b = self.binned(x)
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree, leaf = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += tree[4][leaf]
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        nodes: list[list[float]] = [[-1, 0, -1, -1, 0.0]]
        at = np.zeros(len(g), np.int64)
        level = [0]
        width = max(2, max(len(c) for c in self.cuts) + 1)
        for depth in range(self.depth + 1):
            after = []
            for node in level:
                rows = np.flatnonzero(at == node)
                G, H = g[rows].sum(), h[rows].sum()
                nodes[node][4] = self.rate * G / (H + self.l2)
                if depth == self.depth or len(rows) < 2 * self.least:
                    continue
                best = (1e-6, -1, -1)
                for j in range(b.shape[1]):
                    if not len(self.cuts[j]):
                        continue
                    gs = np.cumsum(np.bincount(b[rows, j], g[rows], width))[:-1]
                    hs = np.cumsum(np.bincount(b[rows, j], h[rows], width))[:-1]
                    ns = np.cumsum(np.bincount(b[rows, j], minlength=width))[:-1]
                    gain = gs**2 / (hs + self.l2) + (G - gs) ** 2 / (H - hs + self.l2) - G**2 / (H + self.l2)
                    gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
                if best[1] < 0:
                    continue
                left, right = len(nodes), len(nodes) + 1
                nodes += [[-1, 0, -1, -1, 0.0], [-1, 0, -1, -1, 0.0]]
                nodes[node][:4] = [best[1], best[2], left, right]
                at[rows] = np.where(b[rows, best[1]] <= best[2], left, right)
                after += [left, right]
            level = after
        table = np.array(nodes)
        return (*(table[:, i].astype(np.int64) for i in range(4)), table[:, 4]), at

    def margins(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = feature[at] >= 0
                go = b[rows, np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            out += value[at]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit (pooled adjacent violators)."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            s, n, _, hi = blocks.pop()
            p, m, lo, _ = blocks[-1]
            blocks[-1] = [(p * m + s * n) / (m + n), m + n, lo, hi]
    xs = [v for _, _, lo, hi in blocks for v in (lo, hi)]
    ys = [v for p, n, _, _ in blocks for v in ((p * n + 0.05) / (n + 0.5),) * 2]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        margin = self.trees.margins(np.array([features(t, self.lexicon) for t in texts]))
        p = 1 / (1 + np.exp(-margin))
        level = np.interp(margin, *self.knots) if self.knots else p
        return np.clip(0.98 * level + 0.02 * p, 0, 1)


def remainder(doc_id: str) -> Column:
    """crc32 of doc_id as text, mod HELD_OUT_OF. A null doc_id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT_OF)), F.lit(0))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in slices(whole, "text")):
        terms, labels = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found = terms_of(_WORD.findall(text.lower()))
            terms += found
            labels += [label] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int32())], names=["term", "label"])


def _matrix(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (some for whole in batches for some in slices(whole, "text")):
            rows = [features(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("part"), batch.column("at"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "part", "at", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """Learns from at most max_rows labelled rows; the rest of the labels is not read beyond their ids."""
    hashed = F.xxhash64("doc_id")
    teach = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter((remainder("doc_id") != 0) & F.col("label").isin(0, 1))
    teach = teach.withColumn("at", hashed).orderBy("at", "label").limit(max_rows).withColumn("part", F.pmod("at", F.lit(5)).cast("int"))
    rows = docs.select(F.col("doc_id"), text_of().alias("text")).join(F.broadcast(teach), "doc_id").select("label", "part", "at", "text")
    rows = written(rows, "labelled")
    by_part = {(r["lexicon"], r["label"]): r["n"] for r in rows.groupBy((F.col("part") < 2).alias("lexicon"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(by_part.values())
    share = (by_part.get((True, 1), 0) + by_part.get((False, 1), 0)) / n if n else 0.0
    bad, good = by_part.get((True, 1), 0), by_part.get((True, 0), 0)
    lexicon: dict[str, float] = {}
    if bad and good:
        counts = rows.filter("part < 2").select("text", "label").mapInArrow(_terms, "term string, label int").groupBy("term").agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("n"))
        odds = F.log((F.col("a") + 0.25) / (bad + 0.5)) - F.log((F.col("n") - F.col("a") + 0.25) / (good + 0.5))
        chosen = counts.filter(F.col("a") >= MIN_COUNT).withColumn("odds", odds).filter("odds > 1")
        chosen = chosen.orderBy(F.desc(F.col("odds") * F.log1p("a")), "term").limit(TERMS)
        lexicon = {r["term"]: float(r["odds"]) for r in chosen.select("term", "odds").collect()}
    table = rows.filter("part >= 2").mapInArrow(_matrix(lexicon), "label int, part int, at long, x array<double>").orderBy("at", "label").collect()
    y, part = np.array([r["label"] for r in table], float), np.array([r["part"] for r in table])
    if len(set(y[part < 4])) < 2:
        return Model(lexicon, None, None, share)
    x = np.array([r["x"] for r in table])
    trees = Trees().fit(x[part < 4], y[part < 4])
    last = part == 4
    knots = isotonic(trees.margins(x[last]), y[last]) if len(set(y[last])) == 2 else None
    return Model(lexicon, trees, knots, share)


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                scores = model.scores(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id") == 0).alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")


def _stay(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (some for whole in batches for some in slices(whole, "text", 4 << 20)):
            yield batch.filter(pa.array(model.scores([t or "" for t in batch.column("text").to_pylist()]) < 0.5))

    return run


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of documents that are not predicted toxic, with all their columns, in one pass."""
    return docs.mapInArrow(_stay(model), docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
