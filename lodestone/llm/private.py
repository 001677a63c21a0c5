"""Personal data (operator 7): base patterns, and bootstrapped contextual extraction of identifiers they miss.

Base spans (email, ip, card, phone) are found in one pass per text. They are the seed entities, as are long hexadecimal
strings for a fifth kind, secret, that has no base spans: the words around a seed are lexical patterns. Every other string
that could be an identifier is an instance, with the patterns around it: runs of digits with single spaces and signs between
them, words with an @ or a bracketed "at", long strings of letters and digits. Spark scores the graph of patterns and
instances in rounds: a pattern's confidence is the trust in the instances of its kind that it meets (seeds have trust 1)
over all of them; it is accepted for good if that is at least CONFIDENCE and at least SUPPORT different trusted instances
stand behind it; an instance's trust is 1 - prod(1 - confidence) over its accepted patterns. Rounds go on until no pattern is
added. Instances next to an accepted pattern of their kind are added as spans; so are seeds of the kind secret.
The graph holds hashes of instances, is aggregated by Spark and never collected.

All searches are linear in the text. Defined cases: null and empty texts have no spans; rows that repeat a doc_id each
get the spans of their own text (a repeated row is told apart by a hash of its text); a null doc_id is kept; an added span
never overlaps a base span, and of two kinds for one span the first listed stands; an empty
table gives an empty result. Other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import joined_with_groups, read, ship, slices, text_of, written

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
#: The kinds of all spans, in the order of spans that begin together.
ALL_KINDS = (*KINDS, "secret")
MAX_ROUNDS = 1000
SUPPORT = 5
CONFIDENCE = 0.3

_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end(), "email"))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                    found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    order = {k: i for i, k in enumerate(KINDS)}
    found.sort(key=lambda s: (s[0], order[s[2]]))
    return found


def spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_CANDIDATE = re.compile(
    r"(?P<mail>(?<![^\s<>()\[\]\"',;])[^\s<>()\[\]\"',;@]++(?:@|\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?)[^\s<>()\[\]\"',;]++)"
    r"|(?P<word>[A-Za-z_][0-9A-Za-z_:-]*+)"
    r"|(?P<number>\+?\(?[0-9]++(?:(?:\x20?[-./()·]\x20?|\x20)[-./()]?[0-9]++)*+)"
)
_REST = re.compile(r"[0-9A-Za-z_:-]*+")
_FIGURES = re.compile(r"[0-9]+\Z")
_PART = re.compile(r"\w+|[^\w\s]+")
_SEEN = re.compile(r"[0-9]|@|[\[(]\x20?(?:at|AT)\x20?[\])]")
_HEX = re.compile(r"[0-9a-fA-F]{32,}+")
_SECRET_LEAST = 16


def kinds_of(found: str, form: str) -> tuple[str, ...]:
    """The kinds that a string of a form (mail, number, word) could be of; none for ordinary strings."""
    if form == "mail":
        return ("email",) if "." in found else ()
    if form == "number":
        digits = sum(c.isdigit() for c in found)
        if found.count(".") >= 3 and digits <= 12:
            return ("ip",)
        return (("card",) if 14 <= digits <= 19 else ()) + (("phone",) if 7 <= digits <= 15 else ())
    if found.count(":") >= 2 and all(len(p) <= 4 and all(c in "0123456789abcdefABCDEF" for c in p) for p in found.split(":")):
        return ("ip",)
    letters = any(c.isalpha() for c in found)
    return ("secret",) if len(found) >= _SECRET_LEAST and letters and any(c.isdigit() for c in found) else ()


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _context(word: str) -> str:
    """A word of a pattern: lower case, numbers as 0, without signs around it; signs alone stay; a long word is named by its digest."""
    said = re.sub(r"[0-9]+", "0", word.lower())
    said = said.strip("\"'()[]<>,;.!?") or said
    return said if len(said) <= 40 else f"#{_digest(said):x}"


def occurrences(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[str, int, str, bool, int, int]]:
    """(pattern, instance, kind, seed, start, end) of base spans and of identifier-like strings outside them."""
    if not spans and not _SEEN.search(text):
        return
    items = [(s, e, (k,), True) for s, e, k in spans]
    covered = sorted((s, e) for s, e, _ in spans)
    n = reach = 0
    for m in _CANDIDATE.finditer(text):
        start, end, form = m.start(), m.end(), m.lastgroup
        if start < reach:
            continue
        if form == "mail":
            end = start + len(m[0].rstrip(".:!?"))
        elif form == "number" and (more := _REST.match(text, end).end()) > end:  # the last figures begin a word
            start, end, form = start + _FIGURES.search(m[0]).start(), more, "word"
        while n < len(covered) and covered[n][0] < end:
            reach = max(reach, covered[n][1])
            n += 1
        if reach > start:
            continue
        reach = end
        if kinds := kinds_of(text[start:end], form):
            items.append((start, end, kinds, kinds == ("secret",) and _HEX.fullmatch(text, start, end) is not None))
    if not items:
        return
    items.sort()
    parts = [m.span() for m in _PART.finditer(text)]
    begins = [s for s, _ in parts]
    before_end = 0
    for i, (start, end, kinds, seed) in enumerate(items):
        at = bisect_left(begins, start)  # parts before `at` begin before the item; the last may reach into it
        cut = max(parts[at - 1][0], before_end) if at else 0
        left = [text[max(s, cut) : min(e, start)] if k == at - 1 else text[s:e] for k, (s, e) in enumerate(parts[max(0, at - 3) : at], max(0, at - 3))]
        left = ["^", *(w for w in left if w)][-3:]
        at = bisect_right(begins, end - 1)
        ahead = items[i + 1][0] if i + 1 < len(items) else len(text)
        right = [text[end : max(end, min(parts[at - 1][1], ahead))], *(text[s:e] for s, e in parts[at : at + 2])]
        right = [*(w for w in right if w), "$"][:2]
        before_end = max(before_end, end)
        before, after = [_context(w) for w in left], [_context(w) for w in right]
        patterns = {f"{before[-1]} _ {after[0]}", f"_ {' '.join(after)}", *(f"{' '.join(before[-k:])} _" for k in (2, 3) if len(before) >= k)}
        instance = _digest(text[start:end])
        for kind in kinds:
            for pattern in patterns:
                yield pattern, instance, kind, seed, start, end


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in slices(whole, "text", 4 << 20)):
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            said = spelled(spans)
            kinds = [k for _, _, k in spans]
            found = list(occurrences(text, spans))
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(said.encode()).hexdigest(), said, [dict(zip(("pattern", "instance", "kind", "seed", "start", "end"), f, strict=True)) for f in found]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        near = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.int64()), ("kind", pa.string()), ("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))
        kinds_ = [pa.int64()] * 4 + [pa.string()] * 2 + [near]
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds_, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *arrays], names=["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "near"])


_SCHEMA = "doc_id long, row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, near array<struct<pattern:string,instance:bigint,kind:string,seed:boolean,start:long,end:long>>"


def confident_patterns(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(pattern, kind, confidence) of the accepted patterns of the graph `edges`: distinct (pattern, instance, kind, seed)."""
    seeds = written(edges.filter("seed").select("instance", "kind", F.lit(1.0).alias("trust")).distinct(), "seeds")
    known = written(edges.groupBy("pattern", "instance", "kind").agg(F.bool_or("seed").alias("seed")), "graph")
    trust, accepted, open_ = seeds, None, known
    for _ in range(MAX_ROUNDS):
        trusted = open_.join(trust, ["instance", "kind"], "left").withColumn("trust", F.coalesce("trust", F.lit(0.0)))
        scored = trusted.groupBy("pattern", "kind").agg(F.avg("trust").alias("confidence"), F.count_if(F.col("trust") >= 0.5).alias("behind"))
        new = written(scored.filter((F.col("behind") >= support) & (F.col("confidence") >= confidence)).select("pattern", "kind", "confidence"), "patterns")
        if new.isEmpty():
            return new if accepted is None else accepted
        accepted = written(new if accepted is None else accepted.unionByName(new), "accepted")
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        found = known.filter(~F.col("seed")).join(accepted, ["pattern", "kind"]).groupBy("instance", "kind").agg((1 - doubt).alias("trust"))
        trust = written(seeds.unionByName(found).groupBy("instance", "kind").agg(F.max("trust").alias("trust")), "trust")
        open_ = known.join(accepted, ["pattern", "kind"], "left_anti")
    raise RuntimeError(f"patterns were still added after {MAX_ROUNDS} rounds")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all of them), n_added, n_spans (how many all are)."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    base = written(rows.mapInArrow(_base, _SCHEMA), "base")
    near = written(base.select("doc_id", "row", F.explode("near").alias("x")).select("doc_id", "row", "x.*"), "near")
    patterns = confident_patterns(near.select("pattern", "instance", "kind", "seed").distinct())
    other = near.filter(~F.col("seed") | (F.col("kind") == "secret"))
    uses = written(other.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("uses")).join(patterns.select("pattern", "kind"), ["pattern", "kind"]), "uses")
    total = uses.agg(F.sum("uses")).first()[0] or 0
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in ALL_KINDS]), k)
    added = joined_with_groups(other, uses, ["pattern", "kind"], "uses", total).groupBy("doc_id", "row", "start", "end").agg(F.min_by("kind", rank(F.col("kind"))).alias("kind"))
    added = added.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("_added"))
    joined = base.drop("near").join(added.select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "_added"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row") == F.col("_r")), "left")
    split = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.struct(F.split(s, ":")[1].cast("long").alias("start"), rank(F.split(s, ":")[0]).alias("rank"), F.split(s, ":")[2].cast("long").alias("end"), F.split(s, ":")[0].alias("kind")))
    more = F.transform(F.coalesce("_added", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")), lambda a: F.struct(a["start"].alias("start"), rank(a["kind"]).alias("rank"), a["end"].alias("end"), a["kind"].alias("kind")))
    every = F.array_sort(F.concat(split, more))
    spans = F.when(F.col("_added").isNull(), F.col("base")).otherwise(F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","))
    added_size = F.when(F.col("_added").isNull(), 0).otherwise(F.size("_added"))
    total = F.size(split) + added_size
    return joined.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"), added_size.cast("long").alias("n_added"), total.cast("long").alias("n_spans"))


def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read(spark, sf_dir, "documents"))
