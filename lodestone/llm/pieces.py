"""SentencePiece encoding and decoding (operator 3) on the tokenizers library.

The model file's protobuf is parsed here (its wire format, no generated classes). From it the normaliser (character
map, dummy prefix, extra white space), the metaspace marker, the scores and the byte fallback are rebuilt as a
tokenizers pipeline: a unigram model for unigram files, merges ranked by score for BPE files. Texts are encoded in
batches on the library's own threads. `encode` can check every text against the sentencepiece library (parity) and
that decoding gives the text back.

Where no piece holds the marker behind another character, no piece can cross the cut before a run of markers. Texts
are then cut there, the different parts of a batch are encoded and decoded once, and the results are put together by
index; a run of unknown characters ends at the marker, which is a piece itself. Other models get whole texts. Parity is
checked on whole texts in both cases, so a wrong cut would show in every row it spoils.

Defined cases: null and empty texts have no tokens and decode to an empty text; repeated rows are encoded alike;
texts of any length are encoded whole; an empty table gives an empty result. The strings of control pieces in a text
are ordinary text. The model file must be readable on the driver; its bytes travel with the task.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm._shared import read, ship, text_of

ship(__name__)

MODEL_PATH = os.environ.get("LODESTONE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 32 << 20
#: Of them, those decoded and held against sentencepiece at a time, and the parts encoded at a time.
CHECKED_BYTES = 1 << 20
PARTS = 20_000
#: Parts that are the words of one input.
WORDS = 500


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 1:
            yield key >> 3, data[at : at + 8]
            at += 8
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        elif kind == 5:
            yield key >> 3, data[at : at + 4]
            at += 4
        else:
            raise ValueError(f"wire type {kind} in a model file")


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 40:
                    model.unknown = v
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.squeeze = bool(v)
                elif n == 5:
                    model.escape = bool(v)
    return model


def build(model: PieceModel):
    """A tokenizers.Tokenizer with the model's normaliser, marker, scores and byte fallback."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    names = [p for p, _, _ in model.pieces]
    if model.kind == UNIGRAM:
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback))
    else:
        ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        usable = {p for p, _, kind in model.pieces if kind in (NORMAL, USER, UNUSED)}
        ranked = sorted(((-s, i, p) for i, (p, s, kind) in enumerate(model.pieces) if kind == NORMAL and len(p) > 1))
        merges = [(p[:k], p[k:]) for _, _, p in ranked for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        tokenizer = Tokenizer(models.BPE(ids, merges, unk_token=names[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback))
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
        if model.squeeze:  # sentencepiece takes markers at the end, those of the text too, for white space
            steps.append(normalizers.Replace(Regex(rf"{MARK}+\z"), ""))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.escape and not any(re.search(f"[^{MARK}]{MARK}", p) for p in names):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    user = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER]
    if user:
        tokenizer.add_tokens(user)
    return tokenizer


@lru_cache(maxsize=2)
def _loaded(data: bytes):
    return build(parse(data))


@lru_cache(maxsize=2)
def _peer(data: bytes):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=data)


@lru_cache(maxsize=2)
def _part_encoder(data: bytes):
    """A tokenizer for the parts of normalised text, or None if pieces can cross the cuts between them."""
    from tokenizers import decoders, normalizers

    model = parse(data)
    crossing = any(kind == USER or (kind == NORMAL and re.search(f"[^{MARK}]{MARK}", p)) for p, _, kind in model.pieces)
    if crossing or not model.escape or not any(p == MARK and kind == NORMAL for p, _, kind in model.pieces):
        return None
    tokenizer = build(model)
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


def _normalised(data: bytes, texts: pa.Array) -> pa.Array:
    """Texts after the model's normaliser, with spaces for markers; empty texts stay empty."""
    model = parse(data) if data not in _plain else None
    if model is not None:
        _plain[data] = (bool(model.charsmap) or model.squeeze, model.dummy_prefix)
    complicated, prefix = _plain[data]
    if complicated:
        normalizer = _loaded(data).normalizer
        return pa.array([normalizer.normalize_str(t).replace(MARK, " ") if t else "" for t in texts.to_pylist()], pa.string())
    spaced = pc.replace_substring(texts, MARK, " ")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", spaced, " ")) if prefix else spaced


_plain: dict[bytes, tuple[bool, bool]] = {}


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts, each from a run of spaces up to the next, and where each text's parts begin (one more than texts)."""
    texts = pa.concat_arrays([texts])  # offset 0
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(values, np.uint8)[: ends[-1]] if values is not None else np.empty(0, np.uint8)
    space = raw == 32
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True  # a text begins a part, its first space too
    at = np.flatnonzero(begins)
    bounds = np.append(at, len(raw)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw.tobytes()))
    return parts, np.searchsorted(at, ends)


def _joined(values: pa.Array, rows: np.ndarray) -> pa.Array:
    """The strings (or bytes) of `values` joined from rows[i] up to rows[i + 1]."""
    values = pa.concat_arrays([values])
    _, offsets, raw = values.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(values) + 1] if len(values) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(values.type, len(rows) - 1, [None, pa.py_buffer(ends[rows].astype(np.int32).tobytes()), raw or pa.py_buffer(b"")])


@lru_cache(maxsize=2)
def _piece_texts(data: bytes) -> pa.Array:
    """What each id stands for when it is decoded, as bytes: byte pieces their byte, others their text with spaces for markers."""
    model = parse(data)
    return pa.array([bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in model.pieces], pa.binary())


def _numbers(lists: list[list[int]]) -> pa.Array:
    starts = np.append(0, np.cumsum([len(x) for x in lists]))
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(starts[-1]))))


def _coded(data: bytes, parts: pa.Array) -> pa.Array:
    """The ids of different parts. They go through the tokenizer as the words of long inputs, which costs less than an input
    each; what each has is told by the bytes that pieces stand for. If those don't add up (unknown pieces), parts go alone."""
    tokenizer = _part_encoder(data)
    words = pc.replace_substring(parts, " ", MARK).to_pylist()
    grouped = [words[lo : lo + WORDS] for lo in range(0, len(words), WORDS)]
    ids = _numbers([e.ids for e in tokenizer.encode_batch_fast(grouped, is_pretokenized=True, add_special_tokens=False)]).values
    covered = np.cumsum(_piece_sizes(data)[ids.to_numpy()])
    wanted = np.cumsum(pc.binary_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = np.searchsorted(covered, wanted) + 1
    if len(covered) and len(wanted) and ends[-1] == len(covered) and (covered[ends - 1] == wanted).all():
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), ids)
    return _numbers([e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


@lru_cache(maxsize=2)
def _piece_sizes(data: bytes) -> np.ndarray:
    return pc.binary_length(_piece_texts(data)).to_numpy(zero_copy_only=False).astype(np.int64)


def _by_parts(data: bytes, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """ids and round_trip of texts: each different part goes through the tokenizer once."""
    parts, rows = _cut(_normalised(data, texts))
    coded = parts.dictionary_encode()
    del parts
    lists = [_coded(data, coded.dictionary.slice(lo, PARTS)) for lo in range(0, len(coded.dictionary), PARTS)]
    taken = (pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))).take(coded.indices)
    ends = taken.offsets.to_numpy()[rows] if len(taken) else np.zeros(len(rows), np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), taken.values)
    same, at = [pa.array([], pa.bool_())], 0
    for some in _slices(texts, CHECKED_BYTES):
        same.append(pc.equal(_decoded(data, ids.slice(at, len(some))), _expected(data, some)))
        at += len(some)
    return ids, pa.concat_arrays(same)


def _decoded(data: bytes, ids: pa.Array) -> pa.Array:
    """The bytes that lists of ids stand for, the space of the dummy prefix included."""
    rows = np.append(0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)))
    return _joined(_piece_texts(data).take(ids.flatten()), rows)


def _expected(data: bytes, texts: pa.Array) -> pa.Array:
    """What `_decoded` gives if decoding gives the text back."""
    prefixed = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " ")) if _plain[data][1] else texts
    return prefixed.cast(pa.binary())


def _by_texts(data: bytes, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """ids and round_trip of texts that can't be cut."""
    tokenizer, whole = _loaded(data), texts.to_pylist()
    lists = [e.ids for e in tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
    back = tokenizer.decode_batch(lists, skip_special_tokens=False)
    return pa.array(lists, pa.list_(pa.int32())), pc.equal(pa.array(back, pa.string()), texts)


def _equal_lists(mine: pa.Array, theirs: pa.Array) -> np.ndarray:
    """Row by row, whether two arrays of lists of whole numbers hold the same."""
    n, m = (pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in (mine, theirs))
    same = n == m
    x, y = (a.filter(pa.array(same)).flatten().to_numpy(zero_copy_only=False) for a in (mine, theirs))
    owner = np.repeat(np.flatnonzero(same), n[same])
    same[owner[x != y]] = False
    return same


def _agrees(data: bytes, texts: pa.Array, ids: pa.Array, threads: int) -> pa.Array:
    """Row by row, whether sentencepiece gives the same ids for the whole text."""
    same, at = [], 0
    for some in _slices(texts, CHECKED_BYTES):
        theirs = _numbers(_peer(data).encode(some.to_pylist(), num_threads=threads))
        same.append(pa.array(_equal_lists(ids.slice(at, len(some)), theirs), pa.bool_()))
        at += len(some)
    return pa.concat_arrays(same)


def _slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The array in runs of at most `most` bytes, or of one text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = done = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield texts.slice(at, upto - at)
        at, done = upto, int(sizes[upto - 1])


def _encode(data: bytes, parity: bool, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        encoded = _by_texts if _part_encoder(data) is None else _by_parts
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1), BATCH_BYTES):
                ids, back = encoded(data, texts)
                same = _agrees(data, texts, ids, threads) if parity else pa.nulls(len(texts), pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids, back, same], names=["doc_id", "ids", "round_trip", "parity"])
                at += len(texts)

    return run


def encode(docs: DataFrame, model_path: str = MODEL_PATH, parity: bool = True, threads: int | None = None) -> DataFrame:
    """doc_id, ids, round_trip (decoding gives the text back) and parity (sentencepiece agrees; null if not asked).

    threads: the libraries' own threads in a task; as many as a task has cores (spark.task.cpus) if not given.
    """
    threads = threads or int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))
    with open(model_path, "rb") as file:
        data = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_encode(data, parity, threads), "doc_id long, ids array<int>, round_trip boolean, parity boolean")


def _decode(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(data)
        for batch in batches:
            texts = tokenizer.decode_batch([x or [] for x in batch.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id and the text of its ids."""
    with open(model_path, "rb") as file:
        data = file.read()
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(_decode(data), "doc_id long, text string")


def digest(ids: list[int]) -> str:
    """What op3's ids_sha256 holds: the comma-joined ids' SHA-256."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "round_trip", "parity")
