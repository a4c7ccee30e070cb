"""SentencePiece encoding and decoding with a batched numpy Viterbi over a model's pieces.

Encoding takes the segmentation of highest total piece score (of equal ones, that whose last piece is longest, from
the end on). No piece holds ``▁`` after another character, and a character that only occurs as a piece of its own
can't be inside a longer one, so texts are cut there into words, which are segmented once per batch of texts. Words
are sorted by length and advance together, one character a step, words of equal length leaving together (words of over
``LONG`` characters go one by one through the same recurrence): for each
piece length the substring's rolling hash probes the sorted hashes of the pieces of that length, and a vectorised
maximum stores score, piece and back pointer. A character without a piece costs more than any piece and becomes its
UTF-8 bytes.

For a model whose pieces come from byte-pair merging this is the best-scoring segmentation under its scores; the
library's own merge order can differ from it. Both decode to the same text.

Normalisation is the identity with a space put in front; other normalisers are refused. Decoding joins the pieces'
bytes, turns ``▁`` into spaces and takes the leading space off; unknown and control pieces are nothing.

Defined cases: a null or empty text has no pieces and decodes to an empty text; ``▁`` in a text decodes to a space;
null id lists decode to null; rows are coded one by one, so repeated rows give repeated results; further columns are
left alone. Texts are coded whole; a sub-batch holds at least one text and up to ``TOGETHER`` characters.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, table, together

SPACE = "▁"
TOGETHER = 1_000_000
#: Words of more characters, which would advance all but alone, are segmented one by one over a table of the pieces.
LONG = 512
_BASE = np.uint64(0x9E3779B97F4A7C15)
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    """Pieces of a model: by length, sorted hashes with ids; score per id; bytes per id for decoding."""

    keys: dict[int, np.ndarray]
    ids: dict[int, np.ndarray]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    table: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    words: str
    known: dict[str, int]

    @property
    def longest(self) -> int:
        return max(self.keys)


def hashes(points: np.ndarray) -> np.ndarray:
    """Polynomial hash per row of code points, the last one first."""
    out = np.zeros(len(points), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(points.shape[1] - 1, -1, -1):
            out += points[:, k].astype(np.uint64) * power
            power *= _BASE
    return out


def load(path: str) -> Model:
    pieces, scores, kinds, normaliser = [], [], [], {}
    with open(path, "rb") as file:
        data = file.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif number == 3:
            normaliser = dict(_fields(value))
    if normaliser.get(2) or not normaliser.get(3, 1) or normaliser.get(4, 1) or not normaliser.get(5, 1):
        raise ValueError("only the identity normaliser with a space in front and all white space kept is supported")
    own = [i for i, k in enumerate(kinds) if k in (NORMAL, USER)]
    if any(SPACE in pieces[i].lstrip(SPACE) for i in own):
        raise ValueError("a piece goes over a word's start")
    keys, ids = {}, {}
    for size in sorted({len(pieces[i]) for i in own}):
        of = np.array([i for i in own if len(pieces[i]) == size])
        h = hashes(np.array([[ord(c) for c in pieces[i]] for i in of], np.uint32))
        order = np.argsort(h)
        keys[size], ids[size] = h[order], of[order].astype(np.int32)
        if len(np.unique(h)) < len(h):
            raise ValueError("two pieces share a hash")
    byte_ids = np.array([pieces.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
    said = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() if k in (NORMAL, USER) else b"" for p, k in zip(pieces, kinds)]
    sizes = np.array([len(s) for s in said], np.int64)
    inner = sorted({c for i in own if len(pieces[i]) > 1 for c in pieces[i]} - {SPACE})
    chars = "".join(re.escape(c) for c in inner)
    return Model(
        keys=keys,
        ids=ids,
        scores=np.array(scores, np.float64),
        byte_ids=byte_ids,
        unknown=kinds.index(UNKNOWN),
        table=np.frombuffer(b"".join(said), np.uint8),
        starts=np.cumsum(sizes) - sizes,
        sizes=sizes,
        words=f"{SPACE}+[{chars}]*|[{chars}]+|[^{chars}{SPACE}]",
        known={pieces[i]: i for i in own},
    )


def segment(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids per word)."""
    given = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-given, kind="stable")
    size = given[order]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    start = (np.cumsum(given) - given)[order]
    best = np.empty(len(points) + 1)
    piece = np.empty(len(points), np.int32)
    back = np.empty(len(points), np.int32)
    worst = min(model.scores[i].min() for i in model.ids.values()) - 10
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    with np.errstate(over="ignore"):
        for end in range(size[0]):
            n = active[end]
            at = start[:n] + end
            h = np.zeros(n, np.uint64)
            power = np.uint64(1)
            top = np.full(n, -np.inf)
            which = np.full(n, model.unknown, np.int32)
            long = np.ones(n, np.int32)
            for k in range(1, min(model.longest, end + 1) + 1):
                h += points[at - (k - 1)] * power
                power *= _BASE
                before = best[at - k] if k <= end else 0.0
                if k == 1:
                    top = before + np.full(n, worst)
                if k not in model.keys:
                    continue
                keys = model.keys[k]
                near = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[near] == h
                found = model.ids[k][near]
                score = np.where(hit, before + model.scores[found], -np.inf)
                better = hit & (score >= top)
                top = np.where(better, score, top)
                which = np.where(better, found, which)
                long = np.where(better, np.int32(k), long)
            best[at], piece[at], back[at] = top, which, long
    return _backwards(words, given, points, piece, back, model)


def segment_long(word: str, model: Model) -> np.ndarray:
    """Ids of one word of any length, by the same rule: best score, of equal ones the longer last piece."""
    size, unknown = len(word), model.unknown
    scores = model.scores.tolist()
    worst = min(model.scores[i].min() for i in model.ids.values()) - 10
    lengths = sorted(model.keys)
    best, piece, back = array("d", bytes(8 * (size + 1))), array("i", bytes(4 * size)), array("i", bytes(4 * size))
    find = model.known.get
    for end in range(1, size + 1):
        top, which, long = best[end - 1] + worst, unknown, 1
        for k in lengths:
            if k > end:
                break
            found = find(word[end - k : end])
            if found is not None and (score := best[end - k] + scores[found]) >= top:
                top, which, long = score, found, k
        best[end], piece[end - 1], back[end - 1] = top, which, long
    out, at = [], size
    while at:
        if piece[at - 1] == unknown:
            out += model.byte_ids[list(word[at - 1].encode())][::-1].tolist()
        else:
            out.append(piece[at - 1])
        at -= back[at - 1]
    return np.array(out[::-1], np.int32)


def _backwards(words, given, points, piece, back, model) -> tuple[np.ndarray, np.ndarray]:
    """Follow the back pointers of all words at once, last piece first; unknown characters become their bytes."""
    begin = np.cumsum(given) - given
    at = begin + given - 1
    live = np.arange(len(words))
    owner, ids, where = [], [], []
    while len(live):
        owner.append(live)
        where.append(at[live])
        ids.append(piece[at[live]])
        at[live] -= back[at[live]]
        live = live[at[live] >= begin[live]]
    owner, ids, where = (np.concatenate(x) for x in (owner, ids, where))
    order = np.argsort(where)  # words lie one after the other, so this is the order of the text
    owner, ids, where = owner[order], ids[order], where[order]
    odd = np.flatnonzero(ids == model.unknown)
    if len(odd):
        raw = [chr(c).encode() for c in points[where[odd]]]
        repeat = np.ones(len(ids), np.int64)
        repeat[odd] = [len(r) for r in raw]
        to = np.cumsum(repeat) - repeat
        owner, ids = np.repeat(owner, repeat), np.repeat(ids, repeat)
        for r, t in zip(raw, to[odd]):
            ids[t : t + len(r)] = model.byte_ids[list(r)]
    return ids, np.bincount(owner, minlength=len(words))


def _segmented(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """As `segment`, words of any length."""
    short = [w for w in words if len(w) <= LONG]
    if len(short) == len(words):
        return segment(words, model)
    ids, count = segment(short, model) if short else (np.empty(0, np.int32), np.empty(0, np.int64))
    parts = iter(np.split(ids, np.cumsum(count)[:-1]) if short else ())
    each = [next(parts) if len(w) <= LONG else segment_long(w, model) for w in words]
    return np.concatenate(each), np.array([len(x) for x in each], np.int64)


def encode(texts: list[str | None], model: Model, cut: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, number of ids per text)."""
    known: dict[str, int] = {}
    of, per_text = [], []
    for text in texts:
        words = cut.findall(SPACE + text.replace(" ", SPACE)) if text else []
        of += [known.setdefault(w, len(known)) for w in words]
        per_text.append(len(words))
    if not known:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    ids, count = _segmented(list(known), model)
    of = np.array(of)
    n = count[of]
    begin = (np.cumsum(count) - count)[of]
    total = np.cumsum(n)
    take = np.arange(total[-1]) + np.repeat(begin - (total - n), n)
    last = np.cumsum(per_text)
    ends = np.concatenate(([0], total))[last]
    return ids[take], np.diff(np.concatenate(([0], ends)))


def decode(ids: np.ndarray, counts: np.ndarray, model: Model) -> list[str]:
    """One text per run of ``counts`` ids."""
    n = model.sizes[ids]
    total = np.cumsum(n)
    joined = b""
    if len(ids):
        joined = model.table[np.arange(total[-1]) + np.repeat(model.starts[ids] - (total - n), n)].tobytes()
    ends = np.concatenate(([0], total))[np.cumsum(counts)]
    out, at = [], 0
    for end in ends.tolist():
        out.append(joined[at:end].decode(errors="replace").removeprefix(" "))
        at = end
    return out


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _shared(docs: DataFrame, path: str):
    return docs.sparkSession.sparkContext.broadcast(load(path))  # some tens of thousands of pieces: a few MB


def encoded(docs: DataFrame, path: str, digest: bool = False, ids: bool = True) -> DataFrame:
    """Per row (doc_id, ids); with ``digest`` also n_tokens, ids_sha256 and round_trip: the digest of the ids as
    little-endian 32-bit numbers, and whether they decode to the text. ``ids=False`` leaves the ids out."""
    model = _shared(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        cut = re.compile(m.words, re.DOTALL)
        for batch in batches:
            for first, texts in together(batch.column(1), TOGETHER):
                flat, counts = encode(texts, m, cut)
                ends = np.cumsum(counts)
                columns = [batch.column(0).slice(first, len(texts))]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat, pa.int32())))
                if digest:
                    parts = np.split(flat.astype("<i4"), ends[:-1])
                    sha = [hashlib.sha256(p.tobytes()).hexdigest() for p in parts]
                    same = [(t or "") == d for t, d in zip(texts, decode(flat, counts, m))]
                    columns += [pa.array(counts), pa.array(sha), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = [f"doc_id {kind}"] + ["ids array<int>"] * ids + ["n_tokens long", "ids_sha256 string", "round_trip boolean"] * digest
    names = [c.split()[0] for c in schema]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, ", ".join(schema))


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """Per row (doc_id, text) of (doc_id, ids)."""
    model = _shared(coded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            counts = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
            texts = decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts, model.value)
            texts = [t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, f"doc_id {kind}, text string")


@query("op4_sentencepiece")
def op4(spark, folder):
    return encoded(table(spark, folder, "documents"), default_model(), digest=True, ids=False)
