"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, to its end. A passage is described by numbers over its bytes
and words (shares of letters, capitals, digits, marks and single characters; shapes, lengths and repeats of words)
and encoded by a small layer; gated attention gives each passage a weight, and the weighted sum of the encodings is
scored. Labels are known per document only: encoder, attention and score are trained together from them.

Training reads at most ``TRAIN`` labelled documents (those of the lowest hash of their id, so the same ones each
time) and of these, in that order, as many whole ones as hold at most ``TRAIN_BYTES`` of text; one of over a sixteenth
of that teaches nothing. Their passage numbers come to the driver: the bounds are the parameters, whatever the size of
the tables. Scoring runs in every task with the trained weights; text is the only input of a score.

Defined cases: a null or empty text is one passage of zeros; a passage is never shared by two documents; labels that
are null are left out, of several labels of a document the mean counts; without any label the score is 0.5 and
filtering keeps everything; repeated rows get equal scores; an empty table gives no rows; further columns are left
alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import query, spare, table, together

PASSAGE = 64
TRAIN = 6000
TRAIN_BYTES = 48 << 20
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 60, 256, 0.01, 1e-4
#: Bytes of text that are described at a time, one document at least.
TOGETHER = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WIDE = np.arange(256) >= 128
_MARK = ~(_SPACE | _UPPER | _LOWER | _DIGIT | _WIDE)
#: Single ASCII characters keep a share of their own; all bytes beyond are one.
_CHAR = np.minimum(np.arange(256), 128)
SHAPES = 14
WIDTH = SHAPES + 129


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers per passage, passages per text)."""
    raw = [(t or "").encode() for t in texts]
    sizes = np.array([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[data]
    inside = ~space
    start = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    stop = np.flatnonzero(inside & np.concatenate((space[1:], [True]))) + 1
    text_of = np.searchsorted(np.cumsum(sizes), start, "right")
    n_words = np.bincount(text_of, minlength=len(raw))
    counts = np.maximum(1, -(-n_words // PASSAGE))
    first = np.cumsum(counts) - counts
    rank = np.arange(len(start)) - (np.cumsum(n_words) - n_words)[text_of]
    passage = first[text_of] + rank // PASSAGE
    total = int(counts.sum())
    out = np.zeros((total, WIDTH), np.float32)
    if not len(start):
        return out, counts

    def per_word(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(mask[data])))
        return run[stop] - run[start]

    size = (stop - start).astype(np.float64)
    upper, lower, digit, wide, mark = (per_word(m) for m in (_UPPER, _LOWER, _DIGIT, _WIDE, _MARK))
    tail = data[stop - 1]
    with np.errstate(over="ignore"):
        at = np.arange(len(data), dtype=np.uint64)
        word_start = np.repeat(start, stop - start)
        letters = np.flatnonzero(inside)
        power = (at[letters] - word_start.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (data[letters].astype(np.uint64) + np.uint64(1)) * (power ^ (power >> np.uint64(29)))
        word = np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), np.concatenate(([0], np.cumsum(stop - start)[:-1])))
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])))
    order = np.lexsort((word, passage))
    fresh = np.concatenate(([True], (word[order][1:] != word[order][:-1]) | (passage[order][1:] != passage[order][:-1])))
    different = np.bincount(passage[order], fresh, total)
    held = np.bincount(passage, minlength=total)
    n = np.maximum(1, held)
    bytes_ = np.maximum(1, np.bincount(passage, size, total))
    share = lambda values, of=n: np.bincount(passage, values, total) / of
    shapes = [
        share(upper, bytes_),
        share(lower, bytes_),
        share(digit, bytes_),
        share(wide, bytes_),
        share(mark, bytes_),
        share((upper > 1) & (lower == 0)),
        share((upper > 0) & (lower > 0)),
        share(mark == size),
        share(_MARK[tail] & (tail != 46) & (tail != 44)),
        share((tail == 46) | (tail == 44)),
        share(same),
        different / n,
        np.minimum(1, share(size) / 32),
        np.minimum(1, held / PASSAGE),
    ]
    out[:, :SHAPES] = np.stack(shapes, axis=1)
    keep = np.repeat(passage, stop - start) * 129 + _CHAR[data[letters]]
    out[:, SHAPES:] = np.sqrt(np.bincount(keep, minlength=total * 129).reshape(total, 129) / bytes_[:, None])
    return out, counts


@dataclass
class Weights:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]


def forward(p: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Scores and what their gradient needs, for passages ``x`` of bags of ``counts``."""
    begin = np.cumsum(counts) - counts
    bag = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ p["W"] + p["b"])
    v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (v * u) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, begin)[bag])
    a = e / np.add.reduceat(e, begin)[bag]
    z = np.add.reduceat(a[:, None] * h, begin, axis=0)
    score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
    return {"x": x, "begin": begin, "bag": bag, "h": h, "v": v, "u": u, "a": a, "z": z, "score": score}


def gradient(p: dict[str, np.ndarray], f: dict[str, np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss."""
    h, v, u, a, bag = f["h"], f["v"], f["u"], f["a"], f["bag"]
    g = (f["score"] - y) / len(y)
    dz = (g[:, None] * p["c"])[bag]
    da = (dz * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, f["begin"])[bag])
    dvu = de[:, None] * p["w"]
    dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
    dh = (a[:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
    return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de, "c": f["z"].T @ g, "d": g.sum()}


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, seed: int = 0) -> Weights:
    """Adam over mini-batches of bags, in an order fixed by ``seed``."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 0.01
    x = (x - mean) / scale
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    p = {"W": draw(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(())}
    m, s = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    begin = np.cumsum(counts) - counts
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(counts))
        for at in range(0, len(order), BATCH):
            bags = order[at : at + BATCH]
            n = counts[bags]
            rows = np.repeat(begin[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            grad = gradient(p, forward(p, x[rows], n), y[bags])
            step += 1
            for k in p:
                g = grad[k] + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Weights(mean, scale, p)


def predict(weights: Weights | None, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if weights is None:
        return np.full(len(counts), 0.5)
    return forward(weights.params, (x - weights.mean) / weights.scale, counts)["score"]


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN, limit_bytes: int = TRAIN_BYTES) -> Weights | None:
    """Weights from the labelled documents outside the held-out fold, ``limit`` of them and ``limit_bytes`` at most."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sizes = docs.select("doc_id", F.octet_length(F.col("text").cast("string")).alias("size")).join(F.broadcast(chosen), "doc_id")
    sizes = sizes.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.sum(F.coalesce("size", F.lit(0))).alias("size"))  # at most `limit` rows
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    chosen = sizes.where(F.col("size") <= limit_bytes // 16).withColumn("so_far", so_far).where(F.col("so_far") <= limit_bytes).select("doc_id", "quality")
    bags = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in together(batch.column(2), TOGETHER):
                x, counts = passages(texts)
                parts = [p.astype("<f2").tobytes() for p in np.split(x, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(parts)], names=["doc_id", "quality", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = bags.mapInArrow(run, f"doc_id {kind}, quality double, x binary").toArrow()
    if not rows.num_rows:
        return None
    found = sorted(zip(rows["doc_id"].to_pylist(), rows["x"].to_pylist(), rows["quality"].to_pylist()))
    bag = [np.frombuffer(x, "<f2").reshape(-1, WIDTH) for _, x, _ in found]
    return fit(np.concatenate(bag).astype(np.float64), np.array([len(b) for b in bag]), np.array([q for *_, q in found]))


def scored(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """``docs`` with a column ``score`` at its end, or ``score_`` and so on if there is one."""
    (name,) = spare(docs, "score")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in together(batch.column(columns.index("text")), TOGETHER):
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(predict(weights, *passages(texts)))], names=[*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def only_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = TRAIN) -> DataFrame:
    """``docs`` that score at least ``threshold``; all of them if there is nothing to learn from."""
    weights = train(docs, labels, limit)
    if weights is None:
        return docs
    found = scored(docs, weights)
    return found.where(F.col(found.columns[-1]) >= threshold).select(*docs.columns)


@query("op6_quality")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, folder, "labels")))
    held_out = (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
