"""SimHash near-duplicates: fingerprints of word shingles, linked within a bit distance, by bit-sliced comparison.

Fingerprints (`fingerprints`): A-Z lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``, shingles are ``size``
consecutive words joined by a space, repeats included (fewer words: the whole sequence); a bit is 1 if it is set in
over half of the shingles' XXH64 values with seed 42.

Links (`links`): equal fingerprints are one class. Classes within ``radius`` bits agree on at least
``SEGMENTS - radius`` of the ``SEGMENTS`` segments, so each class is sent to one bucket for every pair of segments
(radius at most ``SEGMENTS - 2``) and compared within its buckets only. The comparison is bit-sliced: 64 members of
a bucket fill one word per bit position, a member is held against a whole word of others at once, and a carry-save
counter of three bits per lane counts differing positions; a block is left as soon as every lane exceeds the radius.
A bucket over ``CHUNK`` members is split into chunks and every pair of chunks is one unit of work, so no bucket has
to fit one task and no link is lost. A unit joins the links of a round to its forest at once and compares no member
with a word that is wholly in its component already, so the links themselves are never held, and it returns one link
per row that is not a root.

Components (`components`): alternating large-star and small-star steps over a written table of links.

Defined cases: a null or word-free text has fingerprint zero, linked like any other; repeated rows share a
component; rows with a null doc_id get the component of their class, or null if nothing else is in it; an empty
table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, rewritten, table, together
from forecourt.session import materialize

SIZE = 4
RADIUS = 4
SEGMENTS = 6
WIDTHS = (11, 11, 11, 11, 10, 10)
CHUNK = 4096
#: (member, word of others) units that one round of the comparison holds at a time.
ROUND = 1 << 14
#: Characters of text that are hashed at a time, one text at least.
TOGETHER = 2_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Each of a byte's bits in a byte of its own, so that 255 additions cannot overflow.
_SPREAD = np.array([int.from_bytes(bytes((b >> i) & 1 for i in range(8)), "little") for b in range(256)], np.uint64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    last = ends[-1:] if len(words) < size else ends[size - 1 :]
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], 42) for a, b in zip(starts[:n], last)), np.uint64, n)


def majority(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of ``counts`` values: the word whose bits are set in over half of them (zero for an empty run)."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    pieces = -(-n // 255)
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    owner = np.repeat(np.arange(len(n)), pieces)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = first[owner] + 255 * step
    by = values.view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(_SPREAD[by[:, k]], cuts) for k in range(8)], axis=1)
    bits = np.add.reduceat(sums.view(np.uint8).reshape(len(owner), 64).astype(np.int64), np.cumsum(pieces) - pieces, axis=0)
    out[full] = np.packbits(bits * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, fp) per row; fp is the unsigned fingerprint's bits in a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in together(batch.column(1), TOGETHER):
                hashes = [shingle_hashes(t, size) for t in texts]
                counts = np.array([len(h) for h in hashes], np.int64)
                fps = majority(np.concatenate(hashes), counts).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(fps)], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def close_pairs(fps: np.ndarray, unit: np.ndarray, radius: int, label: Callable[[], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of rows in the same unit within ``radius`` bits, round by round; rows of a unit are neighbours.

    ``label`` gives the component that each row is known to be in so far: a word whose rows are all in a member's own
    component is not compared with it.
    """
    n = len(fps)
    new = np.concatenate(([True], unit[1:] != unit[:-1]))
    begin = np.flatnonzero(new)
    size = np.diff(np.concatenate((begin, [n])))
    of = np.cumsum(new) - 1
    # Words: each unit's rows, 64 to a word, one word per bit position (the vertical store).
    words_of = -(-size // 64)
    word0 = np.cumsum(words_of) - words_of
    place = np.arange(n) - begin[of]
    word = word0[of] + place // 64
    lane = (place % 64).astype(np.uint64)
    total = int(words_of.sum())
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    planes = np.empty((64, total), np.uint64)
    for b in range(64):
        planes[b] = np.bitwise_or.reduceat(((fps >> np.uint64(b)) & np.uint64(1)) << lane, starts)
    used = np.bitwise_or.reduceat(np.uint64(1) << lane, starts)
    # A row meets its own word (lanes after its own) and the later words of its unit.
    later = (word0 + words_of)[of] - word
    order = np.cumsum(later)
    done = 0
    while done < n:
        upto = max(done + 1, int(np.searchsorted(order, (order[done - 1] if done else 0) + ROUND, "right")))
        rows = np.arange(done, upto)
        q = np.repeat(rows, later[rows])
        w = word[q] + np.arange(len(q)) - np.repeat(np.cumsum(later[rows]) - later[rows], later[rows])
        if label is not None:
            of_row = label()
            low, high = np.minimum.reduceat(of_row, starts), np.maximum.reduceat(of_row, starts)
            open_ = np.flatnonzero((low[w] != of_row[q]) | (high[w] != of_row[q]))
            q, w = q[open_], w[open_]
        alive = used[w].copy()
        own = w == word[q]
        alive[own] &= ~((np.uint64(2) << lane[q[own]]) - np.uint64(1))
        c0, c1, c2 = (np.zeros(len(q), np.uint64) for _ in range(3))
        for b in range(64):
            if b % 4 == 0:  # leave the blocks in which no lane is still within the radius
                keep = np.flatnonzero(alive)
                if len(keep) < len(q):
                    q, w, alive, c0, c1, c2 = (x[keep] for x in (q, w, alive, c0, c1, c2))
                if not len(q):
                    break
            bit = np.uint64(0) - ((fps[q] >> np.uint64(b)) & np.uint64(1))
            carry = planes[b][w] ^ bit
            c0, carry = c0 ^ carry, c0 & carry
            c1, carry = c1 ^ carry, c1 & carry
            c2, carry = c2 ^ carry, c2 & carry
            alive &= ~(_over(c0, c1, c2, radius) | carry)
        done = upto
        left, right = [], []
        for b in range(64):
            hit = np.flatnonzero((alive >> np.uint64(b)) & np.uint64(1))
            left.append(q[hit])
            right.append(begin[of[q[hit]]] + (w[hit] - word0[of[q[hit]]]) * 64 + b)
        yield np.concatenate(left), np.concatenate(right)


def _over(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit count exceeds ``radius`` (0 to 6)."""
    over = np.zeros_like(c0)
    for value in range(radius + 1, 8):
        over |= (c0 if value & 1 else ~c0) & (c1 if value & 2 else ~c1) & (c2 if value & 4 else ~c2)
    return over


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root``, the smallest index of each index's component so far, with the links (a, b) added."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, up := root[root]):
            root = up
    return root


def roots(doc: np.ndarray, fps: np.ndarray, unit: np.ndarray, radius: int) -> np.ndarray:
    """The smallest doc of each row's component within its unit; links are joined round by round and not kept."""
    order = np.argsort(doc, kind="stable")  # by doc, so that a component's smallest index is its smallest doc
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc))
    root = np.arange(len(doc))
    for a, b in close_pairs(fps, unit, radius, lambda: root[rank]):
        root = joined(root, rank[a], rank[b])
    return doc[order][root[rank]]


def links(classes: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(u, v), u > v: links that connect what is connected, for ``classes`` of (doc, fp) with distinct fp and doc."""
    if not 0 <= radius <= SEGMENTS - 2:
        raise ValueError(f"radius must be 0 to {SEGMENTS - 2}")
    low = [sum(WIDTHS[:k]) for k in range(SEGMENTS)]
    part = [F.shiftrightunsigned("fp", low[k]).bitwiseAND(F.lit((1 << WIDTHS[k]) - 1)) for k in range(SEGMENTS)]
    pairs = [(i, j) for i in range(SEGMENTS) for j in range(i + 1, SEGMENTS)]
    keys = [F.lit(t << 24) + F.shiftleft(part[i], 11) + part[j] for t, (i, j) in enumerate(pairs)]
    spread = classes.select("doc", "fp", F.explode(F.array(*keys)).alias("key"))
    hot = spread.groupBy("key").count().where(F.col("count") > chunk).select("key", F.ceil(F.col("count") / chunk).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    other = F.when(F.col("n").isNull(), F.array(F.lit(-1))).otherwise(F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i != own))
    placed = spread.join(hot, "key", "left").withColumn("other", F.explode(other))
    unit = F.when(F.col("n").isNull(), F.lit(0).cast("long")).otherwise(F.least(own, "other").cast("long") * F.col("n") + F.greatest(own, "other"))
    rows = placed.select("key", unit.alias("unit"), "doc", "fp").repartition("key", "unit").sortWithinPartitions("key", "unit")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((4, 0), np.int64)

        def linked(x: np.ndarray) -> pa.RecordBatch:
            key, unit, doc, fp = x
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])))
            to = roots(doc, np.ascontiguousarray(fp).view(np.uint64), np.cumsum(new), radius)
            u = np.flatnonzero(to != doc)
            return pa.RecordBatch.from_arrays([pa.array(doc[u]), pa.array(to[u])], names=["u", "v"])

        for batch in batches:
            x = np.concatenate([kept, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if not x.shape[1]:
                continue
            tail = int(np.flatnonzero((x[0] == x[0, -1]) & (x[1] == x[1, -1]))[0])  # the last unit may go on
            kept = x[:, tail:]
            if tail:
                yield linked(x[:, :tail])
        if kept.shape[1]:
            yield linked(kept)

    return rows.mapInArrow(compare, "u long, v long").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (u, v) reaches."""
    edges, path = rewritten(edges, label)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where(F.col("u") > F.col("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        edges, path = rewritten(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label, path)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, size: int = SIZE, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fp, component_id (the smallest doc_id it reaches over links, itself included)."""
    of = materialize(fingerprints(docs, size), "simhash")
    classes = of.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    found = components(links(classes.where("doc is not null"), radius))
    label = classes.join(found, classes["doc"] == found["node"], "left").select("fp", F.coalesce("root", "doc").alias("component_id"))
    return of.join(label, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, size: int = SIZE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id, and one only if rows repeat that id.

    Rows with a null doc_id take no part and stay.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    kept = near_duplicates(named, size, radius).where("doc_id = component_id").select("doc_id").distinct()
    one = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


@query("op9_simhash")
def op9(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
