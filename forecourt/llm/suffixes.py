"""Exact removal of repeated byte passages by suffix arrays in a logarithmic index family.

Every byte covered by a ``SPAN``-byte string that also starts in a document with a smaller doc_id is removed; texts
are UTF-8 bytes, strings are judged on the input, and matches never cross documents.

Sampling. Of the places in a ``SPAN``-byte string, its anchor is the one whose ``HEAD`` bytes have the least hash
(the first of equals). Equal strings have equal anchors, so the suffixes that begin at anchors, one in about eighteen
bytes, are enough to find every equal string. Neighbouring strings with one anchor are a run; a run is known by the
bytes it covers and the place of its anchor in them.

1. Documents are dealt to blocks by a hash of doc_id and text. A block sends the hashes of its anchors' heads, sorted, to
   buckets by hash; a bucket answers which heads stand in two or more blocks or documents.
2. A block sends the runs of those heads to the head's bucket, of equal runs only those of its smallest doc_id; the
   block's others are covered at once.
3. A bucket takes runs in the order of doc_id, batch by batch, into its index family: a batch is sorted into a suffix
   array, merge-scanned against the levels there are (a found run is covered), and becomes a level of its own; levels
   of about equal size are merged, so sizes grow geometrically. Runs that differ but share a head are then compared
   string by string, for the ends of passages.
4. A block cuts out what was found.

Heads of more than ``HOT`` runs send their strings instead of runs, equal ones of a block once and each to the bucket
of its own hash, so that a head in every document does not meet in one task. Blocks, buckets and their number follow
the bytes of the corpus. Both paths find the same strings; equality is always that of bytes.

Defined cases: a null text is empty; a document shorter than ``SPAN`` bytes keeps everything; rows that repeat a
doc_id do not remove one another's bytes; a null doc_id counts as larger than any other; where a cut splits a
character, the rest of it is dropped from the text, not from the counts and digest; an empty table gives no rows;
further columns are passed through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import query, spare, table

SPAN = 50
HEAD = 16
#: Strings that can share an anchor: the anchor's head may begin at so many places.
PLACES = SPAN - HEAD + 1
#: The longest run: its strings begin at PLACES neighbouring bytes.
WIDE = SPAN + PLACES - 1
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
HOT = 2048
BATCH = 1 << 16
#: Strings whose anchors are looked for at a time.
SLICE = 1 << 17

_NONE = np.iinfo(np.int64).max


# --- anchors --------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def head_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every HEAD bytes of ``data``, by doubling."""
    with np.errstate(over="ignore"):
        h = _mixed(data.astype(np.uint64) + np.uint64(1))
        power, size = np.uint64(0x9E3779B97F4A7C15), 1
        while size < HEAD:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
        return _mixed(h)


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the head, anchor, first string, number of strings) of the runs of documents that end at ``ends``."""
    starts = np.concatenate(([0], ends[:-1]))
    long = ends - starts >= SPAN
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[long]] += 1
    step[ends[long] - SPAN + 1] -= 1
    valid = np.cumsum(step[:-1], dtype=np.int8) > 0
    out = []
    for low in range(0, max(0, len(data) - SPAN + 1), SLICE):
        part = data[low : low + SLICE + SPAN - 1]
        h = head_hashes(part)
        place = np.uint64((1 << 24) - 1)  # room for a place in the slice
        least = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= PLACES:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < PLACES:
            least = np.minimum(least[: len(least) - (PLACES - size)], least[PLACES - size :])
        at = np.flatnonzero(valid[low : low + len(least)])
        if not len(at):
            continue
        anchor = (least[at] & place).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))))
        with np.errstate(over="ignore"):  # the least of many hashes are small ones; mixed again, they spread over the buckets
            head = _mixed(h[anchor[new]] * np.uint64(0x9E3779B97F4A7C15))
        out.append((head, anchor[new] + low, at[new] + low, np.diff(np.concatenate((new, [len(at)])))))
    if not out:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


# --- what is sent ---------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(np.int64(a.nbytes).tobytes() + np.ascontiguousarray(a).tobytes() for a in arrays), 3)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    data, out, at = zstandard.decompress(blob), [], 0
    for kind in kinds:
        size = int(np.frombuffer(data, np.int64, 1, at)[0])
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


class Block:
    """The documents of one block in a fixed order, as one run of bytes."""

    def __init__(self, rows: pa.Table, block: str):
        self.block = rows[block][0].as_py()
        by = pa.table({"doc_id": rows["doc_id"], "text": rows["text"], "at": np.arange(len(rows))})
        self.rows = rows.take(by.sort_by([("doc_id", "ascending"), ("text", "ascending")])["at"])
        raw = [(t or "").encode() for t in self.rows["text"].to_pylist()]
        self.ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.bytes = b"".join(raw)
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.doc = self.rows["doc_id"].cast(pa.int64()).fill_null(_NONE).to_numpy()

    def runs(self):
        """(head, anchor, first string, strings, row), in order of head."""
        head, anchor, first, count = runs(self.data, self.ends)
        order = np.argsort(head, kind="stable")
        head, anchor, first, count = (x[order] for x in (head, anchor, first, count))
        return head, anchor, first, count, np.searchsorted(self.ends, first, "right")


def _cuts(head: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted hashes go over from bucket to bucket; a bucket is a range of hashes."""
    bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(head, bounds), [len(head)]))


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _sent_heads(block: Block, buckets: int) -> pa.Table:
    """Per bucket the block's distinct heads, their number of runs, and whether several documents have them."""
    head, _, _, _, row = block.runs()
    new = np.concatenate(([True], head[1:] != head[:-1])) if len(head) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    number = np.diff(np.concatenate((at, [len(head)])))
    doc = block.doc[row]
    several = (np.maximum.reduceat(doc, at) != np.minimum.reduceat(doc, at)) if len(at) else np.zeros(0, bool)
    head = head[at]
    cuts = _cuts(head, buckets)
    out = []
    for b in range(buckets):
        part = slice(cuts[b], cuts[b + 1])
        if cuts[b] < cuts[b + 1]:
            short = head[part] >> np.uint64(16)
            gaps = np.diff(short, prepend=np.uint64(0))
            odd = several[part] | (number[part] > 1)
            kept = np.flatnonzero(odd).astype(np.int32)
            narrow = gaps[1:].max(initial=0) < 1 << 32
            tail = gaps[1:].astype(np.uint32 if narrow else np.uint64)
            count = number[part][odd].astype(np.int32) * np.where(several[part][odd], 1, -1).astype(np.int32)
            out.append((b, block.block, narrow, _pack(gaps[:1], tail, kept, count)))
    return _rows(out, ["bucket", "block", "narrow", "heads"], [pa.int32(), pa.int64(), pa.bool_(), pa.binary()])


def _answered_heads(sent: pa.Table) -> pa.Table:
    """For each block: 1 where a head is shared, 2 where it is hot, 0 elsewhere."""
    heads, numbers, flags, sizes = [], [], [], []
    for narrow, blob in zip(sent["narrow"].to_pylist(), sent["heads"].to_pylist()):
        first, gaps, at, count = _unpack(blob, np.uint64, np.uint32 if narrow else np.uint64, np.int32, np.int32)
        head = np.cumsum(np.concatenate((first, gaps.astype(np.uint64))), dtype=np.uint64)
        number = np.ones(len(head), np.int64)
        number[at] = np.abs(count)
        several = np.zeros(len(head), bool)
        several[at] = count > 0
        heads.append(head)
        numbers.append(number)
        flags.append(several)
        sizes.append(len(head))
    head, number, several = (np.concatenate(x) for x in (heads, numbers, flags))
    order = np.argsort(head, kind="stable")
    at = np.flatnonzero(np.concatenate(([True], head[order][1:] != head[order][:-1])))
    blocks = np.diff(np.concatenate((at, [len(head)])))
    shared = (blocks > 1) | np.logical_or.reduceat(several[order], at)
    hot = np.add.reduceat(number[order], at) > HOT
    answer = np.empty(len(head), np.uint8)
    answer[order] = np.repeat(np.where(shared, np.where(hot, 2, 1), 0).astype(np.uint8), blocks)
    parts = np.split(answer, np.cumsum(sizes)[:-1])
    rows = [(block, bucket, _pack(part)) for block, bucket, part in zip(sent["block"].to_pylist(), sent["bucket"].to_pylist(), parts)]
    return _rows(rows, ["block", "bucket", "answer"], [pa.int64(), pa.int32(), pa.binary()])


def run_keys(data: np.ndarray, first: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The runs' bytes, then the anchor's place and the number of strings, as fixed byte strings."""
    width = np.arange(WIDE, dtype=np.int32)
    key = np.zeros((len(first), WIDE + 2), np.uint8)
    for low in range(0, len(first), 1 << 12):
        s = slice(low, low + (1 << 12))
        inside = width < (count[s] + SPAN - 1)[:, None]
        key[s, :WIDE][inside] = data[(first[s].astype(np.int32)[:, None] + width)[inside]]
    key[:, WIDE] = place
    key[:, WIDE + 1] = count
    return key.view(f"S{WIDE + 2}")[:, 0]


def _byte_hash(keys: np.ndarray) -> np.ndarray:
    """64-bit hash per fixed byte string."""
    width = keys.dtype.itemsize
    rows = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, width)
    wide = np.zeros((len(rows), -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    h = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for column in wide.view(np.uint64).T:
            h = _mixed((h + column) * np.uint64(0x9E3779B97F4A7C15))
    return h


def _smallest(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(those that stay: of equal keys, those of the smallest doc; those whose key a smaller doc has).

    Keys with equal hashes but other bytes than the first of them both stay.
    """
    h = _byte_hash(keys)
    order = np.lexsort((doc, h))
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    larger = np.zeros(len(keys), bool)
    larger[order] = (doc[order] > doc[lead]) & (keys[order] == keys[lead])
    return np.flatnonzero(~larger), np.flatnonzero(larger)


def _sent_runs(block: Block, answers: pa.Table, buckets: int) -> pa.Table:
    """Runs ("r") and strings of hot heads ("s") by bucket, and what the block covers itself ("c")."""
    names, kinds = ["bucket", "kind", "block", "body"], [pa.int32(), pa.string(), pa.int64(), pa.binary()]
    head, anchor, first, count, row = block.runs()
    if not len(answers):
        return _rows([], names, kinds)
    by_bucket = sorted(zip(answers["bucket"].to_pylist(), answers["answer"].to_pylist()))
    answer = np.concatenate([_unpack(blob, np.uint8)[0] for _, blob in by_bucket])
    new = np.concatenate(([True], head[1:] != head[:-1]))
    answer = answer[np.cumsum(new) - 1]
    out, covered = [], []
    local = lambda a, r: (a - block.starts[r]).astype(np.int32)

    runs_ = np.flatnonzero(answer == 1)  # in order of head, and equal runs have equal heads
    edges = np.flatnonzero(np.concatenate(([True], head[runs_][1:] != head[runs_][:-1]))) if len(runs_) else np.empty(0, np.int64)
    for part in _pieces(runs_, edges, BATCH):
        keys = run_keys(block.data, first[part], count[part], anchor[part] - first[part])
        stay, gone = _smallest(keys, block.doc[row[part]])
        x = part[gone]
        covered.append((row[x], local(first[x], row[x]), (count[x] + SPAN - 1).astype(np.uint8)))
        part, keys = part[stay], keys[stay]
        cuts = _cuts(head[part], buckets)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            s = slice(cuts[b], cuts[b + 1])
            x = part[s]
            order = np.argsort(keys[s], kind="stable")
            x, k = x[order], keys[s][order]
            bytes_ = k.view(np.uint8).reshape(-1, WIDE + 2)
            inside = np.arange(WIDE) < (count[x] + SPAN - 1)[:, None]
            body = _pack(bytes_[:, :WIDE][inside], bytes_[:, WIDE], bytes_[:, WIDE + 1], block.doc[row[x]], row[x].astype(np.int32), local(first[x], row[x]))
            out.append((b, "r", block.block, body))
    hot = np.flatnonzero(answer == 2)
    for at in range(0, len(hot), BATCH // 16):
        x = hot[at : at + BATCH // 16]
        n = count[x]
        begin = np.repeat(first[x] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        keys = np.lib.stride_tricks.sliding_window_view(block.data, SPAN)[begin].view(f"S{SPAN}")[:, 0]
        of = np.repeat(row[x], n)
        stay, gone = _smallest(keys, block.doc[of])
        covered.append((of[gone], local(begin[gone], of[gone]), np.full(len(gone), SPAN, np.uint8)))
        keys, begin, of = keys[stay], begin[stay], of[stay]
        h = _byte_hash(keys)
        order = np.argsort(h, kind="stable")
        keys, begin, of = keys[order], begin[order], of[order]
        cuts = _cuts(h[order], buckets)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            s = slice(cuts[b], cuts[b + 1])
            out.append((b, "s", block.block, _pack(keys[s].view(np.uint8), block.doc[of[s]], of[s].astype(np.int32), local(begin[s], of[s]))))
    if covered:
        out.append((-1 - block.block % buckets, "c", block.block, _covers(*(np.concatenate(x) for x in zip(*covered)))))
    return _rows(out, names, kinds)


def _pieces(rows: np.ndarray, edges: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` in parts of about ``size``, cut at ``edges`` only."""
    if not len(rows):
        return []
    bounds = [0]
    while bounds[-1] < len(rows):
        k = np.searchsorted(edges, bounds[-1] + size)
        bounds.append(int(edges[k]) if k < len(edges) else len(rows))
    return [rows[a:b] for a, b in zip(bounds, bounds[1:])]


def _covers(row: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes:
    order = np.lexsort((start, row))
    return _pack(row[order].astype(np.int32), start[order].astype(np.int32), size[order])


# --- the index family -----------------------------------------------------


class Family:
    """Levels of sorted keys whose sizes grow geometrically."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def found(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted ``keys`` a level has."""
        hit = np.zeros(len(keys), bool)
        for level in self.levels:
            left = np.flatnonzero(~hit)
            at = np.minimum(np.searchsorted(level, keys[left]), len(level) - 1)
            hit[left] = level[at] == keys[left]
        return hit

    def add(self, keys: np.ndarray) -> None:
        """A new level of sorted ``keys``; levels up to twice its size are merged with it, and so on."""
        if not len(keys):
            return
        self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            both = np.concatenate((self.levels.pop(-2), self.levels.pop()))
            both.sort(kind="stable")  # two sorted runs: one merge
            self.levels.append(both)


def known_before(keys: np.ndarray, doc: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """Which ``keys`` also stand with a smaller doc, by an index family fed in order of doc."""
    out = np.zeros(len(keys), bool)
    family = Family()
    order = np.argsort(doc, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], doc[order][1:] != doc[order][:-1])))
    for part in _pieces(order, edges, batch):
        part = part[np.lexsort((doc[part], keys[part]))]  # the batch's suffix array; of equal suffixes the smaller doc first
        mine = keys[part]
        new = np.concatenate(([True], mine[1:] != mine[:-1]))
        lead = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        hit = family.found(mine[lead])
        out[part] = hit[group] | (doc[part] > doc[part][lead][group])
        family.add(mine[lead][~hit])
    return out


def _judged_runs(keys: np.ndarray, doc: np.ndarray, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole runs that are covered, then (run, offset) of further covered strings).

    Equal strings have equal heads, so the strings of some heads, about ``batch`` of them, are held at a time.
    """
    whole = known_before(keys, doc)
    left = np.flatnonzero(~whole)
    rows = keys.view(np.uint8).reshape(-1, WIDE + 2)
    heads = np.empty((len(left), HEAD), np.uint8)
    for low in range(0, len(left), 1 << 12):
        x = left[low : low + (1 << 12)]
        heads[low : low + len(x)] = rows[x[:, None], rows[x, WIDE].astype(np.int32)[:, None] + np.arange(HEAD, dtype=np.int32)]
    heads = heads.view(f"S{HEAD}")[:, 0]
    order = np.argsort(heads, kind="stable")
    new = np.concatenate(([True], heads[order][1:] != heads[order][:-1])) if len(left) else np.zeros(0, bool)
    del heads
    group = np.cumsum(new, dtype=np.int32) - 1
    several = np.bincount(group)[group] > 1 if len(left) else new
    part, group = left[order[several]], group[several]
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(part) else np.empty(0, np.int64)
    runs_, offsets = [], []
    for of in _pieces(part, edges, max(1, batch // PLACES)):
        n = rows[of, WIDE + 1].astype(np.int32)
        of = np.repeat(of, n)
        offset = np.arange(n.sum(), dtype=np.int32) - np.repeat(np.cumsum(n, dtype=np.int32) - n, n)
        strings = np.empty((len(of), SPAN + 1), np.uint8)
        for low in range(0, len(of), 1 << 12):
            s = slice(low, low + (1 << 12))
            strings[s, :SPAN] = rows[of[s, None], offset[s, None] + np.arange(SPAN, dtype=np.int32)]
        strings[:, SPAN] = rows[of, WIDE] - offset + 1  # the place of the anchor in the string
        hit = known_before(strings.view(f"S{SPAN + 1}")[:, 0], doc[of], 1 << 18)
        runs_.append(of[hit])
        offsets.append(offset[hit])
    empty = np.empty(0, np.int64)
    return np.flatnonzero(whole), np.concatenate(runs_) if runs_ else empty, np.concatenate(offsets) if offsets else empty


def _judged_strings(keys: np.ndarray, doc: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """Places of the strings that also stand with a smaller doc; those of some hashes are held at a time."""
    h = _byte_hash(keys)
    order = np.argsort(h, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1]))) if len(keys) else np.empty(0, np.int64)
    hits = [part[known_before(keys[part], doc[part], 1 << 18)] for part in _pieces(order, edges, batch)]
    return np.sort(np.concatenate(hits)) if hits else np.empty(0, np.int64)


def _judged(sent: pa.Table) -> pa.Table:
    """Per block the covered ranges of its rows."""
    out = []
    blobs: dict[str, list[tuple[int, bytes]]] = {"r": [], "s": [], "c": []}
    for kind, block, body in zip(sent["kind"].to_pylist(), sent["block"].to_pylist(), sent["body"].to_pylist()):
        blobs[kind].append((block, body))
    out += blobs["c"]
    found = []
    if blobs["r"]:
        parts = []
        for block, body in blobs["r"]:
            flat, place, count, doc, row, start = _unpack(body, np.uint8, np.uint8, np.uint8, np.int64, np.int32, np.int32)
            key = np.zeros((len(doc), WIDE + 2), np.uint8)
            key[:, :WIDE][np.arange(WIDE) < (count.astype(np.int64) + SPAN - 1)[:, None]] = flat
            key[:, WIDE], key[:, WIDE + 1] = place, count
            parts.append((key.view(f"S{WIDE + 2}")[:, 0], doc, row, start, np.full(len(doc), block)))
        keys, doc, row, start, block = (np.concatenate(x) for x in zip(*parts))
        del parts, key, flat
        whole, of, offset = _judged_runs(keys, doc)
        count = keys.view(np.uint8).reshape(-1, WIDE + 2)[:, WIDE + 1].astype(np.int64)
        found.append((block[whole], row[whole], start[whole], count[whole] + SPAN - 1))
        found.append((block[of], row[of], start[of] + offset, np.full(len(of), SPAN)))
    if blobs["s"]:
        parts = []
        for block, body in blobs["s"]:
            flat, doc, row, start = _unpack(body, np.uint8, np.int64, np.int32, np.int32)
            parts.append((flat.view(f"S{SPAN}"), doc, row, start, np.full(len(doc), block)))
        keys, doc, row, start, block = (np.concatenate(x) for x in zip(*parts))
        hit = _judged_strings(keys, doc)
        found.append((block[hit], row[hit], start[hit], np.full(len(hit), SPAN)))
    if found:
        block, row, start, size = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(block, kind="stable")
        block, row, start, size = (x[order] for x in (block, row, start, size))
        at = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else []
        for a, b in zip(at, [*at[1:], len(block)]):
            out.append((int(block[a]), _covers(row[a:b], start[a:b], size[a:b].astype(np.uint8))))
    return _rows(out, ["block", "body"], [pa.int64(), pa.binary()])


def _cut(block: Block, covers: pa.Table, block_name: str, added: list[str]) -> pa.Table:
    """The block's rows with what is left of their texts, and the counts and digest of it."""
    change = np.zeros(len(block.data) + 1, np.int16)
    for blob in covers["body"].to_pylist():
        row, start, size = _unpack(blob, np.int32, np.int32, np.uint8)
        at = block.starts[row] + start
        np.add.at(change, at, np.int16(1))
        np.add.at(change, at + size, np.int16(-1))
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    del change
    run = np.concatenate((np.zeros(1, np.int32), np.cumsum(gone, dtype=np.int32)))
    n_bytes = block.ends - block.starts
    removed = run[block.ends] - run[block.starts]
    first = gone & ~np.concatenate(([False], gone[:-1]))
    first[block.starts[n_bytes > 0]] = gone[block.starts[n_bytes > 0]]
    run = np.concatenate((np.zeros(1, np.int32), np.cumsum(first, dtype=np.int32)))
    spans = run[block.ends] - run[block.starts]
    texts, digests = block.rows["text"].to_pylist(), []
    for k, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist())):
        kept = block.bytes[a:b]
        if removed[k]:
            kept = block.data[a:b][~gone[a:b]].tobytes()
            texts[k] = kept.decode(errors="ignore")
        digests.append(hashlib.sha256(kept).hexdigest())
    rows = block.rows.drop_columns([block_name])
    rows = rows.set_column(rows.column_names.index("text"), "text", pa.array(texts, pa.string()))
    for name, values in zip(added, (n_bytes, removed.astype(np.int64), spans.astype(np.int64), digests)):
        rows = rows.append_column(name, pa.array(values))
    return rows


ADDED = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def deduplicate(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and n_bytes, n_removed, n_spans and kept_sha256 at the end.

    Added names that ``docs`` has already get underscores.
    """
    docs = docs.withColumn("text", F.col("text").cast("string"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(8, -(-total // block_bytes)), max(8, -(-total // bucket_bytes))
    added = spare(docs, *ADDED)
    (name,) = spare(docs, "block")
    # By both, so that rows of one doc_id, or of none, spread; they never remove one another's bytes, wherever they lie.
    dealt = docs.withColumn(name, F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    by_block = dealt.groupBy(name)  # with all columns in every step, so that one shuffle serves all three
    sent = by_block.applyInArrow(lambda rows: _sent_heads(Block(rows, name), buckets), "bucket int, block long, narrow boolean, heads binary")
    answers = sent.groupBy("bucket").applyInArrow(_answered_heads, "block long, bucket int, answer binary")
    both = by_block.cogroup(answers.groupBy("block"))
    found = both.applyInArrow(lambda rows, answer: _sent_runs(Block(rows, name), answer, buckets), "bucket int, kind string, block long, body binary")
    covers = found.groupBy("bucket").applyInArrow(_judged, "block long, body binary")
    out = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in added[:3]], T.StructField(added[3], T.StringType())])
    return by_block.cogroup(covers.groupBy("block")).applyInArrow(lambda rows, cover: _cut(Block(rows, name), cover, name, added), out)


@query("op2_suffix_dedup")
def op2(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return deduplicate(docs).select("doc_id", *ADDED)
