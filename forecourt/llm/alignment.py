"""Alignment of two tokenizers over a corpus: shared cut points, links of overlapping tokens, and corpus-wide counts.

A text is coded with a space before it by a byte-level BPE (A), and by a piece model that adds its own space (B). Both
token sequences spell the same bytes; a text where they don't has no tokens here.

Arrow-native, per block of documents: the coders' lists are flattened and get parent indices; token lengths summed up
within each document give the byte at which a token ends; (document, end) is the key on which the ends of A meet those
of B in an Acero hash join. Ends that both have cut the document into groups. Every end of either closes one stretch
of bytes that belongs to one A and one B token, so the sorted full join, filled backwards, lists every overlapping
pair once. ``Table.group_by`` counts the block's pairs of ids.

Spark merges those partial counts: a block's distinct pairs, numbered within the block, are summed corpus-wide, the
largest count of every B id is found, and both go back to the blocks that have the pair. A document keeps its pairs as
numbers of its block's list in a written table, so nothing is coded twice and no pair is shuffled more than once a block.

Defined cases: null and empty texts, and texts whose tokens spell other bytes (``▁`` becomes a space in B), have no
tokens: zeros and an empty ``groups_sha256``; rows are coded one by one, so repeated rows give repeated results and
count twice; doc_id may be null or repeat; an empty table gives no rows; further columns are left alone. Texts are
coded whole; a block holds at least one text and up to ``BLOCK`` characters.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, table, together
from forecourt.session import fresh_path

BLOCK = 1_500_000
#: Documents in one record batch that goes back to Spark.
ROWS = 256
# Characters whose classes no Unicode version since 7 has changed; texts of others, and very long ones, are coded by
# the slower of two libraries that agree.
_PLAIN = re.compile("[\x00-ԯ -⁯]*")
_LONG = 1_000_000


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Coder:
    """Ids of texts, and per id its bytes."""

    spells: list[bytes]

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError


class ByteLevel(Coder):
    """The tokenizers library's byte-level BPE; special tokens' strings are plain text, a space goes before the text.

    Where every merge makes the id after the last one's, ranks are ids, and plain texts take tiktoken's quicker path.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(model)
        self.full.encode_special_tokens = True
        said = json.loads(model)
        vocab, of = said["model"]["vocab"], byte_chars()
        self.spells = [b""] * (max(self.full.get_vocab().values()) + 1)
        for piece, i in vocab.items():
            self.spells[i] = bytes(of[c] for c in piece) if all(c in of for c in piece) else piece.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        cut = said["pre_tokenizer"]
        same = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and said["normalizer"] is None
        same = same and all(vocab[a + b] == 256 + k for k, (a, b) in enumerate(merges))
        self.quick = self._ranked(len(merges)) if same else None

    def _ranked(self, merges: int):
        import public_tokenizers
        import tiktoken

        ranks = {spelt: i for i, spelt in enumerate(self.spells[: 256 + merges])}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts):
        plain = [self.quick is not None and len(t) <= _LONG and _PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self.full.encode_batch([" " + t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [self.quick.encode_ordinary(" " + t) if p else next(rest).ids for t, p in zip(texts, plain)]


class Pieces(Coder):
    """The sentencepiece library's model, which puts its own space first."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.full = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.spells = []
        for i in range(self.full.get_piece_size()):
            piece = self.full.id_to_piece(i)
            self.spells.append(bytes([int(piece[3:5], 16)]) if self.full.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts):
        return self.full.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _coders(byte_level: str, pieces: str) -> tuple[Coder, Coder, pa.Array, pa.Array]:
    a, b = ByteLevel(byte_level), Pieces(base64.b64decode(pieces))
    return a, b, pa.array(a.spells, pa.large_binary()), pa.array(b.spells, pa.large_binary())


def _coded(coder: Coder, spells: pa.Array, texts: list[str]) -> tuple[pa.ListArray, pa.Array, np.ndarray]:
    """(lists of ids, the bytes of all tokens one after the other as an array of tokens, where each text's bytes end)."""
    ids = pa.array(coder.encode(texts), pa.list_(pa.int32()))
    spelt = spells.take(ids.flatten())
    offsets = np.frombuffer(spelt.buffers()[1], np.int64)[: len(spelt) + 1] if len(spelt) else np.zeros(1, np.int64)
    return ids, spelt, offsets[ids.offsets.to_numpy()]


def _spelt(spelt: pa.Array) -> memoryview:
    return memoryview(spelt.buffers()[2]).cast("B") if len(spelt) else memoryview(b"")


def ends(ids: pa.ListArray, spells: pa.Array) -> pa.Table:
    """Per token: id and key, (document << 32 | byte at which it ends in the document)."""
    flat, parent = ids.flatten(), pc.list_parent_indices(ids).cast(pa.int64())
    total = pc.cumulative_sum(pc.binary_length(spells).cast(pa.int64()).take(flat))
    whole = np.concatenate(([0], total.to_numpy()))
    base = pa.array(whole[ids.offsets.to_numpy()[:-1]], pa.int64())
    within = pc.subtract(total, base.take(parent))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(parent, 32), within), "id": flat, "at": pa.array(np.arange(len(flat), dtype=np.int64))})


def aligned(ids_a: pa.ListArray, ids_b: pa.ListArray, spells_a: pa.Array, spells_b: pa.Array) -> pa.Table:
    """One row per stretch of bytes between neighbouring ends, in order: key, a and b (the tokens it belongs to, by
    place), and whether A, B end there."""
    a, b = ends(ids_a, spells_a), ends(ids_b, spells_b)
    met = a.select(["key", "at"]).join(b.select(["key", "at"]), "key", join_type="full outer", right_suffix="_b", use_threads=False)
    met = met.take(pc.sort_indices(met["key"])).combine_chunks()
    end_a, end_b = met["at"].is_valid(), met["at_b"].is_valid()
    return pa.table({"key": met["key"], "a": pc.fill_null_backward(met["at"]), "b": pc.fill_null_backward(met["at_b"]), "end_a": end_a, "end_b": end_b})


def group_digests(links: pa.Table, ids_a: pa.ListArray, ids_b: pa.ListArray, size_a: int, size_b: int) -> list[str]:
    """Per document the SHA-256 of ``a1,a2|b1;a3|b2``: the ids of its groups in order."""
    end_a, end_b = (np.asarray(links[c]) for c in ("end_a", "end_b"))
    both = end_a & end_b
    last_a, last_b = both[end_a], both[end_b]  # of each token: does its group end with it
    before_a, before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # its group
    n_a, n_b = (np.bincount(x) if len(x) else np.zeros(0, np.int64) for x in (before_a, before_b))
    to_a = np.arange(len(before_a)) + (np.cumsum(n_b) - n_b)[before_a]
    to_b = np.arange(len(before_b)) + np.cumsum(n_a)[before_b]
    word = np.empty(len(to_a) + len(to_b), np.int64)
    word[to_a] = np.asarray(ids_a.flatten()) + size_a * last_a
    word[to_b] = 2 * size_a + np.asarray(ids_b.flatten()) + size_b * last_b
    said = [f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for mark in marks for i in range(size)]
    text = pa.array(said, pa.large_binary()).take(pa.array(word))
    bounds = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1] if len(text) else np.zeros(1, np.int64)
    cuts = bounds[ids_a.offsets.to_numpy() + ids_b.offsets.to_numpy()].tolist()
    data = _spelt(text)
    return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]


def _block(doc: pa.Array, texts: list[str | None], coders, block: int) -> Iterator[pa.RecordBatch]:
    a, b, spells_a, spells_b = coders
    given = [t or "" for t in texts]
    raw = [t.encode() for t in given]
    ids_a, spelt_a, cut_a = _coded(a, spells_a, given)
    ids_b, spelt_b, cut_b = _coded(b, spells_b, given)
    data_a, data_b = _spelt(spelt_a), _spelt(spelt_b)
    same = [
        bool(r) and y - x == len(r) + 1 == v - u and data_a[x] == data_b[u] == 0x20 and data_a[x + 1 : y] == r and data_b[u + 1 : v] == r
        for r, x, y, u, v in zip(raw, cut_a.tolist(), cut_a[1:].tolist(), cut_b.tolist(), cut_b[1:].tolist())
    ]
    del data_a, data_b, spelt_a, spelt_b, raw
    if not all(same):
        keep = pa.array(same)
        none = pa.scalar([], pa.list_(pa.int32()))
        ids_a, ids_b = (pc.if_else(keep, ids, none) for ids in (ids_a, ids_b))
    links = aligned(ids_a, ids_b, spells_a, spells_b)
    digests = group_digests(links, ids_a, ids_b, len(a.spells), len(b.spells))
    both = pc.and_(links["end_a"], links["end_b"]).combine_chunks()
    owner = pc.shift_right(links["key"], 32).to_numpy()
    n_links = np.bincount(owner, minlength=len(given))
    n_groups = np.bincount(owner[np.asarray(both)], minlength=len(given))
    pair = pc.add(pc.multiply(ids_a.flatten().take(links["a"]).cast(pa.int64()), len(b.spells)), ids_b.flatten().take(links["b"]).cast(pa.int64()))
    counted = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending")])
    code = pc.index_in(pair, counted["pair"].combine_chunks()).combine_chunks().cast(pa.int32())
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_links))), pa.int32()), code)
    rows = pa.table(
        {
            "block": pa.array(np.full(len(given), block)),
            "doc_id": doc,
            "n_a": pc.list_value_length(ids_a).cast(pa.int64()),
            "n_b": pc.list_value_length(ids_b).cast(pa.int64()),
            "n_groups": n_groups.astype(np.int64),
            "groups_sha256": digests,
            "codes": lists,
            "pairs": pa.nulls(len(given), pa.list_(pa.int64())),
            "counts": pa.nulls(len(given), pa.list_(pa.int64())),
        }
    )
    yield from rows.to_batches(max_chunksize=ROWS)
    found = [pa.array([counted[c].to_pylist()], pa.list_(pa.int64())) for c in ("pair", "count_all")]
    empty = [pa.array([block]), *(pa.nulls(1, rows.schema.field(k).type) for k in range(1, 7)), *found]
    yield pa.RecordBatch.from_arrays(empty, names=rows.column_names)


def coded(docs: DataFrame, byte_level: str, pieces: str, block: int = BLOCK) -> DataFrame:
    """A written table: per document its numbers and its links as numbers of its block's pairs (``codes``), and per
    block one row without documents that lists those ``pairs`` with their ``counts``."""
    with open(byte_level, encoding="utf-8") as file:
        model_a = file.read()
    with open(pieces, "rb") as file:
        model_b = base64.b64encode(file.read()).decode()
    models = docs.sparkSession.sparkContext.broadcast((model_a, model_b))  # the two vocabulary files: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(*models.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, texts in together(batch.column(1), block):
                yield from _block(batch.column(0).slice(first, len(texts)), texts, coders, number)
                number += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, codes array<int>, pairs array<long>, counts array<long>"
    path = fresh_path(docs.sparkSession, "alignment")
    docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def pair_counts(blocks: DataFrame, n_pieces: int) -> DataFrame:
    """(block, code, count, best): for every pair of a block its corpus-wide count, and whether no pair with its B id has more."""
    listed = blocks.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "p"))
    listed = listed.select("block", "code", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    whole = listed.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.pmod("pair", F.lit(n_pieces)))
    top = whole.groupBy("b").agg(F.max("count").alias("top"))
    judged = whole.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    return listed.join(judged, "pair").select("block", "code", "count", "best")


def _summed(rows: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links, given its pairs' corpus-wide counts."""
    size = len(known)
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    code = known["code"].to_numpy()
    count[code], best[code] = known["count"].to_numpy(), known["best"].to_numpy().astype(np.int64)
    out = []
    for batch in rows.to_batches():
        lists = batch.column("codes")
        flat = lists.flatten().to_numpy()
        edge = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        sums = [np.diff(np.concatenate(([0], np.cumsum(x[flat])))[edge]) for x in (best, count)]
        kept = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
        out.append(pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(edge)), *map(pa.array, sums), batch.column("groups_sha256")], names=NAMES))
    return pa.Table.from_batches(out)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def align(docs: DataFrame, byte_level: str, pieces: str, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    n_pieces = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    blocks = coded(docs, byte_level, pieces, block)
    rows = blocks.where("codes is not null").select("block", *[c for c in blocks.columns[1:7]])
    known = pair_counts(blocks, n_pieces).select(F.col("block").alias("of"), "code", "count", "best")
    kind = blocks.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_summed, out)


@query("op12_tokenizer_alignment")
def op12(spark, folder):
    import public_tokenizers

    return align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
