"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash of it; texts are equal if their bytes are.

1. Sizes. Per key, the most bytes that its entries can take is known from the number and length of its texts; summed
   over the leading bits of the key, that gives a histogram of at most 2**20 slots, whatever the size of the corpus.
2. Directory (`doubled`). It begins with one bucket for all keys. While a bucket holds over ``capacity`` bytes it is
   split by the next bit of the key, which doubles the directory where it is as deep as the bucket. A bucket that the
   deepest directory cannot split (copies of one text have one key) gets pages instead.
3. Entries. A task folds the texts it reads, block by block, into distinct ones with their number and largest doc_id,
   so a text that is a third of the corpus is sent once per block.
4. Owners. Every bucket, or page of one, has one owner task, which takes its entries in the order of their keys,
   chains the texts of equal key, comparing bytes, and writes the chains to the index's files. The chains of paged
   buckets, at most one entry a page, then go to one owner.
5. Every document looks its class up in the index by key and digest.

Defined cases: a null text counts as empty; the row with the largest doc_id stays, and rows that repeat that doc_id
and text stay together; a null doc_id is less than any other, and stays only if its whole class has none; an empty
table gives no rows; further columns are left alone. A text is compared whole; an owner holds the chain of one key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import query, table
from forecourt.session import fresh_path, materialize

CAPACITY = 16 << 20
#: Bytes of text that a task folds at a time.
BLOCK_BYTES = 8 << 20
#: The directory has at most 2**DEEPEST slots; beyond that, capacity grows with the corpus.
DEEPEST = 20
#: Classes of over a thousandth of all rows are at most a thousand, and are broadcast.
HOT_SHARE = 1000


def text_key(text: Column, bits: int = 64) -> Column:
    """The hash of a text; of fewer ``bits``, so that tests can make keys collide."""
    return F.xxhash64(text) if bits == 64 else F.shiftleft(F.xxhash64(text), 64 - bits)


def slot_of(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def doubled(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(depth, bytes) of the bucket that each slot points to, for the bytes per slot of the deepest directory."""
    deepest = int(len(sizes)).bit_length() - 1
    depth = np.zeros(len(sizes), np.int64)
    held = np.full(len(sizes), sizes.sum())
    for d in range(deepest):
        over = (depth == d) & (held > capacity)
        if not over.any():
            break
        halves = np.repeat(sizes.reshape(2 << d, -1).sum(axis=1), len(sizes) >> (d + 1))
        depth[over], held[over] = d + 1, halves[over]
    return depth, held


def directory(keyed: DataFrame, capacity: int = CAPACITY, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, int, int]:
    """((slot, bucket, pages) of the deepest directory, its depth, buckets, pages beyond one a bucket) for ``keyed`` (key, n_bytes)."""
    per_key = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("n_bytes").alias("longest"), F.sum("n_bytes").alias("bytes"))
    per_key = materialize(per_key, "dedup-keys")
    total, distinct = per_key.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("longest"), F.lit(0))).first()
    blocks = total // block_bytes + keyed.sparkSession.sparkContext.defaultParallelism
    capacity = max(capacity, int(distinct) >> (DEEPEST - 4))
    deepest = min(DEEPEST, max(0, int(-(-distinct // capacity) - 1).bit_length()) + 4)
    bound = F.least("bytes", F.col("longest") * blocks)
    rows = per_key.groupBy(slot_of(F.col("key"), deepest).alias("slot")).agg(F.sum(bound)).collect()  # at most 2**DEEPEST
    sizes = np.zeros(1 << deepest, np.int64)
    for slot, size in rows:
        sizes[slot] = size
    depth, held = doubled(sizes, capacity)
    bucket = np.arange(len(sizes)) >> (deepest - depth) << (deepest - depth)
    pages = np.maximum(1, -(-held // capacity))
    slots = pa.table({"slot": np.arange(len(sizes)), "bucket": bucket, "pages": pages})
    _, one = np.unique(bucket, return_index=True)
    return keyed.sparkSession.createDataFrame(slots), deepest, len(one), int(pages[one].sum()) - len(one)


def entries(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, text, n, top, block): the distinct texts of every block of ``docs`` (doc_id, key, text as bytes)."""

    def fold(held: list[pa.RecordBatch]) -> pa.Table:
        rows = pa.Table.from_batches(held)
        one = rows.group_by(["key", "text"]).aggregate([("doc_id", "max"), ("doc_id", "count", pc.CountOptions(mode="all"))])
        return one.rename_columns(["key", "text", "top", "n"]).select(["key", "text", "n", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, block = [], 0, 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= block_bytes:
                yield from _with_block(fold(held), block)
                held, size, block = [], 0, block + 1
        if held:
            yield from _with_block(fold(held), block)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "text").mapInArrow(run, f"key long, text binary, n long, top {kind}, block int")


def _with_block(rows: pa.Table, block: int) -> Iterator[pa.RecordBatch]:
    yield from rows.append_column("block", pa.array([block] * len(rows), pa.int32())).to_batches(max_chunksize=1024)


def chained(rows: DataFrame, owners: int) -> DataFrame:
    """Chains of ``rows`` (bucket, page, key, text, n, top), each bucket and page by the task that owns it.

    (bucket, page, key, sha256, text, n, top), one row per distinct text of a bucket's page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chain, done = None, [], []
        for batch in batches:
            for bucket, page, key, text, n, top in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, page, key) != at:
                    done += chain
                    at, chain = (bucket, page, key), []
                for entry in chain:
                    if entry[4] == text:
                        entry[5] += n
                        entry[6] = top if entry[6] is None or (top is not None and top > entry[6]) else entry[6]
                        break
                else:
                    digest = hashlib.sha256(text).hexdigest()
                    if any(entry[3] == digest for entry in chain):
                        raise ValueError(f"different texts share the key {key} and the digest {digest}")
                    chain.append([bucket, page, key, digest, text, n, top])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
        done += chain
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    top = rows.schema["top"].dataType.simpleString()
    names = ["bucket", "page", "key", "sha256", "text", "n", "top"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), None]
    owned = rows.select("bucket", "page", "key", "text", "n", "top").repartition(owners, "bucket", "page").sortWithinPartitions("bucket", "page", "key")
    return owned.mapInArrow(run, f"bucket long, page long, key long, sha256 string, text binary, n long, top {top}")


def build(docs: DataFrame, capacity: int = CAPACITY, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """The index of ``docs`` (doc_id, text): a written table (bucket, key, sha256, text, n, top) of every distinct text.

    Its files lie in one folder per bucket.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = docs.select("doc_id", text_key(F.col("text"), bits).alias("key"), F.col("text").cast("binary").alias("text"))
    slots, depth, buckets, more = directory(keyed.select("key", F.octet_length("text").cast("long").alias("n_bytes")), capacity, block_bytes)
    folded = entries(keyed, block_bytes).withColumn("slot", slot_of(F.col("key"), depth))
    page = F.pmod(F.xxhash64(F.spark_partition_id(), "block"), F.col("pages")).alias("page")
    dealt = folded.join(F.broadcast(slots), "slot").select("bucket", page, "key", "text", "n", "top", "pages")
    if more:
        pages = materialize(chained(dealt.where("pages > 1"), buckets + more), "dedup-pages").withColumn("page", F.lit(0).cast("long"))
        dealt = dealt.where("pages = 1").drop("pages").unionByName(pages.drop("sha256"))
    index = chained(dealt, buckets).drop("page")
    path = fresh_path(spark, "dedup-index")
    index.write.partitionBy("bucket").parquet(path)
    return spark.read.schema(index.schema).parquet(path)


def duplicates(docs: DataFrame, capacity: int = CAPACITY, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """Per row: doc_id, keep_id (the largest doc_id of equal texts), group_size, kept, text_sha256."""
    index = build(docs, capacity, block_bytes, bits)
    classes = index.where("n > 1").select("key", "sha256", F.col("top").alias("keep_id"), F.col("n").alias("group_size"))
    total = index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select("doc_id", text_key(text, bits).alias("key"), F.sha2(text, 256).alias("sha256"))
    hot = classes.where(F.col("group_size") * HOT_SHARE > total)
    hot = hot.select("key", "sha256", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    met = own.join(F.broadcast(hot), ["key", "sha256"], "left")
    # Rows whose class is known already look nothing up; a number of their own keeps them from meeting in one task.
    lone = F.when(F.col("hot_size").isNull(), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1)
    cold = classes.where(F.col("group_size") * HOT_SHARE <= total).withColumn("lone", F.lit(0).cast("long"))
    met = met.withColumn("lone", lone).join(cold, ["key", "sha256", "lone"], "left")
    size = F.coalesce("hot_size", "group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("hot_size").isNotNull(), F.col("hot_id")).when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
    return met.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha256").alias("text_sha256"))


SQL = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id, count(*) over (partition by coalesce(text, '')) as group_size,
  doc_id is not distinct from max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
from documents
"""


@query("op13_exact_dedup", SQL)
def op13(spark, folder):
    return duplicates(table(spark, folder, "documents"))
