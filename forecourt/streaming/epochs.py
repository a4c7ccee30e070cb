"""Tables that streams land in: one Parquet partition per micro-batch.

A batch is written to the partition ``epoch=<its number>``, and one that is
repeated after a failure overwrites its own partition, so it counts once. The
rows of a key are those of its newest epoch, taken at reading. Compaction
writes them once to a new folder and swaps it in (`sinks.replace_table`); the
partitions it has taken up go afterwards. One checkpoint and one writer per
folder: another checkpoint would number its batches anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from forecourt.operators.latest import latest_per_key
from forecourt.session import child_folders, remove_folder
from forecourt.sources.sinks import replace_table

EPOCH = "epoch"


def land(batch: DataFrame, path: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")


def epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the landed batches, ascending."""
    names = [folder.rsplit("/", 1)[-1] for folder, _ in child_folders(spark, path)]
    return sorted(int(n.removeprefix(f"{EPOCH}=")) for n in names if n.startswith(f"{EPOCH}="))


def landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed rows with their epoch; none before the first batch."""
    wide = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType())])
    return spark.read.schema(wide).parquet(path) if epochs(spark, path) else spark.createDataFrame([], wide)


def newest_rows(spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], table: str | None = None) -> DataFrame:
    """Per key the row of its newest epoch, among the landed batches and the compacted ``table``."""
    schema = spark.createDataFrame([], schema).schema
    return _newest(spark, landed(spark, path, schema), keys, table).drop(EPOCH)


def _newest(spark: SparkSession, rows: DataFrame, keys: Sequence[str], table: str | None) -> DataFrame:
    if table is not None and spark.catalog.tableExists(table):
        rows = rows.unionByName(spark.table(table))
    return latest_per_key(rows, keys, EPOCH)


def compact(spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], table: str, base: str | None = None) -> list[int]:
    """Take all batches but the newest up into ``table``; the epochs that went.

    The newest batch may still be written, or be repeated, so it stays. A stop
    between the swap and the removal leaves rows twice, under one epoch, which
    reading takes once and the next compaction removes.
    """
    done = epochs(spark, path)[:-1]
    if not done:
        return []
    schema = spark.createDataFrame([], schema).schema
    rows = landed(spark, path, schema).where(f"{EPOCH} <= {done[-1]}")
    replace_table(_newest(spark, rows, keys, table), table, base)
    for epoch in done:
        remove_folder(spark, f"{path}/{EPOCH}={epoch}")
    return done
