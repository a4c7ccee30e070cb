"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Timestamps are instants in UTC; skewed
# join partitions are split at run time; broadcast stays under Spark's own size
# check (autoBroadcastJoinThreshold), so no operator hints an unbounded side.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streams keep their state on disk, and the slowest of several feeds closes periods.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}

OWN_SCRATCH = "forecourt.scratch"


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting that holds for the jobs run inside."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a caller can't set it later, so OWN_SCRATCH may stand for it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_SCRATCH, None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/forecourt/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(target) and system.getFileStatus(target).isDirectory()


def child_folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the folders in ``path``; none if it does not exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    return [(s.getPath().toString(), s.getModificationTime()) for s in system.listStatus(root) if s.isDirectory()]


def prune_scratch(spark: SparkSession, keep_ms: int, now_ms: int) -> list[str]:
    """Remove intermediate folders not changed for ``keep_ms``; no job that reads them may still run."""
    old = [p for p, at in child_folders(spark, f"{scratch_root(spark)}/forecourt") if at < now_ms - keep_ms]
    for path in old:
        remove_folder(spark, path)
    return old


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a costly plan feeds several later steps: a written table
    survives the loss of executors and cuts the lineage.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
