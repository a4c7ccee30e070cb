"""File ledger: which files a job has read, and which rows came from them."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.operators.incremental import high_water
from forecourt.session import child_folders, materialize, remove_folder, setting

# Shuffled bytes that one task sorts and lands; narrow rows take some forty times as much memory.
LANDED_BYTES = "16m"

LEDGER_SCHEMA = "id bigint, file string, last_modified timestamp, script string, scanned timestamp"


def new_files(listing: DataFrame, ledger: DataFrame, script: str) -> DataFrame:
    """Files (file, last_modified) the job has not read."""
    done = ledger.where(F.col("script") == script).select("file")
    return listing.select("file", "last_modified").join(done, ["file"], "left_anti")


def rows_of_new_files(rows: DataFrame, ledger: DataFrame, script: str) -> DataFrame:
    """Rows whose ``file`` the job has not read."""
    done = ledger.where(F.col("script") == script).select("file")
    return rows.join(done, ["file"], "left_anti")


def newer_than(listing: DataFrame, ledger: DataFrame, script: str) -> DataFrame:
    """Files modified after the newest one the job has recorded."""
    return listing.where(F.col("last_modified") > high_water(ledger.where(F.col("script") == script), "last_modified"))


def record_files(ledger: DataFrame, files: DataFrame, script: str, now: Column) -> DataFrame:
    """Ledger with the new files added.

    Ids are a hash of (file, script): the same file gets the same id on every
    attempt, and no task has to number all files.
    """
    id_ = F.xxhash64("file", F.lit(script))
    fresh = files.select(id_.alias("id"), "file", "last_modified", F.lit(script).alias("script"), now.alias("scanned"))
    return ledger.unionByName(fresh)


def with_file_id(rows: DataFrame, ledger: DataFrame, script: str, out: str = "file_id") -> DataFrame:
    """Replace ``file`` by its ledger id."""
    ids = ledger.where(F.col("script") == script).select("file", F.col("id").alias(out))
    return rows.join(ids, ["file"]).drop("file")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, a partition per job; empty before the first delivery."""
    empty = nothing(spark, LEDGER_SCHEMA)
    return spark.read.schema(empty.schema).parquet(path) if child_folders(spark, path) else empty


def nothing(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of ``schema``, which Spark knows to be none: a join with them shuffles nothing."""
    fields = spark.createDataFrame([], schema).schema.fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed rows of ``schema`` with their ``script`` and ``file_id``, the partitions they lie in."""
    fields = spark.createDataFrame([], schema).schema.fields
    wide = T.StructType([*fields, T.StructField("script", T.StringType()), T.StructField("file_id", T.LongType())])
    return spark.read.schema(wide).parquet(path) if child_folders(spark, path) else nothing(spark, wide)


def publish_files(rows: DataFrame, rows_path: str, ledger_path: str, script: str, now: Column) -> None:
    """Land ``rows`` (with file and last_modified) of files the job has not read, then enter the files into the ledger.

    Rows lie in a partition per job and file id, the ledger in one per job, so a
    delivery writes its own rows and ledger rows only. A crash in between leaves
    rows whose file the ledger lacks: `published` hides them, and the next
    attempt, which still sees the files as new, overwrites their partitions. So
    each file counts once or not yet.
    """
    spark = rows.sparkSession
    ledger = read_ledger(spark, ledger_path)
    fresh = rows_of_new_files(rows, ledger, script)
    files = fresh.select("file", "last_modified").distinct()
    # The files are fixed before anything is landed.
    entered = materialize(record_files(nothing(spark, ledger.schema), files, script, now), "ledger")
    landed = with_file_id(fresh.drop("last_modified"), entered, script).withColumn("script", F.lit(script))
    dynamic = landed.hint("rebalance", "file_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", LANDED_BYTES):
        dynamic.partitionBy("script", "file_id").parquet(rows_path)
    append_ledger(entered, ledger_path)


def append_ledger(entered: DataFrame, path: str) -> None:
    entered.coalesce(1).write.mode("append").partitionBy("script").parquet(path)


def published(rows: DataFrame, ledger: DataFrame, script: str) -> DataFrame:
    """The job's rows whose file the ledger has; other jobs' partitions, and those of other files, are not read."""
    mine = ledger.where(F.col("script") == script).select(F.col("id").alias("file_id"))
    return rows.where(F.col("script") == script).join(mine, ["file_id"], "left_semi")


def purge_job(spark: SparkSession, rows_path: str, ledger_path: str, script: str) -> None:
    """Forget the job's files, so that they are read again, and drop their rows: two folders, the ledger's first."""
    for path in (ledger_path, rows_path):
        for folder, _ in child_folders(spark, path):
            if unquote(folder.rsplit("/", 1)[-1]) == f"script={script}":
                remove_folder(spark, folder)
