"""Sinks: whole-table replace behind a catalog name, partition upserts, view refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from forecourt.operators.merge import upsert_replace
from forecourt.session import child_folders, fresh_path, make_folder, remove_folder


def replace_table(df: DataFrame, table: str, base: str | None = None) -> None:
    """Write ``df`` to a new folder, then point ``table`` at it.

    Readers see the old or the new rows, never a mix, and ``df`` may itself
    read ``table``. Old folders stay, for readers that began before, until
    ``session.prune_scratch`` removes those past the caller's retention.
    """
    spark = df.sparkSession
    path = fresh_path(spark, table) if base is None else f"{base}/{fresh_path(spark, table).rsplit('/', 1)[-1]}"
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def upsert_partitions(changes: DataFrame, path: str, keys: Sequence[str], partition: str) -> None:
    """Upsert into a partitioned folder, rewriting only the partitions the batch touches.

    The partitions are overwritten in place: a reader, or a crash, may meet some
    of them gone. ``streaming.epochs`` lands batches beside each other instead.

    A key must always fall into the same partition value. The list of touched
    partitions is as long as the batch has partition values, not rows.
    """
    spark = changes.sparkSession
    stored = spark.read.parquet(path)
    touched = changes.select(partition).distinct()
    merged = upsert_replace(stored.join(touched, [partition], "left_semi"), changes.select(*stored.columns), keys)
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def drop_partitions(spark: SparkSession, path: str, partition: str, gone: Callable[[str], bool]) -> list[str]:
    """Remove the partitions whose value, as text, is ``gone``; the values. Other partitions are not touched."""
    values = []
    for folder, _ in child_folders(spark, path):
        name, _, value = folder.rsplit("/", 1)[-1].partition("=")
        if name == partition and gone(unquote(value)):
            remove_folder(spark, folder)
            values.append(unquote(value))
    return sorted(values)


def refresh_views(rollup: DataFrame, views: Mapping[str, Sequence[str]], view: str = "view", prefix: str = "") -> dict[str, str]:
    """Write a rollup that holds several derived tables once, a partition each, and point each table at its own.

    ``views`` names the columns of every table; the tables are ``prefix`` and
    the view's name, which are returned by view. One write makes them all, and
    the tables are swapped one by one when it is done. Old folders stay, as in
    `replace_table`. Files are as large as ``rollup`` is laid out by view.
    """
    spark = rollup.sparkSession
    path = fresh_path(spark, "views")
    rollup.write.partitionBy(view).parquet(path)
    tables = {}
    for name, columns in views.items():
        table, folder = prefix + name, f"{path}/{view}={name}"
        make_folder(spark, folder)  # a view without rows has none yet
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            schema = T.StructType([rollup.schema[c] for c in columns])
            spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)
        tables[name] = table
    return tables
