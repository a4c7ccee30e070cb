"""Registry and small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import OWN_SCRATCH, fresh_path, remove_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ready(spark: SparkSession) -> SparkSession:
    """Adaptive execution on; a scratch folder of our own only on a local master that names none."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.startswith("local["):
        spark.conf.set(OWN_SCRATCH, os.path.join(tempfile.gettempdir(), "forecourt-scratch"))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rewritten(df: DataFrame, label: str, old: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path; ``old``, a table that only ``df`` was to read, goes."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    if old is not None:
        remove_folder(df.sparkSession, old)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``, with the SQL that states its rows where there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(ready(spark), folder)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no such column (case aside)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def together(texts: pa.Array, limit: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows up to ``limit`` characters, one row at least."""
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        text = text.as_py()
        if held and size + len(text or "") > limit:
            yield first, held
            held, size, first = [], 0, k
        held.append(text)
        size += len(text or "")
    if held:
        yield first, held
