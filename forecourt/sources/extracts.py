"""Extracts from application tables: any DataFrame, or a JDBC table read in slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.payload import pack_payload
from forecourt.operators.incremental import in_window
from forecourt.operators.joins import join_unique_names

Window = tuple[Column, Column]


def jdbc_table(spark: SparkSession, url: str, table: str, slices: Sequence[str], properties: dict[str, str]) -> DataFrame:
    """A database table read by parallel range predicates; later filters are pushed to the database."""
    return spark.read.jdbc(url, table, predicates=list(slices), properties=properties)


def day_slices(column: str, days: Sequence[str]) -> list[str]:
    """Range predicates between consecutive days, open at both ends."""
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(days, days[1:])]
    return [f"{column} < '{days[0]}' OR {column} IS NULL", *inner, f"{column} >= '{days[-1]}'"]


def extract_incremental(source: DataFrame, ts: str, window: Window, keep: Sequence[str], extra: Column | None = None) -> DataFrame:
    """Rows of the window in landing shape: ``keep`` columns and the rest as payload."""
    rows = in_window(source, ts, window)
    return pack_payload(rows if extra is None else rows.where(extra), keep)


def extract_full(source: DataFrame, key: str) -> DataFrame:
    return pack_payload(source, [key])


def extract_joined(header: DataFrame, detail: DataFrame, on: Column, ts: str, window: Window, keep: Sequence[str], drop: Sequence[str], extra: Column) -> DataFrame:
    """Window of a header table with its detail row; equal column names are an error."""
    rows = in_window(header, ts, window).where(extra)
    return pack_payload(join_unique_names(rows, detail, on, "left", drop), keep)


def extract_typed_audit(source: DataFrame, window: Window) -> DataFrame:
    """Audit rows with typed columns; request and response stay JSON text."""
    rows = in_window(source, "happened_at", window)
    return rows.select(
        "id",
        "user_id",
        "happened_at",
        "request_method",
        "request_payload",
        F.col("response_code").try_cast("int").alias("response_code"),
        "response_payload",
        "endpoint",
    )
