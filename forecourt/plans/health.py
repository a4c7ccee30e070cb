"""Job health, archive reconciliation, data quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.scalars import cardinality_ok, json_field, overdue_by
from forecourt.operators.aggregates import reconcile, reconcile_counts
from forecourt.operators.filters import unhealthy_jobs


def job_alerts(jobs: DataFrame, now: Column) -> DataFrame:
    """Jobs with the time since their last run, an overdue flag and a bad-status flag."""
    seconds = F.unix_seconds(F.col("start_date") + F.col("frequency")) - F.unix_seconds(F.col("start_date"))
    bad = F.col("status").isNotNull() & (F.col("status") != "success")
    return jobs.withColumns(
        {
            "time_since_last_run": now - F.col("last_run"),
            "is_overdue": overdue_by(F.col("last_run"), seconds, now),
            "bad_status": F.when(bad, 1).otherwise(0),
        }
    )


def job_monitor(jobs: DataFrame, now: Column, schema: str, script: str) -> DataFrame:
    return jobs.where(unhealthy_jobs(now, schema, script))


def archived_ids(events: DataFrame, *path: str) -> DataFrame:
    """Ids found in event payloads at a nested path."""
    return events.select(json_field(F.col("payload"), *path).alias("id"))


def archive_reconcile(expected: DataFrame, events: DataFrame, *path: str) -> DataFrame:
    return reconcile(expected, archived_ids(events, *path), "id")


def archive_reconcile_counts(expected: DataFrame, events: DataFrame, *path: str) -> DataFrame:
    return reconcile_counts(expected, archived_ids(events, *path), "id")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: what a unique index would reject."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def empty_arrays(df: DataFrame, column: str) -> DataFrame:
    """Rows whose array is empty: what the CHECK on labels would reject."""
    return df.where(~cardinality_ok(F.col(column)))
