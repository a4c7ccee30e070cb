"""Accident-check report rollups: checked, clean, reported, share reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.aggregates import count_by_period, share_by_period

# Lifetime has no date column.
PERIODS = {"lifetime": None, "weekly": "week", "monthly": "month", "quarterly": "quarter", "yearly": "year"}
# Outcomes of a report.
REPORTED, CLEAN = "yes", "no"

_KEYS = ["master_business_id"]


def _outcome(value: str):
    return F.col("accident_reported") == value


def reports_checked(reports: DataFrame, period: str) -> DataFrame:
    return count_by_period(reports, _KEYS, "created_at", PERIODS[period], "vins")


def reports_clean(reports: DataFrame, period: str) -> DataFrame:
    return count_by_period(reports, _KEYS, "created_at", PERIODS[period], "vins", _outcome(CLEAN))


def reports_reported(reports: DataFrame, period: str) -> DataFrame:
    return count_by_period(reports, _KEYS, "created_at", PERIODS[period], "vins", _outcome(REPORTED))


def reports_proportion(reports: DataFrame, period: str) -> DataFrame:
    return share_by_period(reports, _KEYS, _outcome(REPORTED), "created_at", PERIODS[period], "vins")


ROLLUPS = {
    "reports_checked": reports_checked,
    "reports_clean": reports_clean,
    "reports_reported": reports_reported,
    "reports_proportion": reports_proportion,
}
