"""Calendar periods and interval arithmetic on timestamp columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = {
    "day": "INTERVAL '1' DAY",
    "week": "INTERVAL '7' DAY",
    "month": "INTERVAL '1' MONTH",
    "quarter": "INTERVAL '3' MONTH",
    "year": "INTERVAL '12' MONTH",
}


def step(unit: str) -> Column:
    return F.expr(_STEP[unit])


def period_start(c: Column, unit: str) -> Column:
    """Start of the day, week (Monday), month, quarter or year holding ``c``."""
    if unit not in _STEP:
        raise ValueError(f"unknown period {unit!r}")
    return F.date_trunc(unit, c)


def add_minutes(c: Column, n) -> Column:
    return c + F.make_dt_interval(mins=_int(n))


def add_hours(c: Column, n) -> Column:
    return c + F.make_dt_interval(hours=_int(n))


def add_days(c: Column, n) -> Column:
    return c + F.make_dt_interval(days=_int(n))


def add_months(c: Column, n) -> Column:
    """Calendar months; the day of month is clamped to the target month."""
    return c + F.make_ym_interval(months=_int(n))


def _int(n) -> Column:
    return n if isinstance(n, Column) else F.lit(int(n))


def closed_starts(lo: Column, hi: Column, unit: str) -> Column:
    """Array of period starts p with trunc(lo) <= p < trunc(hi); empty when there is none."""
    first, stop = period_start(lo, unit), period_start(hi, unit)
    starts = F.sequence(first, stop - step(unit), step(unit))
    return F.when(first < stop, starts).otherwise(F.array().cast("array<timestamp>"))


def closed_periods(bounds: DataFrame, lo: str, hi: str, unit: str, out: str = "period") -> DataFrame:
    """One row per closed period of every (lo, hi) row of ``bounds``."""
    return bounds.withColumn(out, F.explode(closed_starts(F.col(lo), F.col(hi), unit)))


def next_run(start: Column, frequency: Column, last_run: Column) -> Column:
    """First slot of the grid ``start + k * frequency`` after the slot of ``last_run``.

    A job that never ran is due at ``start``. The quotient is cut toward zero, so a
    run before ``start`` still counts as slot 0.
    """
    size = F.unix_micros(start + frequency) - F.unix_micros(start)
    gone = F.unix_micros(last_run) - F.unix_micros(start)
    # % keeps the sign of the dividend, so this subtraction cuts toward zero.
    target = F.unix_micros(start) + gone - gone % size + size
    return F.when(last_run.isNull(), start).otherwise(F.timestamp_micros(target))
