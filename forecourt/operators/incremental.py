"""Incremental windows and gates.

Bounds are scalar subqueries that already hold the shifted value in the type of
the time column: nothing runs on the driver, and the filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.periods import period_start, step

# Fixed value: where a first run starts.
EPOCH = "2000-01-01 00:00:00"


def epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp")


def _scalar(df: DataFrame, value: Column) -> Column:
    return df.agg(value.alias("v")).scalar()


def _minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def high_water(target: DataFrame, ts: str, minutes: int = 0) -> Column:
    """Newest stored time (the epoch when there is none) moved by ``minutes``, in the type of ``ts``."""
    kind = target.schema[ts].dataType
    return _scalar(target, (F.coalesce(F.max(ts), epoch().cast(kind)) + _minutes(minutes)).cast(kind))


def high_water_window(target: DataFrame, ts: str, now: Column, reupload_minutes: int = 0, lag_minutes: int = 0) -> tuple[Column, Column]:
    """(lo, hi): last stored time plus the (negative) re-read span, and now plus the lag."""
    hi = (now + _minutes(lag_minutes)).cast(target.schema[ts].dataType)
    return high_water(target, ts, reupload_minutes), hi


def in_window(df: DataFrame, ts: str, window: tuple[Column, Column]) -> DataFrame:
    lo, hi = window
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def api_window(target: DataFrame, ts: str, now: Column, zone: str = "America/Toronto", lag_hours: int = 2) -> tuple[Column, Column]:
    """(lo, hi) as wall-clock time of ``zone``, as the billing export asks for it."""
    lo = high_water(target, ts).cast("timestamp")
    return F.from_utc_timestamp(lo, zone), F.from_utc_timestamp(now + _minutes(-60 * lag_hours), zone)


def lookback_to_day(source: DataFrame, target: DataFrame, ts: str, days: int = 3, newest_of: DataFrame | None = None) -> DataFrame:
    """Rows from ``days`` before the target's newest row up to the last complete day of the source."""
    kind = source.schema[ts].dataType
    hi = _scalar(newest_of or source, F.date_trunc("day", F.max(ts)).cast(kind))
    return in_window(source, ts, (high_water(target, ts, -1440 * days), hi))


def since_newest(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows at most ``days`` before the newest one."""
    return df.where(F.col(ts) >= _scalar(df, F.max(ts) - F.make_dt_interval(days=F.lit(days))))


def multi_feed_barrier(feeds: Sequence[DataFrame], ts: str, unit: str, done: DataFrame | None = None, done_date: str = "date") -> DataFrame:
    """One row (lo, hi): periods [lo, hi) that every feed has passed; an empty feed is an error.

    ``lo`` is one period after the last one in ``done``, else the first period of any feed.
    """
    spans = [f.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")) for f in feeds]
    rows = spans[0]
    for s in spans[1:]:
        rows = rows.unionAll(s)
    hole = F.when(F.count_if(F.col("hi").isNull()) > 0, F.raise_error(F.lit("a feed is empty")).cast("timestamp"))
    bounds = rows.agg(
        F.coalesce(hole, F.min("lo").cast("timestamp")).alias("lo"), F.min("hi").cast("timestamp").alias("hi")
    )
    kind = feeds[0].schema[ts].dataType
    lo = period_start(F.col("lo"), unit)
    if done is not None:
        lo = F.coalesce(_scalar(done, F.max(done_date)).cast("timestamp") + step(unit), lo)
    return bounds.select(lo.cast(kind).alias("lo"), period_start(F.col("hi"), unit).cast(kind).alias("hi"))


def freshness_gate(
    sources: Sequence[DataFrame], target: DataFrame, ts: str, hours: int = 24, inclusive: bool = False
) -> DataFrame:
    """One row (stale): every source is more than (or, inclusive, at least) ``hours`` ahead of the target."""
    stored = F.unix_micros(high_water(target, ts).cast("timestamp"))
    limit = hours * 3600 * 1_000_000
    stale = F.lit(True)
    rows = target.sparkSession.range(1)
    for i, s in enumerate(sources):
        newest = _scalar(s, F.max(ts)).cast("timestamp")
        ahead = F.unix_micros(F.coalesce(newest, F.raise_error(F.lit(f"source {i} is empty")).cast("timestamp"))) - stored
        stale = stale & ((ahead >= limit) if inclusive else (ahead > limit))
    return rows.select(stale.alias("stale"))
