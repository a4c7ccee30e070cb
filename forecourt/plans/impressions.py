"""Distinct visitors per business and closed period over several event feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.payload import as_uuid, parse_payload
from forecourt.operators.aggregates import distinct_by_period, union_feeds
from forecourt.operators.incremental import multi_feed_barrier


def visits(feed: DataFrame, business: str = "master_business_id", visitor: str = "ip_address") -> DataFrame:
    """(business, happened_at, visitor) read from the event payload; a business that is no UUID is NULL."""
    parsed = feed.select("happened_at", parse_payload(F.col("payload"), [business, visitor]).alias("_p"))
    return parsed.select(
        as_uuid(F.col("_p").getField(business)).alias("master_business_id"),
        "happened_at",
        F.col("_p").getField(visitor).alias("ip_address"),
    )


def unique_impressions(feeds: Sequence[DataFrame], unit: str, done: DataFrame | None = None) -> DataFrame:
    """(master_business_id, date, impressions) of all closed periods not yet in ``done``.

    ``feeds`` have the columns of ``visits``. All periods are computed in one
    job; the distinct count makes the de-duplicating UNION unnecessary.
    """
    barrier = multi_feed_barrier(feeds, "happened_at", unit, done)
    lo, hi = (barrier.select(c).scalar() for c in ("lo", "hi"))
    rows = union_feeds(feeds, distinct=False)
    rows = rows.where((F.col("happened_at") >= lo) & (F.col("happened_at") < hi))
    return distinct_by_period(rows, ["master_business_id"], "ip_address", "happened_at", unit, "impressions")
