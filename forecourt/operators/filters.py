"""Row filters. A predicate that is NULL drops the row, as in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import scalars as S
from forecourt.functions.vehicle import vin_pattern

# Units of the used-car feed and the bounds of the price-model feed.
KILOMETERS, CAD = "KILOMETERS", "CAD"
MIN_MILES, MAX_MILES, MIN_PRICE = 1000, 250000, 500
# Charge products are given by the caller, the posting state is not.
POSTED = "Posted"


def event_named(name: str, column: str = "event_name") -> Column:
    return F.col(column) == name


def listing_identity_ok() -> Column:
    """Dealer id parses, VIN and its pattern agree, both times are present."""
    return (
        S.safe_int(F.col("dealer_id_is")).isNotNull()
        & (F.col("vin_ss") != "")
        & (vin_pattern(F.col("vin_ss")) == F.col("taxonomy_vin_ss"))
        & S.parse_instant(F.col("scraped_at_dts")).isNotNull()
        & S.parse_instant(F.col("status_date_dts")).isNotNull()
    )


def _miles() -> Column:
    return S.safe_double(F.col("miles_fs"))


def _price() -> Column:
    return S.safe_double(F.col("price_fs"))


def metric_units() -> Column:
    return (F.col("miles_indicator_ss") == KILOMETERS) & (F.col("currency_indicator_ss") == CAD)


def listing_ca_new() -> Column:
    return listing_identity_ok()


def listing_ca_used() -> Column:
    return listing_identity_ok() & metric_units() & _miles().isNotNull() & _price().isNotNull()


def listing_us_used() -> Column:
    return listing_identity_ok() & _miles().isNotNull() & _price().isNotNull() & (_price() != _miles())


def training_listing(reject_price_equal_miles: bool = True) -> Column:
    """Units, miles and price in range. NaN passes the range tests, as it does in the source job."""
    miles, price = _miles(), _price()
    keep = metric_units() & (F.isnan(miles) | miles.between(MIN_MILES, MAX_MILES)) & (F.isnan(price) | (price >= MIN_PRICE))
    if reject_price_equal_miles:
        keep = keep & (F.isnan(price) | (price != miles))
    return keep


def exclude_ids(df: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """``NOT IN`` an id table: rows with a NULL id are dropped while the table has rows."""
    gone = ids.select(F.col(id_column).alias("_gone")).distinct()
    return df.where(F.col(column).isNotNull()).join(gone, F.col(column) == F.col("_gone"), "left_anti")


def null_or_equal(column: str, value: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == value)


def recent(ts: str, days: int, now: Column) -> Column:
    """``ts`` is at most ``days`` before ``now``."""
    return F.col(ts) >= now - F.make_dt_interval(days=F.lit(days))


def catalog_current(style: str, year: str, this_year: Column, span: int = 20) -> Column:
    """Drop styles that ended and model years older than ``span``."""
    return ~F.col(style).contains("(ends ") & (F.col(year) >= this_year - span)


def subscribed(column: str, product: str) -> Column:
    return F.col(column).contains(product)


def posted_billing(amount: str | None, status: str, reversed_: str) -> Column:
    keep = (F.col(status) == POSTED) & ~F.col(reversed_)
    return keep if amount is None else keep & (F.col(amount) != 0)


def unhealthy_jobs(now: Column, schema: str, script: str, stale_hours: int = 6) -> Column:
    """Bad status, or no update for a whole frequency, or (not this monitor and) not run for hours.

    The exclusion of the monitor itself binds to the last test only, as shipped.
    """
    silent = F.col("last_update") < F.col("last_run") - F.col("frequency")
    idle = F.col("last_run") < now - F.make_dt_interval(hours=F.lit(stale_hours))
    other = (F.col("schema") != schema) & (F.col("script") != script)
    return (F.col("status") != "success") | silent | (idle & other)


def only_type(columns: Sequence[str], wanted: str) -> Column:
    """Exactly one of ``columns`` is set, and it is ``wanted``."""
    set_count = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.col(wanted).isNotNull() & (set_count == 1)


def consistent_catalog(bodies: str = "bodies", style: str = "style", body_type: str = "body_type") -> Column:
    """One body type per vehicle, or the style names the body, or a mini-van stored as wagon."""
    van = F.col(style).contains("Mini-Van") & (F.col(body_type) == "Wagon")
    return (F.col(bodies) == 1) | F.col(style).contains(F.col(body_type)) | van
