"""Vehicle catalog and the listings matched to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions import scalars as S
from forecourt.functions.vehicle import normalize_body_type, normalize_catalog
from forecourt.operators.filters import catalog_current, consistent_catalog, training_listing
from forecourt.operators.joins import SALTS, distinct_per_group
from forecourt.operators.latest import avg_over_group, earliest_per_key, latest_first_seen
from forecourt.operators.merge import upsert_newest, upsert_newest_partial
from forecourt.operators.spread import broadcastable, heavy_keys, sent_once_by_recency, spread_join

VEHICLE = ("year", "make", "model", "trim", "style")
# Catalog file column -> column.
CATALOG_COLUMNS = {
    "VIN_PATTERN": "vin_pattern",
    "VEHICLE_ID": "vehicle_id",
    "MARKET": "market",
    "YEAR": "year",
    "MAKE": "make",
    "MODEL": "model",
    "TRIM": "trim",
    "STYLE": "style",
    "BODY_TYPE": "body_type",
    "MSRP": "msrp",
}


def typed_catalog(raw: DataFrame, this_year: Column) -> DataFrame:
    """Current catalog rows with typed columns and cleaned wording; an empty text stays empty."""
    wide = raw.select(*[F.coalesce(F.col(src), F.lit("")).alias(out) for src, out in CATALOG_COLUMNS.items()])
    wide = wide.withColumns({"year": S.safe_int(F.col("year")), "vehicle_id": S.safe_int(F.col("vehicle_id")), "msrp": S.safe_double(F.col("msrp"))})
    return normalize_catalog(wide.where(catalog_current("style", "year", this_year)))


def catalog_clean(catalog: DataFrame) -> DataFrame:
    """Catalog rows with a consistent body type, the mean msrp of their pattern and market, and its trim count."""
    # The counts see the whole catalog, the mean only the rows that pass the filter.
    rows = distinct_per_group(catalog, VEHICLE, "body_type", "bodies").where(consistent_catalog())
    trims = catalog.groupBy("vin_pattern").agg(F.countDistinct("trim").alias("vin_pattern_trims"))
    rows = avg_over_group(rows, ["vin_pattern", "market"], "msrp", "vin_pattern_market_avg")
    rows = spread_join(rows, trims, ["vin_pattern"])
    return rows.select("vin_pattern", *VEHICLE, "body_type", "msrp", "vin_pattern_market_avg", "vin_pattern_trims")


def matchable(catalog: DataFrame) -> DataFrame:
    """Distinct vehicles per pattern, with ``any_trim``: the listing's trim text need not agree.

    That holds with one trim in the pattern, or an msrp within 5 % of the
    pattern's mean. Vehicles that differ only in their own msrp become one row
    here, so the match with the listings yields no copies.
    """
    mean = F.col("vin_pattern_market_avg")
    near = (mean > 0) & (S.relative_difference(F.col("msrp"), mean) < 0.05)
    free = (F.col("vin_pattern_trims") == 1) | F.coalesce(near, F.lit(False))
    whole = catalog.dropna(subset=["vin_pattern", *VEHICLE])
    return whole.groupBy("vin_pattern", *VEHICLE, "body_type", mean.alias("msrp")).agg(F.max(free).alias("any_trim"))


def numbered(vehicles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of `matchable` with short columns for the vehicle and its body type, the vehicles behind these).

    A vehicle is ``_first``, the least of its patterns, and ``_no``, its place
    among the vehicles of that one; a body type is ``_body``, its place in the
    vehicle's ``_bodies``. Windows see the catalog rows of one vehicle, or of one
    first pattern, never listings.
    """
    same = Window.partitionBy(*VEHICLE)
    known = vehicles.withColumns({"_first": F.min("vin_pattern").over(same), "_bodies": F.array_sort(F.collect_set("body_type").over(same))})
    known = known.withColumn("_no", F.dense_rank().over(Window.partitionBy("_first").orderBy(*VEHICLE)))
    body = F.array_position("_bodies", F.col("body_type")).cast("int").alias("_body")
    names = known.select("_first", "_no", *VEHICLE, "_bodies").dropDuplicates(["_first", "_no"])
    return known.select("vin_pattern", "trim", "any_trim", "msrp", "_first", "_no", body), names


def training_set(listings: DataFrame, catalog: DataFrame, top: int | None = None) -> DataFrame:
    """Listings matched to catalog vehicles, with the vehicle's listing count and recency rank.

    ``listings`` has one row per VIN and ``catalog`` is the output of
    ``catalog_clean``, best a written table, whose size Spark knows; beyond what
    it broadcasts, patterns that hold much of the listings are spread over
    salts. Rows without pattern, date or a vehicle column are left out. ``top``
    keeps ranks up to it.

    A match goes to its vehicle once, under the vehicle's number, and gets the
    names there. If Spark would not broadcast the listings, a job looks for
    vehicles that hold much of the matches, which are ranked by counts.
    """
    rows = listings.select("vin", F.col("taxonomy_vin").alias("vin_pattern"), "trim_orig", F.col("miles").alias("mileage"), "price", "status_date")
    rows = rows.dropna(subset=["vin_pattern", "status_date"])
    vehicles, names = numbered(matchable(catalog))
    joined = spread_join(rows, vehicles, ["vin_pattern"], salts=SALTS, null_safe=False)
    matched = joined.where(F.col("any_trim") | S.contains_text(F.col("trim"), F.col("trim_orig")))
    key = ["_first", "_no"]
    matched = matched.select("vin", *key, "_body", "msrp", "mileage", "price", "status_date")
    heavy = [] if broadcastable(rows) else heavy_keys(matched, key)
    ranked, rest = sent_once_by_recency(matched, key, "status_date", "rank", "vehicles", top, heavy)

    def named(part: DataFrame) -> DataFrame:
        body = F.get("_bodies", F.col("_body") - 1).alias("body_type")
        return spread_join(part, names, key, null_safe=False).select("vin", *VEHICLE, body, "msrp", "mileage", "price", "rank", "vehicles")

    return named(ranked) if rest is None else named(ranked).unionByName(named(rest))


def training_listings(raw: DataFrame, reject_price_equal_miles: bool = True) -> DataFrame:
    """Typed rows of the price-model feed: units, miles and price in range, body type in catalog words.

    Some files lack the trim column; its rows have none.
    """
    clean = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"^\s+|\s+$", "")
    body = S.null_if_empty(clean("body_type_ss"))
    extra = [c for c in ("file", "position") if c in raw.columns]
    if "trim_orig_ss" not in raw.columns:
        raw = raw.withColumn("trim_orig_ss", F.lit(None).cast("string"))
    return raw.where(training_listing(reject_price_equal_miles)).select(
        F.col("vin_ss").alias("vin"),
        S.safe_double(F.col("miles_fs")).alias("miles"),
        S.safe_double(F.col("price_fs")).alias("price"),
        S.parse_instant(F.col("status_date_dts")).alias("status_date"),
        F.col("taxonomy_vin_ss").alias("taxonomy_vin"),
        normalize_body_type(body, clean("vehicle_type_ss")).alias("body_type"),
        S.null_if_empty(F.col("trim_orig_ss")).alias("trim_orig"),
        *extra,
    )


def merge_listing_file(current: DataFrame, batch: DataFrame, position: str = "position") -> DataFrame:
    """One current row per VIN: the batch's latest row (first seen wins a tie), stored only if strictly newer."""
    one = latest_first_seen(batch, ["vin"], "status_date", position)
    return upsert_newest(current, one.select(*current.columns), ["vin"], "status_date")


def merge_price_points(current: DataFrame, batch: DataFrame, moving: Sequence[str] = ("status_date", "file")) -> DataFrame:
    """One row per (vin, miles, price): the batch's earliest row; only the date and file move, incoming wins ties."""
    keys = ["vin", "miles", "price"]
    one = earliest_per_key(batch.select(*current.columns), keys, "status_date")
    return upsert_newest_partial(current, one, keys, "status_date", moving)
