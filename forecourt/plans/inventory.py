"""Dealer inventory: dealers seen, business-to-dealer match, current and new listings, low mileage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.aggregates import first_last_seen, mean_threshold
from forecourt.operators.filters import recent
from forecourt.operators.incremental import since_newest
from forecourt.operators.joins import SALTS, drop_ambiguous, not_seen_before, substring_join
from forecourt.operators.latest import latest_per_key
from forecourt.operators.spread import spread_join
from forecourt.session import materialize

# Spans in days, and the low-mileage bounds.
INVENTORY_DAYS, NEW_LISTING_DAYS = 7, 14
LOW_MILEAGE = {"min_miles": 500, "max_miles": 300000, "min_vehicles": 50, "cut": 0.10}
LOW_MILEAGE_DAYS = {"ca": 30, "us": 10}


def dealers(listings: DataFrame) -> DataFrame:
    return first_last_seen(listings, ["dealer_id", "domain"], "status_date")


def client_dealer(businesses: DataFrame, dealer_domains: DataFrame) -> DataFrame:
    """(master_business_id, dealer_id, last_seen): the longest dealer domain inside the business's website.

    Domains of equal length are all kept; one dealer stands for a domain, the
    last seen, then the lowest id. The domains' owners are written once.
    """
    owners = latest_per_key(dealer_domains.select("domain", "dealer_id", "last_seen"), ["domain"], "last_seen", [-F.col("dealer_id")])
    owners = materialize(owners, "owners")
    sites = businesses.select(F.col("id").alias("master_business_id"), "website_url")
    hits = substring_join(sites, "website_url", owners, "domain")
    # A website holds few domains, at most its length squared, so a window over them fits a task.
    longest = F.max(F.length("domain")).over(Window.partitionBy("master_business_id"))
    best = hits.withColumn("_longest", longest).where(F.length("domain") == F.col("_longest"))
    return best.select("master_business_id", "dealer_id", "last_seen")


def client_inventory(clients: DataFrame, listings: DataFrame, now: Column, days: int = INVENTORY_DAYS) -> DataFrame:
    """Latest listing per business, dealer and VIN of the last days.

    A dealer's listings are reduced to one per VIN before they meet the
    dealer's businesses. Of equal times the higher price, then miles, stays.
    """
    rows = listings.where(recent("status_date", days, now)).select("dealer_id", "vin", "status_date", "price", "miles")
    current = latest_per_key(rows, ["dealer_id", "vin"], "status_date", [F.col("price"), F.col("miles")])
    pairs = clients.select("master_business_id", "dealer_id").distinct()
    joined = spread_join(current, pairs, ["dealer_id"], salts=SALTS, null_safe=False)
    return joined.select("master_business_id", "dealer_id", "vin", "status_date", "price", "miles")


def client_new_listings(inventory: DataFrame, listings: DataFrame, days: int = NEW_LISTING_DAYS) -> DataFrame:
    """Inventory rows the dealer did not list more than ``days`` earlier."""
    fresh = not_seen_before(inventory, listings, ["dealer_id", "vin"], "status_date", days)
    return fresh.select("master_business_id", "vin", "status_date")


def low_mileage(
    listings: DataFrame,
    catalog: DataFrame,
    days: int,
    regions: Sequence[str] = ("",),
    min_miles: int = LOW_MILEAGE["min_miles"],
    max_miles: int = LOW_MILEAGE["max_miles"],
    min_vehicles: int = LOW_MILEAGE["min_vehicles"],
    cut: float = LOW_MILEAGE["cut"],
    session_id: Column | None = None,
) -> DataFrame:
    """(vin_pattern, region, mileage): miles below which a vehicle counts as low; ``session_id`` names the run in every row.

    A group (year, make) counts every listing row times every catalog row of
    its pattern, repeated scrapes included; the mean then uses the latest row
    per (pattern, VIN). The counts come from per-pattern totals, so the
    repeated rows are never joined out.
    """
    window = since_newest(listings, "status_date", days)
    rows = window.where((F.col("miles") >= min_miles) & (F.col("miles") < max_miles))
    rows = rows.select(F.col("taxonomy_vin").alias("vin_pattern"), "vin", "miles", "status_date")
    kinds = drop_ambiguous(catalog.where(F.col("vin_pattern").isNotNull()), catalog, "vin_pattern", "year")
    kinds = kinds.groupBy("vin_pattern", "year", "make").agg(F.count("*").alias("_variants"))
    scrapes = rows.groupBy("vin_pattern").agg(F.count("*").alias("_scrapes"))
    sizes = kinds.join(scrapes, "vin_pattern").groupBy("year", "make").agg(F.sum(F.col("_variants") * F.col("_scrapes")).alias("vehicles"))
    # A pattern sold under several makes counts for the first of them.
    one = kinds.groupBy("vin_pattern").agg(F.min(F.struct("year", "make")).alias("_g")).select("vin_pattern", "_g.*")
    one = spread_join(one, sizes.where(F.col("vehicles") >= min_vehicles), ["year", "make"])
    last = latest_per_key(rows, ["vin_pattern", "vin"], "status_date", [F.col("miles")])
    grouped = spread_join(last, one, ["vin_pattern"], salts=SALTS, null_safe=False).select("vin_pattern", "vin", "miles", "year", "make")
    limits = mean_threshold(grouped, ["year", "make"], "miles", "vin_pattern", cut)
    limits = limits.select("vin_pattern", F.explode(F.array(*[F.lit(r) for r in regions])).alias("region"), "mileage")
    return limits if session_id is None else limits.withColumn("session_id", session_id)
