"""Leads: labelled detail views, the incremental lead table, rollups, revenue estimates."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.labels import lead_labels
from forecourt.functions.payload import as_uuid, json_uuid, parse_payload
from forecourt.functions.periods import period_start
from forecourt.functions.scalars import array_first, array_joined, json_field
from forecourt.operators.aggregates import count_by_label, weighted_sum, wide_to_long
from forecourt.operators.filters import exclude_ids, null_or_equal, only_type, subscribed
from forecourt.operators.incremental import lookback_to_day
from forecourt.operators.joins import at_latest_version, last_seen_by_label, left_lookup
from forecourt.operators.latest import latest_per_key
from forecourt.operators.merge import upsert_replace

# Leads of these sub types are counted.
GENERIC = "generic"
# The flag columns of a lead, in the order the label rule takes them.
FLAGS = (
    "is_insurance", "is_trade", "is_credit_partial", "is_credit_verified", "is_credit_finance", "is_ecom", "is_test_drive",
)
DASHBOARD_COLUMNS = ("id", "master_business_id", "integration_settings_id", "created_at", "device", "lead_content")


def labels_of(read: Callable[[str], Column], spotlight: bool) -> Column:
    """Label array from the flag columns that ``read`` returns by name."""
    return lead_labels(*[read(f) for f in FLAGS], read("is_spotlight") if spotlight else None)


def settings_view(settings: DataFrame) -> DataFrame:
    """(id, master_business_id, status) of integration settings."""
    payload = F.col("payload")
    return settings.select("id", json_uuid(payload, "master_business_id").alias("master_business_id"), json_field(payload, "status").alias("status"))


def active_businesses(settings: DataFrame) -> DataFrame:
    return settings_view(settings).where(F.col("status") == "active").select("master_business_id").distinct()


def lead_content_view(leads: DataFrame, settings: DataFrame) -> DataFrame:
    """Labels straight from the landing rows, without the typed view."""
    keys = ["integration_settings_id", "device", *FLAGS]
    parsed = leads.select("id", "created_at", parse_payload(F.col("payload"), keys).alias("_p"))
    flat = parsed.select(
        "id",
        as_uuid(F.col("_p.integration_settings_id")).alias("_settings"),
        "created_at",
        F.col("_p.device").alias("device"),
        labels_of(lambda f: F.col(f"_p.{f}").try_cast("int"), False).alias("lead_content"),
    )
    joined = left_lookup(flat, settings_view(settings).drop("status"), "_settings", "id")
    return joined.select("id", "master_business_id", "created_at", "device", "lead_content")


def lead_details(leads: DataFrame, settings: DataFrame) -> DataFrame:
    """Typed leads with their business and the labels that know the spotlight product."""
    joined = left_lookup(leads, settings.select("id", "master_business_id"), "integration_settings_id", "id")
    return joined.withColumn("lead_content", labels_of(F.col, True))


def lead_details_materialized(leads: DataFrame, settings: DataFrame, businesses: DataFrame) -> DataFrame:
    """Typed leads whose business is known, labelled without the spotlight product."""
    link = settings.select("id", F.col("master_business_id").alias("_bid"))
    known = businesses.select("id", F.col("id").alias("master_business_id"))
    joined = left_lookup(leads, link, "integration_settings_id", "id")
    joined = left_lookup(joined, known, "_bid", "id")
    return joined.drop("_bid").withColumn("lead_content", labels_of(F.col, False))


def fresh_lead_content(details: DataFrame, stored: DataFrame, leads: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows to upsert: re-read span up to the last complete day, minus excluded ids and special sub types."""
    rows = lookback_to_day(details, stored, "created_at", newest_of=leads)
    rows = exclude_ids(rows.where(null_or_equal("sub_type", GENERIC)), "id", excluded)
    return rows.select(*DASHBOARD_COLUMNS)


def dashboard_lead_content(details: DataFrame, stored: DataFrame, leads: DataFrame, excluded: DataFrame) -> DataFrame:
    return upsert_replace(stored, fresh_lead_content(details, stored, leads, excluded), ["id"])


_BUSINESS = ["master_business_id"]
_UNITS = {"lifetime": None, "daily": "day", "weekly": "week", "monthly": "month", "quarterly": "quarter", "yearly": "year"}


def master_leads(content: DataFrame, period: str, device: bool = False) -> DataFrame:
    """Leads by their first label."""
    keys = _BUSINESS + (["device"] if device else [])
    return count_by_label(content, keys, "lead_content", False, "created_at", _UNITS[period])


def mixed_leads(content: DataFrame, period: str, device: bool = False) -> DataFrame:
    """Leads by their label combination."""
    keys = _BUSINESS + (["device"] if device else [])
    return count_by_label(content, keys, "lead_content", True, "created_at", _UNITS[period])


# Labels with a value, in order; only trade has no "trade with ..." probability.
VALUED = ("trade", "credit", "insurance", "finance", "payments", "testdrive", "spotlight")


def lead_type_value(parameters: DataFrame, history: DataFrame) -> DataFrame:
    """(version, master_lead_type, value, conversion_rate) of the current parameter version."""
    current = at_latest_version(parameters, history, "version", "date")
    rows = {}
    for label in VALUED:
        p = F.col(f"{label}_lead_conversion_probability")
        upsell = p * F.col("high_quality_trade_in_probability")
        if label != "trade":
            upsell = upsell * F.col(f"trade_with_{label}_lead_probability")
        rows[label] = {"value": F.col("vehicle_sale_profit") * (p + upsell), "conversion_rate": p}
    return wide_to_long(current, ["version"], "master_lead_type", rows)


def _estimate(content: DataFrame, values: DataFrame, unit: str | None, weight: str, out: str, missing_is_zero: bool) -> DataFrame:
    counts = count_by_label(content, _BUSINESS, "lead_content", False, "created_at", unit)
    keys = _BUSINESS + (["date"] if unit else [])
    return weighted_sum(counts, values, "master_lead_type", keys, "leads", weight, out, missing_is_zero)


def estimated_revenue(content: DataFrame, values: DataFrame, unit: str | None) -> DataFrame:
    """Leads x value; a label without a value counts 0."""
    return _estimate(content, values, unit, "value", "estimated_revenue", True)


def estimated_vehicles_sold(content: DataFrame, values: DataFrame, unit: str | None) -> DataFrame:
    """Leads x conversion rate; a label without a rate is ignored."""
    return _estimate(content, values, unit, "conversion_rate", "estimated_vehicles_sold", False)


# Last-seen columns and the labels each one covers.
LAST_SEEN = {
    "last_credit_lead": ("credit", "finance"),
    "last_trade_lead": ("trade",),
    "last_testdrive_lead": ("testdrive",),
    "last_insurance_lead": ("insurance",),
    "last_payments_lead": ("payments",),
}


def single_type_businesses(businesses: DataFrame, content: DataFrame, active: DataFrame, product: str, wanted: str) -> DataFrame:
    """Active subscribers of ``product`` whose leads are all of the ``wanted`` kind."""
    mine = content.join(active, ["master_business_id"], "left_semi")
    newest = latest_per_key(mine.select("master_business_id", "lead_content", "created_at"), ["master_business_id", "lead_content"], "created_at")
    seen = last_seen_by_label(newest, "master_business_id", "lead_content", "created_at", LAST_SEEN)
    base = businesses.withColumnRenamed("id", "master_business_id").where(subscribed("subscriptions", product))
    base = base.join(active, ["master_business_id"], "left_semi")
    rows = base.join(seen, ["master_business_id"]).where(only_type(list(LAST_SEEN), wanted))
    return rows.select("name", "website_url", "master_business_id", "crm_id", "subscriptions", wanted)


trade_leads_only = partial(single_type_businesses, wanted="last_trade_lead")
credit_leads_only = partial(single_type_businesses, wanted="last_credit_lead")


# The derived tables of the lead dashboard, by what they count and their period.
COUNTED = {"master": ("lifetime", "daily", "weekly", "monthly", "yearly"), "mixed": ("lifetime", "monthly", "yearly")}
ESTIMATED = {"estimated_revenue": ("quarterly", "yearly", "lifetime"), "estimated_vehicles_sold": ("monthly", "lifetime")}


def dashboard_columns() -> dict[str, list[str]]:
    """The derived tables of the lead dashboard by name, each with its columns in `dashboard_rollup`."""
    views = {}
    for kind, periods in COUNTED.items():
        for period in periods:
            for device in ([], ["device"]):
                name = f"{kind}_leads_{period}" + ("_device" if device else "")
                views[name] = [*_BUSINESS, *device, *_date(period), f"{kind}_lead_type", "leads"]
    for measure, periods in ESTIMATED.items():
        for period in periods:
            views[f"{measure}_{period}"] = [*_BUSINESS, *_date(period), measure]
    return views


def _date(period: str) -> list[str]:
    return ["date"] if _UNITS[period] else []


def dashboard_rollup(content: DataFrame, values: DataFrame) -> DataFrame:
    """Every derived table of the lead dashboard in one: its rows have its name as ``view`` and NULL in others' columns.

    Leads are counted once, per day, device and both forms of their labels; a
    count then goes to the group it has in each table, and all groups are summed
    in one aggregate. Every period is made of whole days. Counts of a business
    meet in one task first, so that its groups are whole before they are sent,
    once, to the tasks that write their table; they are as many as its days,
    devices and labels, however many leads it has.
    """
    first, mixed = array_first(F.col("lead_content")), array_joined(F.col("lead_content"))
    day = period_start(F.col("created_at"), "day").alias("_day")
    days = content.groupBy(*_BUSINESS, "device", day, first.alias("master_lead_type"), mixed.alias("mixed_lead_type")).agg(F.count("*").alias("_n"))
    # One row per label of the label rule: a handful, and the few labels hold all leads.
    days = days.join(F.broadcast(values.select("master_lead_type", "value", "conversion_rate")), ["master_lead_type"], "left")
    # A number, as each count becomes one per table below: adaptive execution would size tasks by what comes in.
    days = days.repartition(int(days.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_BUSINESS)
    measures = {
        "leads": F.col("_n"),
        "estimated_revenue": F.col("_n") * F.coalesce("value", F.lit(0)),
        "estimated_vehicles_sold": F.col("_n") * F.col("conversion_rate"),
    }
    views = dashboard_columns()
    period = {v: _UNITS[v.removesuffix("_device").rsplit("_", 1)[-1]] for v in views}
    number, numbers = F.col("_view"), {v: k for k, v in enumerate(views)}
    among = lambda names: number.isin([numbers[v] for v in names])
    day, at = F.col("_day"), F.lit(None).cast(days.schema["_day"].dataType)
    for unit in sorted(set(filter(None, period.values()))):
        at = F.when(among(v for v in views if period[v] == unit), day if unit == "day" else period_start(day, unit)).otherwise(at)
    have = lambda c, value: F.when(among(v for v in views if c in views[v]), value).alias(c)
    keys = ["device", "master_lead_type", "mixed_lead_type"]
    each = days.withColumn("_view", F.explode(F.lit(list(numbers.values()))))
    groups = each.select("_view", *_BUSINESS, at.alias("date"), *[have(c, F.col(c)) for c in keys], *[have(c, v) for c, v in measures.items()])
    summed = groups.groupBy("_view", *_BUSINESS, "date", *keys).agg(*[F.sum(m).alias(m) for m in measures]).hint("rebalance", "_view")
    name = F.get(F.lit(list(views)), F.col("_view")).alias("view")
    return summed.select(name, *_BUSINESS, "date", *keys, *measures)
