"""Aggregations, set operations and the rollup pipelines built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.operators import aggregates as A
from forecourt.operators import incremental as I
from forecourt.plans import impressions, leads as L, reports as R
from forecourt.standins.payloads import _UUID_DUCK
from forecourt.session import materialize
from forecourt.standins.base import LEADS_SQL, LISTINGS_SQL, REPORTS_SQL, Tables, labelled, listings, query, reports, ts

# --- accident-report rollups ---------------------------------------------

_UNIT_SQL = {"lifetime": None, "weekly": "week", "monthly": "month", "quarterly": "quarter", "yearly": "year"}


def _rollup_sql(measure: str, unit: str | None, where: str = "", out: str = "vins") -> str:
    date = f", date_trunc('{unit}', created_at)::timestamp as date" if unit else ""
    group = "1, 2" if unit else "1"
    return f"select master_business_id{date}, {measure} as {out} from {REPORTS_SQL} r {where} group by {group}"


_MEASURES = {
    "reports_checked": ("count(*)", ""),
    "reports_clean": ("count(*)", "where accident_reported = 'no'"),
    "reports_reported": ("count(*)", "where accident_reported = 'yes'"),
    "reports_proportion": ("round(sum(case when accident_reported = 'yes' then 1 else 0 end) / count(*)::double, 9)", ""),
}


def _report_query(name: str, period: str):
    def run(t: Tables):
        out = R.ROLLUPS[name](reports(t), period)
        return out.withColumn("vins", F.round("vins", 9)) if name == "reports_proportion" else out

    measure, where = _MEASURES[name]
    query(f"{name}_{period}", _rollup_sql(measure, _UNIT_SQL[period], where))(run)


for _name in R.ROLLUPS:
    for _period in R.PERIODS:
        _report_query(_name, _period)


@query("count_by_key", f"select master_business_id, count(*) as n from {REPORTS_SQL} r group by 1")
def _(t):
    return A.count_by_period(reports(t), ["master_business_id"])


@query("count_by_period", f"select master_business_id, date_trunc('day', created_at)::timestamp as date, count(*) as n from {REPORTS_SQL} r group by 1, 2")
def _(t):
    return A.count_by_period(reports(t), ["master_business_id"], "created_at", "day")


@query(
    "count_where_by_period",
    "select l_suppkey, date_trunc('month', l_shipdate)::timestamp as date, count(*) as n from lineitem where l_returnflag = 'R' group by 1, 2",
)
def _(t):
    return A.count_by_period(t.lineitem, ["l_suppkey"], "l_shipdate", "month", "n", F.col("l_returnflag") == "R")


@query(
    "proportion_by_period",
    "select l_suppkey, date_trunc('quarter', l_shipdate)::timestamp as date, round(sum(case when l_returnflag = 'R' then 1 else 0 end) / count(*)::double, 9) as share from lineitem group by 1, 2",
)
def _(t):
    out = A.share_by_period(t.lineitem, ["l_suppkey"], F.col("l_returnflag") == "R", "l_shipdate", "quarter")
    return out.withColumn("share", F.round("share", 9))


@query(
    "distinct_by_period",
    "select l_suppkey, date_trunc('year', l_shipdate)::timestamp as date, count(distinct l_partkey) as n from lineitem group by 1, 2",
)
def _(t):
    return A.distinct_by_period(t.lineitem, ["l_suppkey"], "l_partkey", "l_shipdate", "year")


@query("first_last_seen", f"select dealer_id, domain, min(status_date) as first_seen, max(status_date) as last_seen from {LISTINGS_SQL} l group by 1, 2")
def _(t):
    return A.first_last_seen(listings(t), ["dealer_id", "domain"], "status_date")


@query("count_by_first_element", f"select master_business_id, first_label as master_lead_type, count(*) as leads from {LEADS_SQL} l group by 1, 2")
def _(t):
    return A.count_by_label(labelled(t), ["master_business_id"], "lead_content")


@query(
    "count_by_joined_array",
    f"select master_business_id, date_trunc('month', created_at)::timestamp as date, labels as mixed_lead_type, count(*) as leads from {LEADS_SQL} l group by 1, 2, 3",
)
def _(t):
    return A.count_by_label(labelled(t), ["master_business_id"], "lead_content", True, "created_at", "month")


_TAGS = {"returned": "R", "accepted": "A", "none": "N"}


@query(
    "pivot_conditional_sum",
    "select l_suppkey, "
    + ", ".join(
        f"cast(sum(case when l_returnflag = '{f}' then cast({v} as decimal(18,2)) else 0 end) as double) as {n}_{s}"
        for s, v in {"price": "l_extendedprice", "qty": "l_quantity"}.items()
        for n, f in _TAGS.items()
    )
    + " from lineitem group by 1",
)
def _(t):
    money = t.lineitem.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_quantity")})
    return A.conditional_sums(money, ["l_suppkey"], "l_returnflag", _TAGS, {"price": "l_extendedprice", "qty": "l_quantity"})


@query(
    "pivot_conditional_max",
    f"""select master_business_id,
      max(case when labels like '%credit%' or labels like '%finance%' then created_at end) as last_credit_lead,
      max(case when labels like '%trade%' then created_at end) as last_trade_lead,
      max(case when labels like '%testdrive%' then created_at end) as last_testdrive_lead,
      max(case when labels like '%insurance%' then created_at end) as last_insurance_lead,
      max(case when labels like '%payments%' then created_at end) as last_payments_lead
    from {LEADS_SQL} l group by 1""",
)
def _(t):
    from forecourt.operators.joins import last_seen_by_label

    return last_seen_by_label(labelled(t), "master_business_id", "lead_content", "created_at", L.LAST_SEEN)


@query(
    "two_level_weighted_sum",
    """with counts as (select l_suppkey, date_trunc('month', l_shipdate) as date, l_returnflag, count(*) as n from lineitem group by 1, 2, 3),
       rates as (select l_returnflag, round(avg(l_discount), 6) as rate from lineitem where l_returnflag <> 'N' group by 1)
       select l_suppkey, date::timestamp as date, round(sum(n * rate), 8) as total from counts left join rates using (l_returnflag) group by 1, 2""",
)
def _(t):
    counts = A.count_by_period(t.lineitem, ["l_suppkey", "l_returnflag"], "l_shipdate", "month")
    rates = t.lineitem.where("l_returnflag <> 'N'").groupBy("l_returnflag").agg(F.round(F.avg("l_discount"), 6).alias("rate"))
    out = A.weighted_sum(counts, rates, "l_returnflag", ["l_suppkey", "date"], "n", "rate", "total", False)
    return out.withColumn("total", F.round("total", 8))


@query("having_distinct", "select p_name from part group by 1 having count(distinct p_size) > 1")
def _(t):
    return A.keys_with_many(t.part, "p_name", "p_size")


@query(
    "group_mean_threshold",
    """with m as (select l_suppkey, l_returnflag, cast(trunc(avg(l_quantity * 1000) * 0.9::double) as integer) as mileage from lineitem group by 1, 2)
       select distinct l.l_suppkey, l.l_returnflag, l.l_partkey, m.mileage from lineitem l join m using (l_suppkey, l_returnflag)""",
)
def _(t):
    rows = t.lineitem.withColumn("miles", F.col("l_quantity") * 1000)
    return A.mean_threshold(rows, ["l_suppkey", "l_returnflag"], "miles", "l_partkey", 0.10)


_GROUPS_SQL = "(select p_brand, p_type, l_quantity * 1000 as mileage, l_extendedprice as price from lineitem join part on p_partkey = l_partkey)"


def _fit_rows(t):
    joined = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return joined.select("p_brand", "p_type", (F.col("l_quantity") * 1000).alias("mileage"), F.col("l_extendedprice").alias("price"))


@query(
    "group_linear_fit",
    f"""select p_brand, p_type, round(regr_slope(price, mileage), 6) as slope, round(regr_intercept(price, mileage), 2) as intercept,
      round(regr_r2(price, mileage), 6) as r2, regr_count(price, mileage)::bigint as size from {_GROUPS_SQL} g group by 1, 2""",
)
def _(t):
    fit = A.linear_fit(_fit_rows(t), ["p_brand", "p_type"], "mileage", "price")
    return fit.select("p_brand", "p_type", F.round("slope", 6).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), "size")


# Means of cents often end in an exact 5 at the last digit, where the order of a
# floating-point sum decides the rounding; this keeps them off that border.
_OFF = 0.0000123


@query(
    "group_fit_errors",
    f"""with g as {_GROUPS_SQL}, f as (select p_brand, p_type, regr_slope(price, mileage) as s, regr_intercept(price, mileage) as i from g group by 1, 2)
      select p_brand, p_type, round(avg(power(price - (i + s * mileage), 2)) / 1e6, 4) as mse_m, round(avg(abs(price - (i + s * mileage))), 3) as mean_absolute_error,
        round(avg(price) + {_OFF}, 3) as mean_observed, round(avg(i + s * mileage) + {_OFF}, 3) as mean_predicted, min(price) as minimum, max(price) as maximum
      from g join f using (p_brand, p_type) group by 1, 2""",
)
def _(t):
    keys = ["p_brand", "p_type"]
    rows = _fit_rows(t)
    e = A.fit_errors(rows, A.linear_fit(rows, keys, "mileage", "price"), keys, "mileage", "price")
    rounded = [F.round("mean_absolute_error", 3).alias("mean_absolute_error")]
    rounded += [F.round(F.col(c) + _OFF, 3).alias(c) for c in ("mean_observed", "mean_predicted")]
    return e.select(*keys, F.round(F.col("mean_squared_error") / 1e6, 4).alias("mse_m"), *rounded, "minimum", "maximum")


@query(
    "group_fit_sessions",
    f"""with g as {_GROUPS_SQL}, f as (select p_brand, p_type, regr_slope(price, mileage) as s, regr_intercept(price, mileage) as i, regr_r2(price, mileage) as r2 from g group by 1, 2)
      select p_brand, p_type, round(any_value(s), 6) as slope, round(any_value(i), 2) as intercept, round(any_value(r2), 6) as r2, count(*) as size, round(avg(power(price - (i + s * mileage), 2)) / 1e6, 4) as mse_m,
        round(avg(i + s * mileage) + {_OFF}, 3) as mean_predicted, min(price) as minimum, max(price) as maximum from g join f using (p_brand, p_type) group by 1, 2""",
)
def _(t):
    """Three sessions, each of which adds its own rows to the moments that the ones before it stored."""
    keys = ["p_brand", "p_type"]
    joined = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    rows = joined.select(*keys, (F.col("l_quantity") * 1000).alias("mileage"), F.col("l_extendedprice").alias("price"), "l_returnflag")
    stored = None
    for flag in ("A", "N", "R"):
        added = A.moments(rows.where(F.col("l_returnflag") == flag), keys, "mileage", "price")
        stored = materialize(added if stored is None else A.merge_moments(stored, added, keys), "moments")
    fit = A.fit_of_moments(stored, keys)
    rounded = {"slope": F.round("slope", 6), "intercept": F.round("intercept", 2), "r2": F.round("r2", 6), "mse_m": F.round(F.col("mean_squared_error") / 1e6, 4), "mean_predicted": F.round(F.col("mean_predicted") + _OFF, 3)}
    return fit.select(*keys, *[c.alias(n) for n, c in rounded.items()], "size", "minimum", "maximum")


@query("distinct_projection", "select distinct o_custkey from orders where o_orderstatus = 'P'")
def _(t):
    return t.orders.where("o_orderstatus = 'P'").select("o_custkey").distinct()


@query("group_as_dedup", "select l_suppkey, l_partkey, l_shipdate, l_quantity, count(*) over (partition by l_suppkey) as vehicles from (select l_suppkey, l_partkey, l_shipdate, l_quantity from lineitem group by 1, 2, 3, 4) x")
def _(t):
    from forecourt.operators.latest import count_over_group

    once = t.lineitem.select("l_suppkey", "l_partkey", "l_shipdate", "l_quantity").distinct()
    return count_over_group(once, ["l_suppkey"], "vehicles")


@query("global_min_max", "select min(l_shipdate) as min_value, max(l_shipdate) as max_value from lineitem")
def _(t):
    return A.min_max(t.lineitem, "l_shipdate")


# --- set operations -------------------------------------------------------

_FEED_TYPES = ("view", "click", "signup", "purchase")


def _event_feeds(t):
    k = F.get_json_object("props", "$.k")
    rows = t.events.select("event_type", F.col("user_id").alias("master_business_id"), F.col("ts").alias("happened_at"), k.alias("ip_address"))
    return [rows.where(F.col("event_type") == e).drop("event_type") for e in _FEED_TYPES]


@query(
    "union_distinct_feeds",
    "select distinct user_id as master_business_id, date_trunc('day', ts)::timestamp as day, json_extract_string(props, '$.k') as ip_address from events where event_type in ('view', 'click', 'signup', 'purchase')",
)
def _(t):
    feeds = [f.select("master_business_id", F.date_trunc("day", "happened_at").alias("day"), "ip_address") for f in _event_feeds(t)]
    return A.union_feeds(feeds)


@query(
    "union_tagged_scores",
    """select o_orderkey, 'total' as kind, o_totalprice as score from orders
       union select o_orderkey, 'tenth', o_totalprice * 0.1 from orders
       union select o_orderkey, 'double', o_totalprice * 2 from orders""",
)
def _(t):
    p = F.col("o_totalprice")
    rows = {"total": {"score": p}, "tenth": {"score": p * 0.1}, "double": {"score": p * 2}}
    return A.wide_to_long(t.orders, ["o_orderkey"], "kind", rows)


@query("reconcile_ids", "select o_orderkey, o_orderkey in (select l_orderkey from lineitem) as found from orders")
def _(t):
    return A.reconcile(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


# --- distinct visitors ----------------------------------------------------


def _visit_feeds(t: Tables, unit: str):
    """Days and weeks from events; months and quarters from line items, which span years."""
    if unit in ("day", "week"):
        return _event_feeds(t)
    rows = t.lineitem.select(
        "l_returnflag", "l_linestatus", F.col("l_suppkey").alias("master_business_id"), F.col("l_shipdate").alias("happened_at"), F.col("l_partkey").alias("ip_address")
    )
    pairs = [(a, b) for a in "ANR" for b in "FO"]
    return [rows.where((F.col("l_returnflag") == a) & (F.col("l_linestatus") == b)).drop("l_returnflag", "l_linestatus") for a, b in pairs]


def _visits_sql(unit: str) -> str:
    if unit in ("day", "week"):
        rows = """select event_type as feed, user_id as master_business_id, ts as happened_at, json_extract_string(props, '$.k') as ip_address
          from events where event_type in ('view', 'click', 'signup', 'purchase')"""
    else:
        rows = """select l_returnflag || l_linestatus as feed, l_suppkey as master_business_id, l_shipdate as happened_at, l_partkey as ip_address
          from lineitem"""
    return f"""with v as ({rows}), spans as (select feed, min(happened_at) as lo, max(happened_at) as hi from v group by 1),
      bounds as (select date_trunc('{unit}', min(lo)) as lo, date_trunc('{unit}', min(hi)) as hi from spans)
      select master_business_id, date_trunc('{unit}', happened_at)::timestamp as date, count(distinct ip_address) as impressions
      from v, bounds where happened_at >= bounds.lo and happened_at < bounds.hi group by 1, 2"""


def _impressions_query(name: str, unit: str):
    query(f"unique_impressions_{name}", _visits_sql(unit))(lambda t: impressions.unique_impressions(_visit_feeds(t, unit), unit))


for _name, _unit in {"daily": "day", "weekly": "week", "monthly": "month", "quarterly": "quarter"}.items():
    _impressions_query(_name, _unit)


_RESUMED = "timestamp '2024-01-10'"


@query(
    "unique_impressions_resumed",
    f"""with v as (select event_type as feed, {_UUID_DUCK.replace('c_custkey', 'user_id')} as master_business_id, date_trunc('second', ts) as happened_at, json_extract_string(props, '$.k') as ip_address
          from events where event_type in ('view', 'click', 'signup', 'purchase')),
      hi as (select date_trunc('day', min(hi)) as hi from (select max(happened_at) as hi from v group by feed) x)
      select master_business_id, date_trunc('day', happened_at)::timestamp as date, count(distinct ip_address) as impressions
      from v, hi where happened_at >= {_RESUMED} + interval 1 day and happened_at < hi.hi group by 1, 2""",
)
def _(t):
    """Visitors out of landed payloads, from the day after the last one done."""
    from forecourt.sources.files import scan_event_archive
    from forecourt.standins.files import event_archives

    # The archives are unpacked once; bounds and counts of four feeds come of the written rows.
    events = materialize(scan_event_archive(event_archives(t), _FEED_TYPES), "events")
    feeds = [impressions.visits(events.where(F.col("event_name") == e)) for e in _FEED_TYPES]
    done = t.events.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")).select(F.date_trunc("day", "ts").alias("date"))
    return impressions.unique_impressions(feeds, "day", done)


@query(
    "multi_feed_barrier",
    """with spans as (select event_type, min(ts) as lo, max(ts) as hi from events where event_type in ('view', 'click', 'signup', 'purchase') group by 1)
       select date_trunc('week', min(lo))::timestamp as lo, date_trunc('week', min(hi))::timestamp as hi from spans""",
)
def _(t):
    return I.multi_feed_barrier(_event_feeds(t), "happened_at", "week")


# --- lead rollups ---------------------------------------------------------

_LEAD_UNITS = {"lifetime": None, "daily": "day", "weekly": "week", "monthly": "month", "yearly": "year"}


def _lead_query(kind: str, period: str, device: bool):
    unit = _LEAD_UNITS[period]
    cols = ["master_business_id"]
    if unit:
        cols.append(f"date_trunc('{unit}', created_at)::timestamp as date")
    cols.append("first_label as master_lead_type" if kind == "master" else "labels as mixed_lead_type")
    if device:
        cols.append("device")
    group = ", ".join(str(i + 1) for i in range(len(cols)))
    sql = f"select {', '.join(cols)}, count(*) as leads from {LEADS_SQL} l group by {group}"
    fn = L.master_leads if kind == "master" else L.mixed_leads
    query(f"{kind}_leads_{period}{'_device' if device else ''}", sql)(lambda t: fn(labelled(t), period, device))


for _device in (False, True):
    for _period in ("lifetime", "daily", "weekly", "monthly", "yearly"):
        _lead_query("master", _period, _device)
    for _period in ("lifetime", "monthly", "yearly"):
        _lead_query("mixed", _period, _device)

_PROBABILITIES = {
    "vehicle_sale_profit": "round(avg(l_extendedprice), 2)",
    "high_quality_trade_in_probability": "round(avg(l_tax) * 10, 4)",
    **{f"{label}_lead_conversion_probability": f"round(avg(l_discount) * {i + 1} / 4, 4)" for i, label in enumerate(L.VALUED)},
    **{f"trade_with_{label}_lead_probability": f"round(avg(l_tax) * {i + 2}, 4)" for i, label in enumerate(L.VALUED[1:])},
}
# One parameter row per year of line items as versions; the history names each year's last ship date.
_PARAMETERS_SQL = f"(select year(l_shipdate)::integer as version, {', '.join(f'{e} as {n}' for n, e in _PROBABILITIES.items())} from lineitem group by 1)"
_CURRENT_SQL = f"(select * from {_PARAMETERS_SQL} p where version = (select year(max(l_shipdate)) from lineitem))"


def _value_sql(label: str) -> str:
    p = f"{label}_lead_conversion_probability"
    upsell = f"{p} * high_quality_trade_in_probability" + ("" if label == "trade" else f" * trade_with_{label}_lead_probability")
    return f"select version, '{label}' as master_lead_type, vehicle_sale_profit * ({p} + {upsell}) as value, {p} as conversion_rate from {_CURRENT_SQL} c"


_VALUES_SQL = "(" + " union ".join(_value_sql(x) for x in L.VALUED) + ")"


def _parameters(t):
    named = [F.expr(e).alias(n) for n, e in _PROBABILITIES.items()]
    return t.lineitem.groupBy(F.year("l_shipdate").alias("version")).agg(*named)


def _history(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("version")).agg(F.max("l_shipdate").alias("date"))


def _values(t):
    return L.lead_type_value(_parameters(t), _history(t))


@query("lead_type_value", f"select version, master_lead_type, round(value, 6) as value, conversion_rate from {_VALUES_SQL} v")
def _(t):
    return _values(t).withColumn("value", F.round("value", 6))


def _estimate_query(name: str, fn, unit: str | None, measure: str, out: str):
    date = f", date_trunc('{unit}', created_at)::timestamp as date" if unit else ""
    keys = "master_business_id, date" if unit else "master_business_id"
    sql = f"""with counts as (select master_business_id{date}, first_label as master_lead_type, count(*) as leads from {LEADS_SQL} l
        group by master_business_id, first_label{f", date_trunc('{unit}', created_at)" if unit else ""})
      select {keys}, round({measure}, 4) as {out} from counts c left join {_VALUES_SQL} v using (master_lead_type) group by {keys}"""
    query(name, sql)(lambda t: fn(labelled(t), _values(t), unit).withColumn(out, F.round(out, 4)))


for _name, _unit in {"quarterly": "quarter", "yearly": "year", "lifetime": None}.items():
    _estimate_query(f"estimated_revenue_{_name}", L.estimated_revenue, _unit, "sum(leads * coalesce(value, 0))", "estimated_revenue")
for _name, _unit in {"monthly": "month", "lifetime": None}.items():
    _estimate_query(f"estimated_vehicles_sold_{_name}", L.estimated_vehicles_sold, _unit, "sum(leads * conversion_rate)", "estimated_vehicles_sold")
