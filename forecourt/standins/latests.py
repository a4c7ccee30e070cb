"""Latest-per-key, ranks, filters, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import scalars as S
from forecourt.operators import filters as X
from forecourt.operators import latest as W
from forecourt.operators.incremental import since_newest
from forecourt.standins.base import LISTINGS_SQL, listings, query
from forecourt.standins.merges import JOBS_SQL, jobs

_ROW = "l_partkey, l_shipdate, l_suppkey, l_extendedprice, l_quantity"


def _rows(t):
    return t.lineitem.select(*_ROW.split(", "))


def _first(order: str, keys: str = "l_partkey") -> str:
    return f"select {_ROW} from (select {_ROW}, row_number() over (partition by {keys} order by {order}) as rn from lineitem) x where rn = 1"


_TIES = ("l_suppkey", "l_extendedprice", "l_quantity")


@query("latest_per_key", _first("l_shipdate desc, l_suppkey desc, l_extendedprice desc, l_quantity desc"))
def _(t):
    return W.latest_per_key(_rows(t), ["l_partkey"], "l_shipdate", [F.col(c) for c in _TIES])


@query("dedupe_batch_earliest", _first("l_shipdate, l_suppkey, l_extendedprice, l_quantity"))
def _(t):
    return W.earliest_per_key(_rows(t), ["l_partkey"], "l_shipdate", [F.col(c) for c in _TIES])


@query(
    "dedupe_batch_latest",
    "select user_id, event_id, day from (select user_id, event_id, date_trunc('day', ts)::timestamp as day, row_number() over (partition by user_id order by date_trunc('day', ts) desc, event_id) as rn from events) x where rn = 1",
)
def _(t):
    rows = t.events.select("user_id", "event_id", F.date_trunc("day", "ts").alias("day"))
    return W.latest_first_seen(rows, ["user_id"], "day", "event_id")


@query("rank_longest_match", "select c_nationkey, c_custkey, c_mktsegment from (select *, rank() over (partition by c_nationkey order by length(c_mktsegment) desc) as r from customer) x where r = 1")
def _(t):
    return W.rank_longest(t.customer, "c_nationkey", "c_mktsegment").select("c_nationkey", "c_custkey", "c_mktsegment")


@query("count_over_group", f"select {_ROW}, count(*) over (partition by l_suppkey) as vehicles from lineitem")
def _(t):
    return W.count_over_group(_rows(t), ["l_suppkey"], "vehicles")


@query("avg_over_group", "select p_partkey, round(avg(p_retailprice) over (partition by p_brand, p_type), 8) as mean from part")
def _(t):
    return W.avg_over_group(t.part, ["p_brand", "p_type"], "p_retailprice", "mean").select("p_partkey", F.round("mean", 8).alias("mean"))


@query("rank_recency_topn", f"select * from (select {_ROW}, rank() over (partition by l_suppkey order by l_shipdate desc)::integer as rank from lineitem) x where rank <= 100")
def _(t):
    return W.top_recent(_rows(t), ["l_suppkey"], "l_shipdate", 100)


@query("recency_flag", "select event_id, user_id, case when rank() over (partition by user_id order by ts desc) > 15 then 1 else 0 end as is_old from events")
def _(t):
    return W.flag_old(t.events, ["user_id"], "ts", 15).select("event_id", "user_id", "is_old")


# --- filters --------------------------------------------------------------

# Line items as raw listing rows: every column text, with gaps and bad values.
_VIN = "lpad(cast(l_partkey as string), 8, 'V') || 'X' || lpad(cast(l_suppkey as string), 8, 'W')"
_RAW = {
    "id": "cast(l_orderkey as string)",
    "dealer_id_is": "case when l_linenumber = 7 then 'n/a' else cast(l_suppkey as string) end",
    "vin_ss": f"case when l_tax = 0 then 'SHORT' when l_tax = 0.01 then '' else {_VIN} end",
    "taxonomy_vin_ss": f"case when l_tax = 0.02 then 'OTHER' else substring({_VIN}, 1, 8) || substring({_VIN}, 10, 2) end",
    "price_fs": "case when l_discount = 0 then 'call' when l_discount = 0.01 then cast(l_quantity * 10000 as string) else cast(l_extendedprice as string) end",
    "miles_fs": "case when l_discount = 0.02 then '' else cast(l_quantity * 10000 as string) end",
    "miles_indicator_ss": "case when l_returnflag = 'N' then 'MILES' else 'KILOMETERS' end",
    "currency_indicator_ss": "case when l_linestatus = 'O' and l_returnflag = 'R' then 'USD' else 'CAD' end",
    "scraped_at_dts": "case when l_linenumber = 6 then '' else date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") end",
    "status_date_dts": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "zip_is": "concat('M5V ', l_suppkey)",
    "latitude_fs": "cast(l_quantity as string)",
    "longitude_fs": "'x'",
    "city_ss": "''",
    "state_ss": "l_linestatus",
    "source_ss": "concat('WWW.dealer', l_suppkey, '.example.com')",
    "body_type_ss": "l_returnflag",
    "vehicle_type_ss": "'Truck'",
    "trim_orig_ss": "l_linestatus",
}


def raw_listings(t):
    return t.lineitem.selectExpr(*[f"{e} as {n}" for n, e in _RAW.items()])


_IDENTITY_SQL = "l_linenumber not in (6, 7) and l_tax not in (0, 0.01, 0.02)"
_PARSED_SQL = "l_discount not in (0, 0.02)"
_UNITS_SQL = "l_returnflag <> 'N' and not (l_linestatus = 'O' and l_returnflag = 'R')"
_PRICE_SQL = "case when l_discount = 0.01 then l_quantity * 10000 else l_extendedprice end"
FILTER_SQL = {
    "ca_new": _IDENTITY_SQL,
    "ca_used": f"{_IDENTITY_SQL} and {_UNITS_SQL} and {_PARSED_SQL}",
    "us_used": f"{_IDENTITY_SQL} and {_PARSED_SQL} and {_PRICE_SQL} <> l_quantity * 10000",
    "training": f"{_UNITS_SQL} and {_PARSED_SQL} and l_quantity * 10000 between 1000 and 250000 and {_PRICE_SQL} >= 500 and {_PRICE_SQL} <> l_quantity * 10000",
}


def _filter_query(name, profile, predicate):
    sql = f"select l_orderkey as id, l_suppkey as dealer_id, count(*) as n from lineitem where {FILTER_SQL[profile]} group by 1, 2"

    def run(t):
        rows = raw_listings(t).withColumn("_dealer", F.regexp_extract("source_ss", r"dealer(\d+)", 1))
        kept = rows.where(predicate())
        return kept.groupBy(F.col("id").cast("bigint").alias("id"), F.col("_dealer").cast("bigint").alias("dealer_id")).agg(F.count("*").alias("n"))

    query(name, sql)(run)


_filter_query("filter_listing_ca_new", "ca_new", X.listing_ca_new)
_filter_query("filter_listing_ca_used", "ca_used", X.listing_ca_used)
_filter_query("filter_listing_us_used", "us_used", X.listing_us_used)
_filter_query("filter_training_listing", "training", X.training_listing)


@query("filter_event_name", "select event_id from events where event_type = 'purchase'")
def _(t):
    return t.events.where(X.event_named("purchase", "event_type")).select("event_id")


@query(
    "filter_exclude_ids",
    "select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0) and (o_orderstatus = 'P' or o_orderstatus is null)",
)
def _(t):
    ids = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return X.exclude_ids(t.orders.where(X.null_or_equal("o_orderstatus", "P")), "o_custkey", ids).select("o_orderkey")


@query("filter_recent", "select o_orderkey, o_orderdate from orders where o_orderdate >= (select max(o_orderdate) from orders) - interval 30 days")
def _(t):
    return since_newest(t.orders, "o_orderdate", 30).select("o_orderkey", "o_orderdate")


@query("filter_catalog", "select p_partkey from part where p_name not like '%(ends %' and p_name not like '%old %' and p_size + 1980 >= 2020 - 20")
def _(t):
    rows = t.part.withColumns({"style": F.replace("p_name", F.lit("old "), F.lit("(ends ")), "year": F.col("p_size") + 1980})
    return rows.where(X.catalog_current("style", "year", F.lit(2020))).select("p_partkey")


@query("filter_like", "select p_partkey from part where p_name like '%widget%'")
def _(t):
    return t.part.where(X.subscribed("p_name", "widget")).select("p_partkey")


@query("filter_posted_billing", "select l_orderkey, l_linenumber, l_partkey, count(*) as n from lineitem where l_tax <> 0 and l_linestatus = 'O' and not (l_returnflag = 'R') group by 1, 2, 3")
def _(t):
    status = F.when(F.col("l_linestatus") == "O", "Posted").otherwise("Draft")
    rows = t.lineitem.withColumns({"status": status, "reversed": F.col("l_returnflag") == "R"})
    return rows.where(X.posted_billing("l_tax", "status", "reversed")).groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.count("*").alias("n"))


_NOW_SQL = "timestamp '2001-06-30 12:00:00'"
_MONITOR_SQL = f"""(status <> 'success' or last_update < last_run - to_days(days)
   or (last_run < {_NOW_SQL} - interval 6 hours and schema <> 'BUILDING' and script <> 'Customer#000000001'))"""


@query("filter_unhealthy_jobs", f"select schema, script, last_run, status from {JOBS_SQL} j where {_MONITOR_SQL}")
def _(t):
    now = F.lit("2001-06-30 12:00:00").cast("timestamp")
    return jobs(t).where(X.unhealthy_jobs(now, "BUILDING", "Customer#000000001")).select("schema", "script", "last_run", "status")


_SEEN = {"f": "F", "o": "O", "p": "P"}


@query(
    "filter_single_type",
    """select o_custkey, max(o_orderdate) as f from orders group by 1
       having count(distinct o_orderstatus) = 1 and max(o_orderstatus) = 'F'""",
)
def _(t):
    last = [F.max(F.when(F.col("o_orderstatus") == v, F.col("o_orderdate"))).alias(k) for k, v in _SEEN.items()]
    return t.orders.groupBy("o_custkey").agg(*last).where(X.only_type(list(_SEEN), "f")).select("o_custkey", "f")


@query(
    "filter_consistent_catalog",
    """select p_partkey from part join (select p_brand, p_size, count(distinct p_type) as bodies from part group by 1, 2) b using (p_brand, p_size)
       where bodies = 1 or contains(upper(p_name), substr(p_type, 1, 3)) or (contains(upper(p_name), 'MINI-VAN') and p_type = 'WAGON')""",
)
def _(t):
    from forecourt.operators.joins import distinct_per_group

    rows = distinct_per_group(t.part, ["p_brand", "p_size"], "p_type", "bodies")
    rows = rows.withColumns({"style": F.upper("p_name"), "body_type": F.substring("p_type", 1, 3)})
    return rows.where(X.consistent_catalog()).select("p_partkey")


# --- sorts ----------------------------------------------------------------


@query("order_by_ts", "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("latest_one", "select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey desc limit 1")
def _(t):
    return t.orders.agg(F.max_by(F.struct("o_orderkey", "o_orderdate"), F.struct("o_orderdate", "o_orderkey")).alias("r")).select("r.*")


@query("order_by_size_desc", "select l_suppkey, count(*) as n from lineitem group by 1 order by n desc, l_suppkey")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "l_suppkey")
