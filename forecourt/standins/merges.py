"""Change application, incremental windows and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import periods as P
from forecourt.functions import scalars as S
from forecourt.operators import incremental as I
from forecourt.operators import merge as M
from forecourt.standins.base import Tables, query, ts

# Orders as a keyed table: the stored part holds the orders before 1999 as they
# were, the batch holds those since 1998 with a raised price.
_KEYS = ["o_orderkey"]


def _stored(t: Tables):
    return t.orders.where("o_orderdate < timestamp_ntz'1999-01-01'").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")


def _batch(t: Tables):
    rows = t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'")
    return rows.select("o_orderkey", "o_orderdate", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderstatus")


_STORED_SQL = "(select o_orderkey, o_orderdate, o_totalprice, o_orderstatus from orders where o_orderdate < timestamp '1999-01-01')"
_BATCH_SQL = "(select o_orderkey, o_orderdate, o_totalprice + 1 as o_totalprice, o_orderstatus from orders where o_orderdate >= timestamp '1998-01-01')"


@query("upsert_replace", f"select * from {_STORED_SQL} s where o_orderkey not in (select o_orderkey from {_BATCH_SQL} b) union all select * from {_BATCH_SQL} b")
def _(t):
    return M.upsert_replace(_stored(t), _batch(t), _KEYS)


@query("insert_if_absent", f"select * from {_STORED_SQL} s union all select * from {_BATCH_SQL} b where o_orderkey not in (select o_orderkey from {_STORED_SQL} s)")
def _(t):
    return M.insert_if_absent(_stored(t), _batch(t), _KEYS, "o_orderdate")


# Line items as scrapes of a vehicle: the batch is what shipped since 1999.
_SCRAPE = "l_partkey as vin, l_shipdate as status_date, l_extendedprice as price, l_quantity as miles"


def _scrapes(t, where):
    rows = t.lineitem.where(where).selectExpr(*_SCRAPE.split(", "))
    return M.dedupe_newest(rows, ["vin"], "status_date", [F.col("price"), F.col("miles")])


_OLD, _NEW = "l_returnflag <> 'A'", "l_returnflag = 'A'"


def _scrapes_sql(where):
    return f"(select * from (select {_SCRAPE}, row_number() over (partition by l_partkey order by l_shipdate desc, l_extendedprice desc, l_quantity desc) as rn from lineitem where {where}) x where rn = 1)"


@query(
    "upsert_newest",
    f"""with o as {_scrapes_sql(_OLD)}, n as {_scrapes_sql(_NEW)}
      select coalesce(o.vin, n.vin) as vin,
        case when o.vin is null or o.status_date < n.status_date then n.status_date else o.status_date end as status_date,
        case when o.vin is null or o.status_date < n.status_date then n.price else o.price end as price,
        case when o.vin is null or o.status_date < n.status_date then n.miles else o.miles end as miles
      from o full join n on o.vin = n.vin""",
)
def _(t):
    return M.upsert_newest(_scrapes(t, _OLD), _scrapes(t, _NEW), ["vin"], "status_date")


def _points(t, where):
    rows = t.lineitem.where(where).selectExpr("l_partkey as vin", "l_quantity as miles", "l_shipdate as status_date", "l_orderkey as file_id", "l_tax as note")
    return M.dedupe_newest(rows, ["vin", "miles"], "status_date", [F.col("file_id"), F.col("note")])


def _points_sql(where):
    return f"(select * from (select l_partkey as vin, l_quantity as miles, l_shipdate as status_date, l_orderkey as file_id, l_tax as note, row_number() over (partition by l_partkey, l_quantity order by l_shipdate desc, l_orderkey desc, l_tax desc) as rn from lineitem where {where}) x where rn = 1)"


@query(
    "upsert_newest_partial",
    f"""with o as {_points_sql(_OLD)}, n as {_points_sql(_NEW)}
      select coalesce(o.vin, n.vin) as vin, coalesce(o.miles, n.miles) as miles,
        case when n.vin is null or o.status_date > n.status_date then o.status_date else n.status_date end as status_date,
        case when n.vin is null or o.status_date > n.status_date then o.file_id else n.file_id end as file_id,
        case when o.vin is null then n.note else o.note end as note
      from o full join n on o.vin = n.vin and o.miles = n.miles""",
)
def _(t):
    return M.upsert_newest_partial(_points(t, _OLD), _points(t, _NEW), ["vin", "miles"], "status_date", ["status_date", "file_id"])


# Orders as the file ledger: a line item's order is the file it came from.
def _file_rows(t, where):
    rows = t.lineitem.where(where).selectExpr("l_partkey as vin", "l_orderkey as file_id", "l_extendedprice as msrp")
    return M.dedupe_newest(rows, ["vin"], "file_id", [F.col("msrp")])


def _file_rows_sql(where):
    return f"(select vin, file_id, msrp, o_orderdate as modified from (select l_partkey as vin, l_orderkey as file_id, l_extendedprice as msrp, row_number() over (partition by l_partkey order by l_orderkey desc, l_extendedprice desc) as rn from lineitem where {where}) x left join orders on o_orderkey = file_id where rn = 1)"


def _file_date_sql(test):
    take = f"(o.vin is null or (n.vin is not null and o.modified {test} n.modified))"
    return f"""with o as {_file_rows_sql(_OLD)}, n as {_file_rows_sql(_NEW)}
      select coalesce(o.vin, n.vin) as vin, case when {take} then n.file_id else o.file_id end as file_id,
        case when {take} then n.msrp else o.msrp end as msrp from o full join n on o.vin = n.vin"""


def _by_file_date(name, prefer, test):
    def run(t):
        ledger = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("last_modified"))
        return M.upsert_by_file_date(_file_rows(t, _OLD), _file_rows(t, _NEW), ["vin"], ledger, prefer=prefer)

    query(name, _file_date_sql(test))(run)


_by_file_date("upsert_by_file_date", "newest", "<")
_by_file_date("upsert_by_file_date_as_shipped", "as_shipped", ">")


@query("apply_change_batch", f"select * from {_STORED_SQL} s where o_orderkey not in (select o_orderkey from {_BATCH_SQL} b) union all select * from {_BATCH_SQL} b where o_orderstatus <> 'F'")
def _(t):
    batch = _batch(t).withColumn("deleted", F.when(F.col("o_orderstatus") == "F", "true").otherwise("false"))
    return M.apply_change_batch(_stored(t), batch, "o_orderkey", "deleted")


@query("delete_by_json_key", "select event_id, user_id from events where json_extract_string(props, '$.k') not in (select cast(p_size as varchar) from part)")
def _(t):
    ids = t.part.select(F.col("p_size").cast("string").alias("id")).distinct()
    return M.delete_by_json_key(t.events, S.json_field(F.col("props"), "k"), ids).select("event_id", "user_id")


@query(
    "patch_json_if_missing",
    """select o_orderkey, '{"status":"' || o_orderstatus || '"' || case when c_acctbal >= 0 or o_orderstatus = 'P' then ',"segment":"' || case when o_orderstatus = 'P' then 'own' else c_mktsegment end || '"' else '' end || '}' as payload
       from orders join customer on c_custkey = o_custkey""",
)
def _(t):
    own = F.when(F.col("o_orderstatus") == "P", F.lit("own"))
    rows = t.orders.select("o_orderkey", "o_custkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), own.alias("segment"))).alias("payload"))
    mapping = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("value"))
    return M.patch_json_if_missing(rows, F.col("o_custkey"), mapping, "segment").select("o_orderkey", "payload")


@query(
    "purge_for_reprocess",
    "select l_suppkey, date_trunc('month', l_shipdate)::timestamp as date, count(*) as n from lineitem group by 1, 2 having date < timestamp '1998-07-01'",
)
def _(t):
    from forecourt.operators.aggregates import count_by_period

    rollup = count_by_period(t.lineitem, ["l_suppkey"], "l_shipdate", "month")
    return M.purge_for_reprocess(rollup, "date", F.lit("1998-07-01").cast("timestamp"))


@query(
    "purge_partitions",
    "select l_suppkey, date_trunc('month', l_shipdate)::date as date, count(*) as n from lineitem group by 1, 2 having date < date '1998-07-01'",
)
def _(t):
    """The same on a stored rollup with a partition per month: the months to be rebuilt are dropped, the others not read."""
    from forecourt.operators.aggregates import count_by_period
    from forecourt.session import fresh_path
    from forecourt.sources.sinks import drop_partitions

    path = fresh_path(t.spark, "rollup")
    rollup = count_by_period(t.lineitem, ["l_suppkey"], "l_shipdate", "month").withColumn("date", F.to_date("date"))
    rollup.repartition("date").write.partitionBy("date").parquet(path)
    drop_partitions(t.spark, path, "date", lambda month: month >= "1998-07-01")
    return t.spark.read.schema(rollup.schema).parquet(path)


@query(
    "register_session",
    """select c_custkey as id, c_mktsegment as schema, c_name as script, '{"balance":' || c_nationkey || '}' as payload, c_acctbal > 0 as validated from customer
       union all select max(c_custkey) + 1, 'public', 'low_mileage', '{"days":30}', false from customer""",
)
def _(t):
    sessions = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("schema"),
        F.col("c_name").alias("script"),
        F.to_json(F.struct(F.col("c_nationkey").alias("balance"))).alias("payload"),
        (F.col("c_acctbal") > 0).alias("validated"),
    )
    return M.register_session(sessions, F.lit("public"), F.lit("low_mileage"), F.lit('{"days":30}'))


def jobs(t: Tables):
    """Customers as jobs: segment = schema, name = script; the last order is the last run."""
    runs = t.orders.groupBy(F.col("o_custkey").alias("_c")).agg(F.max("o_orderdate").alias("last_run"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("_s"))
    rows = t.customer.join(runs, F.col("c_custkey") == F.col("_c"), "left")
    status = F.when(F.col("_s") == "F", "success").when(F.col("_s") == "O", "failed")
    return rows.select(
        F.col("c_mktsegment").alias("schema"),
        F.col("c_name").alias("script"),
        F.lit("1995-01-01").cast("timestamp").alias("start_date"),
        F.make_dt_interval(days=F.col("c_nationkey") + 1).alias("frequency"),
        ts("last_run").alias("last_run"),
        (ts("last_run") - F.make_dt_interval(days=F.when(F.col("c_acctbal") < 0, 400).otherwise(0))).alias("last_update"),
        status.alias("status"),
        F.make_dt_interval(mins=F.col("c_nationkey")).alias("run_time"),
    )


JOBS_SQL = """(select c_mktsegment as schema, c_name as script, timestamp '1995-01-01' as start_date, c_nationkey + 1 as days, last_run,
    last_run - to_days(case when c_acctbal < 0 then 400 else 0 end) as last_update,
    case s when 'F' then 'success' when 'O' then 'failed' end as status, c_nationkey as minutes
  from customer left join (select o_custkey, max(o_orderdate) as last_run, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as s from orders group by 1) r on o_custkey = c_custkey)"""


def _plain_jobs(df):
    seconds = F.unix_seconds(F.col("start_date") + F.col("frequency")) - F.unix_seconds("start_date")
    return df.select("schema", "script", "last_run", "last_update", "status", (seconds / 86400).cast("int").alias("days"))


@query(
    "upsert_job_status",
    f"""select schema, script, coalesce(u.o_orderdate, last_run) as last_run, coalesce(u.o_orderdate, last_update) as last_update,
        case when u.o_orderdate is not null then 'success' else status end as status, days::integer as days
      from {JOBS_SQL} j left join (select c_name, max(o_orderdate) + interval 1 day as o_orderdate from customer join orders on c_custkey = o_custkey where o_orderstatus = 'O' group by 1) u on u.c_name = script""",
)
def _(t):
    ran = t.orders.where("o_orderstatus = 'O'").join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    done = ran.groupBy(F.col("c_mktsegment").alias("schema"), F.col("c_name").alias("script")).agg((F.max(ts("o_orderdate")) + F.make_dt_interval(days=F.lit(1))).alias("last_run"))
    updates = done.select("schema", "script", "last_run", F.col("last_run").alias("last_update"), F.lit("success").alias("status"), F.make_dt_interval(mins=F.lit(1)).alias("run_time"))
    return _plain_jobs(M.upsert_job_status(jobs(t), updates))


# --- windows and gates ----------------------------------------------------


def _now(t):
    return F.lit("2001-06-30 12:00:00").cast("timestamp")


@query(
    "high_water_window",
    """select o_orderkey, o_orderdate from orders where o_orderdate >= (select max(o_orderdate) from orders where o_orderstatus = 'F' and o_orderdate < timestamp '2000-01-01') - interval 3 days
       and o_orderdate < timestamp '2001-06-30 12:15:00'""",
)
def _(t):
    done = t.orders.where("o_orderstatus = 'F' and o_orderdate < timestamp_ntz'2000-01-01'")
    window = I.high_water_window(done, "o_orderdate", _now(t), reupload_minutes=-3 * 1440, lag_minutes=15)
    return I.in_window(t.orders, "o_orderdate", window).select("o_orderkey", "o_orderdate")


@query(
    "api_window",
    """select ((m at time zone 'UTC') at time zone 'America/Toronto') as lo, ((timestamp '2001-06-30 10:00:00' at time zone 'UTC') at time zone 'America/Toronto') as hi
       from (select max(o_orderdate) as m from orders) x""",
)
def _(t):
    lo, hi = I.api_window(t.orders, "o_orderdate", _now(t))
    return t.spark.range(1).select(lo.alias("lo"), hi.alias("hi"))


@query(
    "lookback_to_day",
    """select event_id, ts from events where ts >= (select max(ts) from events where event_type = 'view' and ts < timestamp '2024-01-20') - interval 3 days
       and ts < date_trunc('day', (select max(ts) from events))""",
)
def _(t):
    done = t.events.where("event_type = 'view' and ts < timestamp_ntz'2024-01-20'")
    return I.lookback_to_day(t.events, done, "ts").select("event_id", "ts")


def _periods(name, unit, step):
    sql = f"""select l_suppkey, unnest(generate_series(date_trunc('{unit}', lo), date_trunc('{unit}', hi) - interval {step}, interval {step}))::timestamp as period
      from (select l_suppkey, min(l_shipdate) as lo, max(l_shipdate) as hi from lineitem group by 1) b"""

    def run(t):
        bounds = t.lineitem.groupBy("l_suppkey").agg(F.min(ts("l_shipdate")).alias("lo"), F.max(ts("l_shipdate")).alias("hi"))
        return P.closed_periods(bounds, "lo", "hi", unit).select("l_suppkey", "period")

    query(name, sql)(run)


_periods("closed_periods", "month", "1 month")
for _u, _s in {"day": "1 day", "week": "7 days", "quarter": "3 months"}.items():
    _periods(f"period_generator_{_u}", _u, _s)


@query(
    "freshness_gate",
    """select epoch((select max(ts) from events where event_type = 'view') - (select max(ts) from events where event_type = 'click' and ts < timestamp '2024-01-29')) >= 86400
      and epoch((select max(ts) from events where event_type = 'error') - (select max(ts) from events where event_type = 'click' and ts < timestamp '2024-01-29')) >= 86400 as stale""",
)
def _(t):
    kind = lambda e: t.events.where(F.col("event_type") == e)
    target = kind("click").where("ts < timestamp_ntz'2024-01-29'")
    return I.freshness_gate([kind("view"), kind("error")], target, "ts", 24, inclusive=True)


@query(
    "next_run",
    f"""select script, case when last_run is null then start_date else start_date + to_days((days * (trunc(date_diff('day', start_date, last_run) / days) + 1))::integer) end as next_run from {JOBS_SQL} j""",
)
def _(t):
    due = P.next_run(F.col("start_date"), F.col("frequency"), F.col("last_run"))
    return jobs(t).select("script", due.alias("next_run"))
