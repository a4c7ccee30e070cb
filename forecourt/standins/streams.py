"""Streaming queries: the given tables read as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.session import fresh_path
from forecourt.standins.base import Tables, query
from forecourt.streaming import streams as R
from forecourt.streaming.epochs import newest_rows


def _stream(t: Tables, table: str):
    """One of the given tables as a stream of files."""
    schema = getattr(t, table).schema
    return R.file_stream(t.spark, t.folder, schema, pathGlobFilter=f"{table}.parquet")


def _events(t):
    return _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _done(query_):
    query_.awaitTermination()
    return query_


def _appended(t, stream, label):
    path = fresh_path(t.spark, label)
    _done(R.append_new(stream, path, fresh_path(t.spark, f"{label}-checkpoint")))
    return t.spark.read.schema(stream.schema).parquet(path)


@query("stream_ingest_files", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
def _(t):
    return _appended(t, _stream(t, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), "ingest")


def _closed_sql(unit, rows, key, ts, slowest):
    return f"""select {key}, date_trunc('{unit}', {ts})::timestamp as date, count(*) as n from {rows}
      where date_trunc('{unit}', {ts}) + interval 1 {unit} <= ({slowest}) - interval 3 days group by 1, 2"""


@query("stream_tumbling_counts", _closed_sql("day", "events", "user_id", "ts", "select max(ts) from events"))
def _(t):
    return _appended(t, R.tumbling_counts(_events(t), "ts", ["user_id"], "day"), "days")


@query("stream_tumbling_weeks", _closed_sql("week", "events", "user_id", "ts", "select max(ts) from events"))
def _(t):
    return _appended(t, R.tumbling_counts(_events(t), "ts", ["user_id"], "week"), "weeks")


@query(
    "stream_calendar_periods",
    f"""with d as ({_closed_sql('day', 'lineitem', 'l_suppkey', 'l_shipdate', 'select max(l_shipdate) from lineitem')})
      select l_suppkey, date_trunc('quarter', date)::timestamp as date, sum(n)::bigint as n from d
      where date_trunc('quarter', date) < (select date_trunc('quarter', max(date) + interval 1 day) from d) group by 1, 2""",
)
def _(t):
    rows = _stream(t, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("timestamp").alias("ts"))
    daily = _appended(t, R.tumbling_counts(rows, "ts", ["l_suppkey"], "day"), "days")
    return R.calendar_counts(daily, ["l_suppkey"], "quarter")


@query(
    "stream_distinct",
    "select user_id, date_trunc('day', ts)::timestamp as date, count(distinct json_extract_string(props, '$.k')) as n from events group by 1, 2",
)
def _(t):
    rows = _events(t).withColumn("ip", F.get_json_object("props", "$.k"))
    visits = _appended(t, R.distinct_visits(rows, "ts", ["user_id"], "ip"), "visits")
    return visits.groupBy("user_id", "date").agg(F.count("*").alias("n"))


@query(
    "stream_multi_feed",
    _closed_sql("day", "events", "event_type", "ts", "select min(m) from (select max(ts) as m from events where event_type in ('view', 'click') group by event_type) x").replace(
        "where", "where event_type in ('view', 'click') and", 1
    ),
)
def _(t):
    feeds = [_events(t).where(F.col("event_type") == e) for e in ("view", "click")]
    return _appended(t, R.tumbling_counts(R.union_feeds(feeds, "ts"), "ts", ["event_type"], "day", late=None), "feeds")


@query("stream_late_rescan", "select user_id, cast(ts as date) as date, count(*) as n from events group by 1, 2")
def _(t):
    path = fresh_path(t.spark, "late")
    _done(R.late_counts(_events(t), "ts", ["user_id"], path, fresh_path(t.spark, "late-checkpoint")))
    return newest_rows(t.spark, path, "user_id bigint, date date, n bigint", ["user_id", "date"])


@query("stream_upsert", "select user_id, event_id, ts from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) x where rn = 1")
def _(t):
    path = fresh_path(t.spark, "upsert")
    rows = _events(t).select("user_id", "event_id", "ts")
    _done(R.upsert_stream(rows, path, ["user_id"], "ts", fresh_path(t.spark, "upsert-checkpoint"), [F.col("event_id")]))
    return newest_rows(t.spark, path, rows.schema, ["user_id"])
