"""Sources and sinks: files that Spark writes from the given tables, then reads back."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyarrow import fs as pa_fs
from pyspark.sql import functions as F

from forecourt.operators import incremental as I
from forecourt.operators import merge as M
from forecourt.plans import leads as L
from forecourt.session import child_folders, fresh_path
from forecourt.sources import extracts as E
from forecourt.sources import files as S
from forecourt.sources import ledger as G
from forecourt.sources import sinks as K
from forecourt.standins.base import ORACLE, Tables, labelled, query
from forecourt.standins.latests import FILTER_SQL, raw_listings
from forecourt.standins.payloads import _UUID_DUCK, _UUID_SPARK

ARCHIVE_EVENTS = 1000
FILE_ROWS = 250_000
_EVENT_BUSINESS = _UUID_DUCK.replace("c_custkey", "user_id")


def _written(t: Tables, df, label: str, sep: str = ",", gzip: bool = True) -> str:
    path = fresh_path(t.spark, label)
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "emptyValue": ""}
    # A gzip file is read by one task: Spark deals out parts of about equal size, whose number follows the rows.
    df.hint("rebalance").write.options(**options).option("compression", "gzip" if gzip else "none").option("maxRecordsPerFile", FILE_ROWS).csv(path)
    return path


def event_archives(t: Tables):
    """Events as zip archives of a fixed size, every line twice, written to the scratch folder and read again."""
    folder = fresh_path(t.spark, "archives")
    business = F.expr(_UUID_SPARK.replace("c_custkey", "user_id"))
    body = F.struct(
        F.col("event_type").alias("event_name"),
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("happened_at"),
        business.alias("master_business_id"),
        F.get_json_object("props", "$.k").alias("ip_address"),
        F.struct(F.concat(F.lit("lead-"), "user_id").alias("id")).alias("lead"),
    )

    def zipped(lines: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("events.json", "\n".join(lines["line"]) + "\n")
            z.writestr("ignored.json", '{"event_name":"view"}\n')
        system, root = pa_fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/archive-{lines['archive'].iloc[0]}.zip") as out:
            out.write(buffer.getvalue())
        return pd.DataFrame({"events": [len(lines)]})

    archive = F.floor(F.col("event_id") / ARCHIVE_EVENTS).alias("archive")
    lines = t.events.select(archive, F.explode(F.array_repeat(F.to_json(body), 2)).alias("line"))
    lines.groupBy("archive").applyInPandas(zipped, "events long").agg(F.sum("events")).collect()
    return S.read_archives(t.spark, folder)


@query(
    "scan_event_archive",
    f"""select event_type as event_name, cast(event_id as varchar) as event_id, date_trunc('second', ts)::timestamp as happened_at,
       '{{"master_business_id":"' || upper({_EVENT_BUSINESS}) || '","ip_address":"' || json_extract_string(props, '$.k') || '","lead":{{"id":"lead-' || user_id || '"}}}}' as payload
       from events where event_type in ('view', 'purchase')""",
)
def _(t):
    return S.scan_event_archive(event_archives(t), ["view", "purchase"]).drop("file")


@query("archive_reconcile", "select 'lead-' || c_custkey as id, c_custkey in (select user_id from events where event_type = 'signup') as found from customer")
def _(t):
    from forecourt.plans.health import archive_reconcile

    events = S.scan_event_archive(event_archives(t), ["signup"])
    expected = t.customer.select(F.concat(F.lit("lead-"), "c_custkey").alias("id"))
    return archive_reconcile(expected, events, "lead", "id")


@query(
    "archive_reconcile_counts",
    """select count(*) as expected, (select count(*) from events where event_type = 'signup' and user_id in (select c_custkey from customer)) as matches,
       count(*) filter (c_custkey not in (select user_id from events where event_type = 'signup')) as missing from customer""",
)
def _(t):
    from forecourt.plans.health import archive_reconcile_counts

    events = S.scan_event_archive(event_archives(t), ["signup"])
    expected = t.customer.select(F.concat(F.lit("lead-"), "c_custkey").alias("id"))
    return archive_reconcile_counts(expected, events, "lead", "id")


_VIN_DUCK = "lpad(cast(l_partkey as varchar), 8, 'V') || 'X' || lpad(cast(l_suppkey as varchar), 8, 'W')"


def _listing_query(profile):
    sql = f"""select cast(l_orderkey as varchar) as id, l_suppkey::integer as dealer_id, {_VIN_DUCK} as vin,
      case when l_discount = 0 then null when l_discount = 0.01 then l_quantity * 10000 else l_extendedprice end as price,
      case when l_discount <> 0.02 then l_quantity * 10000 end as miles, l_shipdate as status_date, 'M5V' || l_suppkey as zip,
      l_quantity as latitude, l_linestatus as state, 'dealer' || l_suppkey || '.example.com' as domain, null::varchar as city
      from lineitem where {FILTER_SQL[profile]}"""

    def run(t):
        rows = S.scan_listing_csv(t.spark, _written(t, raw_listings(t), "listings"), profile)
        return rows.select("id", "dealer_id", "vin", "price", "miles", "status_date", "zip", "latitude", "state", "domain", "city")

    query(f"scan_listing_csv_{profile}", sql)(run)


for _profile in S.LISTING_PROFILES:
    _listing_query(_profile)


_CUSTOMER_JSON = """'{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}'"""


def _customers(t, key="c_custkey"):
    return t.customer.select(F.col("c_custkey").alias(key), "c_name", "c_mktsegment")


@query("scan_sales_tsv", """select '{"id":"' || c_custkey || '","c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' as payload from customer""")
def _(t):
    path = _written(t, _customers(t, "id"), "sales", "\t", gzip=False)
    return S.scan_sales_tsv(t.spark, path).select("payload")


@query("scan_catalog_tsv", """select p_brand as vin_pattern, p_partkey::integer as vehicle_id, '{"NAME":"' || p_name || '","SIZE":"' || p_size || '"}' as payload from part""")
def _(t):
    rows = t.part.select(F.col("p_brand").alias("VIN_PATTERN"), F.col("p_partkey").alias("VEHICLE_ID"), F.col("p_name").alias("NAME"), F.col("p_size").alias("SIZE"))
    return S.scan_catalog_tsv(t.spark, _written(t, rows, "catalog", "\t")).drop("file")


@query(
    "scan_billing_export",
    """select cast(o_orderkey as varchar) as id, o_orderdate + interval 4 hours as updateddate, case when o_orderstatus = 'F' then 'true' else 'false' end as deleted,
       '{"Order.is_deleted":"' || case when o_orderstatus = 'F' then 'true' else 'false' end || '","Account.Id":"' || o_custkey || '"}' as payload from orders""",
)
def _(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("Order.Id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-0400'").alias("Order.UpdatedDate"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("Order.is_deleted"),
        F.col("o_custkey").alias("Account.Id"),
    )
    return S.scan_billing_export(t.spark, _written(t, rows, "billing"), "Order")


@query(
    "scan_sectioned_report",
    """select s_name as dealer, l_orderkey::integer as purchase_number, l_shipdate as purchase_date,
       '{"Gross":"' || cast(cast(l_extendedprice as decimal(18,2)) as varchar) || '","Line":"' || l_linenumber || '"}' as payload
       from lineitem join supplier on s_suppkey = l_suppkey""",
)
def _(t):
    # Each supplier is one report: eight head lines, its line items, a blank line, a total.
    key = F.concat(F.lit("report-"), F.col("s_suppkey"))
    head = F.array(*[F.lit("Gross Profit Report") if i != 2 else F.concat("s_name", F.lit(",x")) for i in range(1, 8)], F.lit("Deal,Gross,Line"))
    tops = t.supplier.select(key.alias("file"), F.posexplode(head).alias("n", "line"))
    first = F.concat("l_orderkey", F.lit(" x "), F.date_format("l_shipdate", "MM/dd/yyyy"))
    text = F.concat_ws(",", first, F.concat(F.lit("$"), F.col("l_extendedprice").cast("decimal(18,2)")), "l_linenumber")
    data = t.lineitem.select(F.concat(F.lit("report-"), "l_suppkey").alias("file"), (F.lit(100) + F.monotonically_increasing_id()).alias("n"), text.alias("line"))
    tail = t.supplier.select(key.alias("file"), F.posexplode(F.array(F.lit(""), F.lit("Total,$1,1"))).alias("n", "line"))
    tail = tail.withColumn("n", F.col("n") + F.lit(9 * 10**18))
    lines = tops.unionByName(data).unionByName(tail).withColumn("n", F.col("n").cast("bigint"))
    path = fresh_path(t.spark, "reports")
    lines.repartition("file").sortWithinPartitions("file", "n").select("file", "line").write.partitionBy("file").text(path)
    return S.scan_sectioned_report(t.spark, path).drop("at")


@query("scan_all_text", "select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def _(t):
    return S.scan_all_text(t.spark, _written(t, t.nation, "nation", gzip=False))


@query("import_column_subset", """select '{"source_ss":"WWW.dealer' || l_suppkey || '.example.com","zip_is":"M5V ' || l_suppkey || '"}' as payload, count(*) as n from lineitem group by 1""")
def _(t):
    raw = S.read_text_table(t.spark, _written(t, raw_listings(t).drop("dealer_id_is", "city_ss", "state_ss"), "subset"))
    return S.column_subset(raw, S.CONTACT_COLUMNS).groupBy("payload").agg(F.count("*").alias("n"))


@query(
    "listing_features",
    f"""select '{{"vin_ss":"' || {_VIN_DUCK} || '","options_texts":"' || l_returnflag || '|' || l_linestatus || '"}}' as payload, count(*) as n from lineitem where l_returnflag <> 'R' group by 1""",
)
def _(t):
    # One folder per flag; the files of one were read before.
    rows = t.lineitem.selectExpr("lpad(cast(l_partkey as string), 8, 'V') || 'X' || lpad(cast(l_suppkey as string), 8, 'W') as vin_ss", "l_tax as other", "concat(l_returnflag, '|', l_linestatus) as options_texts", "l_returnflag as flag")
    path = fresh_path(t.spark, "features")
    rows.write.partitionBy("flag").options(header=True, emptyValue="", compression="gzip").csv(path)
    raw = S.read_text_table(t.spark, path, file=True)
    read = raw.where("flag = 'R'").select("file", "last_modified").distinct()
    ledger = G.record_files(t.spark.createDataFrame([], G.LEDGER_SCHEMA), read, "features", F.lit("2020-01-01").cast("timestamp"))
    fresh = G.rows_of_new_files(raw, ledger, "features")
    return S.column_subset(fresh, S.FEATURE_COLUMNS, ["file"]).groupBy("payload").agg(F.count("*").alias("n"))


@query("import_keyed_csv", f"select c_custkey::integer as id, case when c_acctbal < 0 then '{{}}' else {_CUSTOMER_JSON} end as payload from customer")
def _(t):
    # Customers in debt are already stored, with an empty payload.
    rows = S.import_keyed_csv(t.spark, _written(t, _customers(t, "lId"), "keyed", gzip=False), "lId")
    stored = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").cast("int").alias("id"), F.lit("{}").alias("payload"))
    return M.insert_if_absent(stored, rows, ["id"], "position")


@query("snapshot_versions", "select year(o_orderdate)::integer as year, count(*) as n from orders where year(o_orderdate) >= 1998 group by 1")
def _(t):
    path = fresh_path(t.spark, "versions")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    rows.write.partitionBy("year").option("header", True).csv(path)
    for folder, _ in child_folders(t.spark, path):
        if int(folder.rsplit("=", 1)[-1]) < 1998:
            _aged(t.spark, folder, 1_577_836_800_000)  # 2020-01-01
    versions = S.snapshot_versions(t.spark, path, F.lit("2020-08-27").cast("timestamp"))
    return versions.groupBy("year").agg(F.count("*").alias("n"))


def _aged(spark, folder: str, ms: int) -> None:
    """Give the files of a folder another modification time."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(root):
        system.setTimes(status.getPath(), ms, -1)


@query(
    "scan_mixed_headers",
    """select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment, case when c_custkey % 3 = 2 then 'n' || c_nationkey end as note from customer where c_custkey % 3 <> 1
       union all select cast(c_custkey as varchar), c_name, null, null from customer where c_custkey % 3 = 1""",
)
def _(t):
    """Three kinds of files in one folder: all columns, one missing, and others in another order with one more."""
    path = fresh_path(t.spark, "mixed")
    id_, name, segment, note = "c_custkey as id", "c_name as name", "c_mktsegment as segment", "concat('n', c_nationkey) as note"
    kinds = [[id_, name, segment], [id_, name], [note, segment, id_, name]]
    for k, columns in enumerate(kinds):
        t.customer.where(f"c_custkey % 3 = {k}").selectExpr(*columns).write.mode("append").option("header", True).csv(path)
    return S.read_text_table(t.spark, path).select("id", "name", "segment", "note")


# --- ledger ---------------------------------------------------------------


def _listing(t):
    return t.orders.select(F.col("o_orderkey").cast("string").alias("file"), F.col("o_orderdate").cast("timestamp").alias("last_modified"))


def _ledger(t):
    script = F.when(F.col("o_orderstatus") == "F", "impressions").otherwise("sales")
    return t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("file"), F.col("o_orderdate").cast("timestamp").alias("last_modified"), script.alias("script"),
        F.col("o_orderdate").cast("timestamp").alias("scanned"),
    )


@query("ledger_new_files", "select cast(o_orderkey as varchar) as file, o_orderdate as last_modified from orders where o_orderstatus <> 'F'")
def _(t):
    return G.new_files(_listing(t), _ledger(t), "impressions")


@query("newer_than_gate", "select cast(o_orderkey as varchar) as file, o_orderdate as last_modified from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderstatus = 'F')")
def _(t):
    return G.newer_than(_listing(t), _ledger(t), "impressions")


@query("row_provenance", "select l_orderkey as file_id, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O')")
def _(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("file_id"), "l_linenumber", "l_partkey")
    return M.cascade_delete(rows, M.purge_ledger(_ledger(t), ["impressions"]))


@query(
    "ledger_publish",
    "select l_returnflag as flag, count(*) as n from lineitem group by 1",
)
def _(t):
    """Three deliveries, one after the other; the last one also brings the first's file again."""
    rows_path, ledger_path = fresh_path(t.spark, "rows"), fresh_path(t.spark, "ledger")
    _deliveries(t, rows_path, ledger_path, "deliveries", (["A"], ["N"], ["R", "A"]))
    return G.published(G.read_rows(t.spark, rows_path, "flag string, line bigint"), G.read_ledger(t.spark, ledger_path), "deliveries").groupBy("flag").agg(F.count("*").alias("n"))


def _deliveries(t, rows_path, ledger_path, script, deliveries):
    rows = t.lineitem.select(F.col("l_returnflag").alias("file"), F.col("l_returnflag").alias("flag"), F.col("l_linenumber").cast("bigint").alias("line"), F.lit("2024-01-01").cast("timestamp").alias("last_modified"))
    for flags in deliveries:
        G.publish_files(rows.where(F.col("file").isin(flags)), rows_path, ledger_path, script, F.lit("2024-01-02").cast("timestamp"))


@query(
    "ledger_purge",
    """select 'first' as script, l_returnflag as flag, count(*) as n from lineitem where l_returnflag = 'A' group by 2
       union all select 'second', l_returnflag, count(*) from lineitem where l_returnflag <> 'A' group by 2""",
)
def _(t):
    """Two jobs have read files; the first is purged and reads one of them again."""
    rows_path, ledger_path = fresh_path(t.spark, "rows"), fresh_path(t.spark, "ledger")
    _deliveries(t, rows_path, ledger_path, "first", (["A", "R"],))
    _deliveries(t, rows_path, ledger_path, "second", (["N", "R"],))
    G.purge_job(t.spark, rows_path, ledger_path, "first")
    _deliveries(t, rows_path, ledger_path, "first", (["A"],))
    rows, ledger = G.read_rows(t.spark, rows_path, "flag string, line bigint"), G.read_ledger(t.spark, ledger_path)
    both = G.published(rows, ledger, "first").unionByName(G.published(rows, ledger, "second"))
    return both.groupBy("script", "flag").agg(F.count("*").alias("n"))


# --- extracts -------------------------------------------------------------

_LO, _HI = "1997-03-01", "1998-09-01"
_ORDER_JSON = """'{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}'"""
_WINDOW_SQL = f"o_orderdate >= timestamp '{_LO}' and o_orderdate < timestamp '{_HI}'"


def _window():
    return F.lit(_LO).cast("timestamp_ntz"), F.lit(_HI).cast("timestamp_ntz")


@query("extract_incremental", f"select o_orderkey, o_orderdate, {_ORDER_JSON} as payload from orders where {_WINDOW_SQL}")
def _(t):
    return E.extract_incremental(t.orders.drop("o_totalprice"), "o_orderdate", _window(), ["o_orderkey", "o_orderdate"])


@query("extract_status_filtered", f"select o_orderkey, o_orderdate, {_ORDER_JSON} as payload from orders where {_WINDOW_SQL} and o_orderstatus = 'F'")
def _(t):
    return E.extract_incremental(t.orders.drop("o_totalprice"), "o_orderdate", _window(), ["o_orderkey", "o_orderdate"], F.col("o_orderstatus") == "F")


@query("extract_full", """select r_regionkey, '{"r_name":"' || r_name || '"}' as payload from region""")
def _(t):
    return E.extract_full(t.region, "r_regionkey")


@query(
    "extract_joined",
    f"""select o_orderkey, o_orderdate, '{{"o_orderpriority":"' || o_orderpriority || '","c_mktsegment":' || coalesce('"' || c_mktsegment || '"', 'null') || '}}' as payload
        from orders left join customer on c_custkey = o_custkey and c_acctbal > 0 where {_WINDOW_SQL} and o_orderstatus <> 'F'""",
)
def _(t):
    detail = t.customer.where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    header = t.orders.drop("o_totalprice")
    drop = ["o_custkey", "o_orderstatus", "c_custkey"]
    return E.extract_joined(header, detail, F.col("c_custkey") == F.col("o_custkey"), "o_orderdate", _window(), ["o_orderkey", "o_orderdate"], drop, F.col("o_orderstatus") != "F")


@query(
    "extract_typed_audit",
    """select event_id as id, user_id, ts as happened_at, event_type as request_method, props as request_payload, user_id::integer as response_code,
       null::varchar as response_payload, '/' || event_type as endpoint from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'""",
)
def _(t):
    rows = t.events.select(
        F.col("event_id").alias("id"), "user_id", F.col("ts").alias("happened_at"), F.col("event_type").alias("request_method"), F.col("props").alias("request_payload"),
        F.col("user_id").cast("string").alias("response_code"), F.lit(None).cast("string").alias("response_payload"), F.concat(F.lit("/"), "event_type").alias("endpoint"),
    )
    return E.extract_typed_audit(rows, (F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")))


# --- sinks ----------------------------------------------------------------


@query("sink_replace", "select o_custkey, count(*) + 1 as n from orders group by 1")
def _(t):
    table = f"forecourt_replace_{uuid.uuid4().hex}"
    K.replace_table(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")), table)
    # The second version reads the first one while replacing it.
    K.replace_table(t.spark.table(table).withColumn("n", F.col("n") + 1), table)
    return t.spark.table(table)


@query("replace_via_stage", "select l_suppkey, l_partkey, l_shipdate, count(*) as n from lineitem a where l_shipdate <= (select min(l_shipdate) from lineitem b where b.l_suppkey = a.l_suppkey and b.l_partkey = a.l_partkey) + interval 14 days group by 1, 2, 3")
def _(t):
    from forecourt.operators.joins import not_seen_before

    table = f"forecourt_stage_{uuid.uuid4().hex}"
    rows = t.lineitem.groupBy("l_suppkey", "l_partkey", "l_shipdate").agg(F.count("*").alias("n"))
    K.replace_table(rows, table)
    K.replace_table(not_seen_before(t.spark.table(table), t.lineitem, ["l_suppkey", "l_partkey"], "l_shipdate", 14), table)
    return t.spark.table(table)


@query(
    "upsert_partitions",
    """select o_orderkey, year(o_orderdate)::integer as year, o_totalprice + case when o_orderstatus = 'P' and o_orderdate >= timestamp '2000-01-01' then 1 else 0 end as o_totalprice from orders""",
)
def _(t):
    path = fresh_path(t.spark, "partitions")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice", "o_orderstatus")
    rows.drop("o_orderstatus").write.partitionBy("year").parquet(path)
    batch = rows.where("o_orderstatus = 'P' and year >= 2000").drop("o_orderstatus").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    K.upsert_partitions(batch, path, ["o_orderkey"], "year")
    return t.spark.read.parquet(path).select("o_orderkey", "year", "o_totalprice")


_VIEWS = [
    f"{kind}_leads_{p}{d}"
    for kind, periods in {"master": ("lifetime", "daily", "monthly", "weekly", "yearly"), "mixed": ("lifetime", "monthly", "yearly")}.items()
    for p in periods
    for d in ("", "_device")
] + ["estimated_revenue_quarterly", "estimated_revenue_yearly", "estimated_revenue_lifetime", "estimated_vehicles_sold_monthly", "estimated_vehicles_sold_lifetime"]


@query("sink_refresh_views", " union all ".join(f"select '{v}' as view, count(*) as n from ({ORACLE[v]}) x" for v in _VIEWS))
def _(t):
    from forecourt.standins.rollups import _values

    source = labelled(t).select("id", "master_business_id", "created_at", "device", "lead_content")
    tables = K.refresh_views(L.dashboard_rollup(source, _values(t)), L.dashboard_columns(), prefix=f"forecourt_{uuid.uuid4().hex}_")
    counts = [t.spark.table(table).agg(F.lit(view).alias("view"), F.count("*").alias("n")) for view, table in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
