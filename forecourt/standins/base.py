"""Registry of queries on the given tables, each with the SQL that states its result.

A stand-in maps the given tables onto the shapes the operators work on, e.g.
line items as vehicle listings. ``*_SQL`` texts state the same mapping for the
oracle.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.session import OWN_SCRATCH, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _ready(spark: SparkSession) -> SparkSession:
    """Tuned, with a scratch folder of our own only on a local master that names none."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.startswith("local["):
        spark.conf.set(OWN_SCRATCH, os.path.join(tempfile.gettempdir(), "forecourt-scratch"))
    return tune(spark)


class Tables:
    """The given tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def finish(df: DataFrame) -> DataFrame:
    """Plain output types: zone-free timestamps, doubles for decimals."""
    plain = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double"}
    cols = []
    for f in df.schema.fields:
        target = next((to for kind, to in plain.items() if isinstance(f.dataType, kind)), None)
        c = F.col(f"`{f.name}`")
        cols.append(c.cast(target).alias(f.name) if target else c)
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: finish(fn(Tables(_ready(spark), folder)))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def ts(name: str):
    """A zone-free column as an instant in UTC."""
    return F.col(name).cast("timestamp")


# --- shared stand-ins -----------------------------------------------------


def reports(t: Tables) -> DataFrame:
    """Orders as accident reports."""
    outcome = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no")
    return t.orders.select(
        F.col("o_custkey").alias("master_business_id"), F.col("o_orderdate").alias("created_at"), outcome.alias("accident_reported")
    )


REPORTS_SQL = """(select o_custkey as master_business_id, o_orderdate as created_at,
  case o_orderstatus when 'F' then 'yes' when 'O' then 'no' end as accident_reported from orders)"""


def listings(t: Tables) -> DataFrame:
    """Line items as vehicle listings."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("dealer_id"),
        F.col("l_partkey").alias("vin"),
        F.col("l_shipdate").alias("status_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 1000).alias("miles"),
        F.col("l_partkey").alias("taxonomy_vin"),
        F.col("l_returnflag").alias("trim_orig"),
        F.concat(F.lit("dealer"), F.col("l_suppkey"), F.lit(".example.com")).alias("domain"),
    )


LISTINGS_SQL = """(select l_suppkey as dealer_id, l_partkey as vin, l_shipdate as status_date, l_extendedprice as price,
  l_quantity * 1000 as miles, l_partkey as taxonomy_vin, l_returnflag as trim_orig,
  'dealer' || l_suppkey || '.example.com' as domain from lineitem)"""


def lead_flags():
    """Flag columns of an order seen as a lead."""
    status, priority, total = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    flag = lambda c: F.when(c, 1).otherwise(0)
    return {
        "is_insurance": flag(priority == "1-URGENT"),
        "is_trade": flag(status == "F"),
        "is_credit_partial": flag(priority == "2-HIGH"),
        "is_credit_verified": flag(priority == "3-MEDIUM"),
        "is_credit_finance": F.when(status == "P", 1).when(status == "O", 0),
        "is_ecom": flag(total > 300000),
        "is_test_drive": flag(priority == "5-LOW"),
        "is_spotlight": flag(total < 50000),
    }


def leads(t: Tables) -> DataFrame:
    """Orders as leads with their flags."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("master_business_id"),
        F.col("o_custkey").alias("integration_settings_id"),
        F.col("o_orderdate").alias("created_at"),
        F.substring("o_orderpriority", 1, 1).alias("device"),
        *[c.alias(k) for k, c in lead_flags().items()],
        F.when(F.col("o_totalprice") > 400000, "special").when(F.col("o_totalprice") > 200000, "generic").alias("sub_type"),
    )


def labelled(t: Tables) -> DataFrame:
    """Leads with their labels as an array."""
    from forecourt.plans.leads import labels_of

    return leads(t).withColumn("lead_content", labels_of(F.col, True))


# The oracle's own statement of the labels: text joined by '-', and the first label.
_SPOTLIGHT = "case when o_totalprice < 50000 then '-spotlight' else '' end"
_PLAIN_LABELS = """
    case when o_orderstatus = 'P' then '-finance' else '' end ||
    case when o_orderstatus = 'O' and o_orderpriority in ('2-HIGH', '3-MEDIUM') then '-credit' else '' end ||
    case when o_orderpriority = '5-LOW' then '-testdrive' else '' end ||
    case when o_orderstatus = 'F' then '-trade' else '' end ||
    case when o_orderpriority = '1-URGENT' then '-insurance' else '' end ||
    case when o_totalprice > 300000 then '-payments' else '' end"""


def labels_sql(spotlight: bool) -> str:
    text = _PLAIN_LABELS + (f" || {_SPOTLIGHT}" if spotlight else "")
    return f"(case when ({text}) = '' then 'unclassified' else substr(({text}), 2) end)"


LEADS_SQL = f"""(select o_orderkey as id, o_custkey as master_business_id, o_custkey as integration_settings_id,
  o_orderdate as created_at, substr(o_orderpriority, 1, 1) as device,
  case when o_totalprice > 400000 then 'special' when o_totalprice > 200000 then 'generic' end as sub_type,
  {labels_sql(True)} as labels, split_part({labels_sql(True)}, '-', 1) as first_label from orders)"""
