"""Payload packing, every typed-view rule and every typed view."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import payload as P
from forecourt.functions import scalars as S
from forecourt.plans.specs import SALES_REMAPS, VIEW_NAMES, view_spec
from forecourt.session import materialize
from forecourt.standins.base import query

# Every rule reads a text made from a customer row; customers in debt have an
# empty field, and furniture buyers a value the rule cannot read.
_ID = "lpad(hex(c_custkey), 12, '0')"
_UUID_SPARK = "upper(concat('0a1b2c3d-0000-4000-8000-', lpad(hex(c_custkey), 12, '0')))"
_UUID_DUCK = "lower('0a1b2c3d-0000-4000-8000-' || lpad(printf('%x', c_custkey), 12, '0'))"
_CENTURY = "2000 + c_nationkey"
# rule -> (raw text in Spark, value in DuckDB, text the rule rejects or None)
_RULES = {
    "text": ("concat({tag}, c_name)", "{tag} || c_name", None),
    "int": ("cast(c_custkey + {n} as string)", "(c_custkey + {n})::integer", "12.0"),
    "numeric": ("cast(cast(c_acctbal as decimal(18,2)) + {n} as string)", "round(c_acctbal + {n}, 2)", "1,5"),
    "double": ("cast(c_custkey + {n} as string)", "(c_custkey + {n})::double", "abc"),
    "cents": ("cast(c_custkey + {n} as string)", "(c_custkey + {n}) / 100.0::double", "abc"),
    "boolean": ("case when c_nationkey > 12 then 'true' else 'false' end", "c_nationkey > 12", "maybe"),
    "uuid": (_UUID_SPARK, _UUID_DUCK, "0a1b2c3d"),
    "json": ("concat('{{\"k\":\"', c_mktsegment, '\"}}')", "'{{\"k\":\"' || c_mktsegment || '\"}}'", "{not json"),
    "ts_offset": (f"concat({_CENTURY}, '-07-15T10:20:30-0400')", f"make_timestamp({_CENTURY}, 7, 15, 14, 20, 30)", "2000-07-15"),
    "ts_local": (f"concat({_CENTURY}, '-07-15 00:00:00')", f"make_timestamp({_CENTURY}, 7, 15, 4, 0, 0)", "15 July"),
    "ts_plain": (f"concat({_CENTURY}, '-01-31 08:09:10')", f"make_timestamp({_CENTURY}, 1, 31, 8, 9, 10)", "31.1.2000"),
    "date_us": (f"concat('1/31/', {_CENTURY})", f"make_timestamp({_CENTURY}, 1, 31, 0, 0, 0)", "2000-01-31"),
    "ts_day_text": (f"concat({_CENTURY}, '-02-28')", f"({_CENTURY}) || '-02-28 00:00:00'", "28/02/2000"),
    "strip_spaces": ("concat({tag}, ' M5V ', c_nationkey, 'X')", "{tag} || 'M5V' || c_nationkey || 'X'", None),
    "unescape_json": ("concat('[\"\\\\', c_custkey, ', 1]')", "'[' || c_custkey || ', 1]'", "{not json"),
}


def _raw(rule: str, tag: str, n: int):
    text, _, bad = _RULES[rule]
    good = F.expr(text.replace("{tag}", f"'{tag}'").replace("{n}", str(n)).replace("{{", "{").replace("}}", "}"))
    value = good if bad is None else F.when(F.col("c_mktsegment") == "FURNITURE", bad).otherwise(good)
    return F.when(F.col("c_acctbal") < 0, "").otherwise(value)


def _expected(rule: str, tag: str, n: int) -> str:
    _, text, bad = _RULES[rule]
    value = text.replace("{tag}", f"'{tag}'").replace("{n}", str(n)).replace("{{", "{").replace("}}", "}")
    gap = "c_acctbal < 0" + ("" if bad is None else " or c_mktsegment = 'FURNITURE'")
    return f"case when not ({gap}) then {value} end"


def _landing(t, spec):
    """Customers in landing shape, with a payload that has every field of the spec."""
    day = F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("c_nationkey"))
    envelope = {"id": F.col("c_custkey"), "created_at": day, "updated_at": day, "updateddate": day}
    fields = [_raw(f.rule, f.key, i).alias(f.key) for i, f in enumerate(spec.fields)]
    landed = t.customer.select(*[envelope[e].alias(e) for e in spec.envelope], F.to_json(F.struct(*fields)).alias("payload"))
    # Written, so that the view parses stored JSON instead of an expression the optimizer removes.
    return materialize(landed, "landing")


def _view_sql(spec) -> str:
    envelope = {"id": "c_custkey", **{e: "timestamp '2020-01-01' + to_days(c_nationkey)" for e in ("created_at", "updated_at", "updateddate")}}
    cols = [f"{envelope[e]} as {e}" for e in spec.envelope]
    cols += [f'{_expected(f.rule, f.key, i)} as "{f.out}"' for i, f in enumerate(spec.fields)]
    return f"select {', '.join(cols)} from customer"


def _view_query(name: str):
    spec = view_spec(name)
    query(name, _view_sql(spec))(lambda t: P.typed_view(_landing(t, spec), spec, remaps=SALES_REMAPS if name == "v_sales_data" else None))


for _name in VIEW_NAMES:
    _view_query(_name)


def _rule_query(rule: str):
    spec = P.ViewSpec(("id",), (P.Field("Some.Key", "value", rule),))
    query(f"rule_{rule}", f"select c_custkey as id, {_expected(rule, 'Some.Key', 0)} as value from customer")(
        lambda t: P.typed_view(_landing(t, spec), spec)
    )


for _rule in _RULES:
    _rule_query(_rule)


@query("rule_remap", "select c_custkey, case c_mktsegment when 'BUILDING' then 'SITE' when 'MACHINERY' then 'PLANT' else c_mktsegment end as value from customer")
def _(t):
    return t.customer.select("c_custkey", P.remap(F.col("c_mktsegment"), {"BUILDING": "SITE", "MACHINERY": "PLANT"}).alias("value"))


@query("typed_view", "select o_orderkey as id, o_totalprice as price, o_orderstatus as status, o_orderdate as placed from orders")
def _(t):
    spec = P.ViewSpec(("id",), P.parse_fields("price:double status Order.placed:ts_plain"))
    body = F.struct(F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", S.WALL_CLOCK).alias("Order.placed"))
    landed = materialize(t.orders.select(F.col("o_orderkey").alias("id"), F.to_json(body).alias("payload")), "landing")
    return P.typed_view(landed, spec)


@query(
    "count_rejects",
    "select 'a' as field, count(*) filter (c_acctbal >= 0 and c_mktsegment = 'FURNITURE') as rejects from customer union all select 'b', 0 from customer group by 1",
)
def _(t):
    spec = P.ViewSpec((), (P.Field("a", "a", "int"), P.Field("b", "b", "text")))
    return P.count_rejects(_landing(t, spec), spec)


@query(
    "pack_payload",
    """select c_custkey, '{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' as payload from customer""",
)
def _(t):
    return P.pack_payload(t.customer.drop("c_acctbal"), ["c_custkey"])


@query("json_extract_uuid", f"select c_custkey, case when c_mktsegment <> 'FURNITURE' then {_UUID_DUCK} end as business, c_mktsegment as status from customer")
def _(t):
    business = F.when(F.col("c_mktsegment") == "FURNITURE", "none").otherwise(F.expr(_UUID_SPARK))
    rows = t.customer.select("c_custkey", F.to_json(F.struct(business.alias("b"), F.col("c_mktsegment").alias("status"))).alias("payload"))
    return rows.select("c_custkey", P.json_uuid(F.col("payload"), "b").alias("business"), S.json_field(F.col("payload"), "status").alias("status"))


@query("nested_extract", "select o_orderkey, cast(o_custkey as varchar) as lead_id from orders")
def _(t):
    body = F.to_json(F.struct(F.struct(F.col("o_custkey").alias("id")).alias("lead")))
    return t.orders.select("o_orderkey", S.json_field(body, "lead", "id").alias("lead_id"))


@query("tagged_constants", "select p_partkey, 0 as vehicle_id, -2500.0::double as trade_value_intercept, round(p_retailprice * 0.9, 4) as value from part")
def _(t):
    return t.part.select("p_partkey", F.lit(0).alias("vehicle_id"), F.lit(-2500.0).alias("trade_value_intercept"), F.round(F.col("p_retailprice") * 0.9, 4).alias("value"))
