"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import periods as P
from forecourt.functions import scalars as S
from forecourt.functions import vehicle as V
from forecourt.plans.leads import labels_of
from forecourt.standins.base import labels_sql, leads, query, ts
from forecourt.standins.merges import JOBS_SQL, jobs

_VIN_DUCK = "lpad(cast(l_partkey as varchar), 8, 'V') || 'X' || lpad(cast(l_suppkey as varchar), case when l_tax = 0 then 7 else 8 end, 'W')"
_VIN_SPARK = _VIN_DUCK.replace("varchar", "string")


@query("vin_pattern", f"select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when length(v) = 17 then substr(v, 1, 8) || substr(v, 10, 2) end as vin_pattern from (select *, {_VIN_DUCK} as v from lineitem) x")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", V.vin_pattern(F.expr(_VIN_SPARK)).alias("vin_pattern"))


@query(
    "clean_source_domain",
    "select page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/]+)', 1)), '^(www|promos|en|fr|vehicles|landing|m|offres|promotions)\\.', '') as domain from pages",
)
def _(t):
    return t.pages.select("page_id", V.clean_source_domain(F.upper(F.regexp_extract("url", "^https?://([^/]+)", 1))).alias("domain"))


# Part sizes and brands stand for body and vehicle types.
_BODIES = [*V.BODY_TYPES, "Limousine", "Targa", "Bus"]
_KINDS = [*V.VEHICLE_TYPES, "trailer"]


def _pick(names, column):
    arms = " ".join(f"when {i} then '{n}'" for i, n in enumerate(names))
    return f"case {column} - 1 {arms} else '{names[0]}' end"


def _body_sql():
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in V.BODY_TYPES.items())
    kinds = " ".join(f"when '{k}' then '{v}'" for k, v in V.VEHICLE_TYPES.items())
    return f"case lower(body) {arms} else case lower(kind) {kinds} else body end end"


_KIND = "cast(replace(p_brand, 'Brand#', '') as integer)"


@query(
    "normalize_body_type",
    f"select p_partkey, {_body_sql()} as body_type from (select p_partkey, {_pick(_BODIES, 'p_size')} as body, {_pick(_KINDS, _KIND)} as kind from part) x",
)
def _(t):
    rows = t.part.selectExpr("p_partkey", f"{_pick(_BODIES, 'p_size')} as body", f"{_pick(_KINDS, _KIND)} as kind")
    return rows.select("p_partkey", V.normalize_body_type(F.col("body"), F.initcap("kind")).alias("body_type"))


@query(
    "normalize_catalog_row",
    """select p_partkey, p_brand as make, case when p_size > 25 then 'Mazda' || (p_size - 25) || ' Cx-' || p_size else lower(p_type) || ' x' end as model,
        case when p_size <= 25 and lower(p_type) = split_part(p_name, ' ', 1) then split_part(p_name, ' ', 2) else p_name end as trim,
        case when split_part(p_name, ' ', 2) = 'bolt' then '4x4' else '4x4 bolt' end || ' Cab' as style,
        case p_type when 'SMALL' then 'Pickup' when 'LARGE' then 'Wagon' else p_type end as body_type from part""",
)
def _(t):
    rows = t.part.select(
        "p_partkey",
        F.col("p_brand").alias("make"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("MAZDA"), F.col("p_size") - 25, F.lit(" CX-"), F.col("p_size"))).otherwise(F.concat(F.lower("p_type"), F.lit(" x"))).alias("model"),
        F.col("p_name").alias("trim"),
        F.lit("4X4 bolt 5.5 ft. Cab").alias("style"),
        F.when(F.col("p_type") == "SMALL", "Chassis").when(F.col("p_type") == "LARGE", "Mini-Van").otherwise(F.col("p_type")).alias("body_type"),
    )
    return V.normalize_catalog(rows)


def _trunc_query(unit):
    query(f"date_trunc_{unit}", f"select event_id, date_trunc('{unit}', ts)::timestamp as start from events")(
        lambda t: t.events.select("event_id", P.period_start(F.col("ts"), unit).alias("start"))
    )


for _unit in ("day", "week", "month", "quarter", "year"):
    _trunc_query(_unit)


@query(
    "add_interval",
    """select o_orderkey, o_orderdate - interval 4320 minutes as minutes, o_orderdate + interval 5 hours as hours, o_orderdate + to_days(o_custkey::integer) as days,
       o_orderdate + interval 13 months as months from orders""",
)
def _(t):
    d = ts("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        P.add_minutes(d, -4320).alias("minutes"),
        P.add_hours(d, 5).alias("hours"),
        P.add_days(d, F.col("o_custkey").cast("int")).alias("days"),
        P.add_months(d, 13).alias("months"),
    )


@query("null_if_empty", "select p_partkey, nullif(replace(p_name, p_name, case when p_size > 25 then '' else p_name end), '') as value from part")
def _(t):
    return t.part.select("p_partkey", S.null_if_empty(F.when(F.col("p_size") > 25, "").otherwise(F.col("p_name"))).alias("value"))


@query("strip_spaces", "select p_partkey, replace(p_name, ' ', '') as value from part")
def _(t):
    return t.part.select("p_partkey", S.strip_spaces(F.col("p_name")).alias("value"))


@query("coalesce_default", "select o_orderkey, coalesce(c_nationkey, 0) as nation from orders left join customer on c_custkey = o_custkey and c_acctbal > 5000")
def _(t):
    rows = t.orders.join(t.customer.where("c_acctbal > 5000"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("o_orderkey", S.coalesce_default(F.col("c_nationkey")).alias("nation"))


@query(
    "array_functions",
    "select p_partkey, split_part(p_name, ' ', 1) as first, replace(p_name, ' ', '-') as joined, p_name like '% bolt' or p_name like 'bolt %' as has_bolt, true as any from part",
)
def _(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        S.array_first(words).alias("first"),
        S.array_joined(words).alias("joined"),
        S.array_has(words, "bolt").alias("has_bolt"),
        S.cardinality_ok(words).alias("any"),
    )


@query("json_array_length", "select p_partkey, (length(p_name) - length(replace(p_name, ' ', '')) + 1)::integer as n from part")
def _(t):
    return t.part.select("p_partkey", S.json_length(F.to_json(F.split("p_name", " "))).alias("n"))


@query("json_build_object", """select p_partkey, '{"size":' || p_size || ',"brand":"' || p_brand || '"}' as body, p_brand as brand from part""")
def _(t):
    body = S.json_object({"size": F.col("p_size"), "brand": F.col("p_brand")})
    return t.part.select("p_partkey", body.alias("body"), S.json_field(body, "brand").alias("brand"))


@query("arithmetic", "select p_partkey, round(power(2020 - (1970 + p_size) + 2, -0.06), 9) as factor, round(abs(p_retailprice - 1000) / 1000, 9) as gap from part")
def _(t):
    factor = S.age_factor(F.col("p_size") + 1970, F.lit("2020-06-01").cast("date"))
    return t.part.select("p_partkey", F.round(factor, 9).alias("factor"), F.round(S.relative_difference(F.col("p_retailprice"), F.lit(1000.0)), 9).alias("gap"))


@query("string_functions", "select p_partkey, length(p_name)::integer as n, lower(p_brand) as brand, contains(lower(p_name), lower(substr(p_type, 1, 1))) as has, p_brand || '/' || p_type as both from part")
def _(t):
    return t.part.select(
        "p_partkey",
        F.length("p_name").alias("n"),
        F.lower("p_brand").alias("brand"),
        S.contains_text(F.col("p_name"), F.substring("p_type", 1, 1)).alias("has"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("both"),
    )


@query("safe_parse_number", "select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as integer) as i, try_cast(split_part(o_orderpriority, '-', 2) as double) as d from orders")
def _(t):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", S.safe_int(parts[0]).alias("i"), S.safe_double(parts[1]).alias("d"))


@query(
    "parse_iso_instant",
    "select o_orderkey, o_orderdate as z, o_orderdate as utc, o_orderdate + interval 4 hours as offset_, o_orderdate as us, null::timestamp as bad from orders",
)
def _(t):
    d = F.col("o_orderdate")
    text = lambda fmt: F.date_format(d, fmt)
    return t.orders.select(
        "o_orderkey",
        S.parse_instant(text("yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("z"),
        S.parse_instant(text("yyyy-MM-dd'T'HH:mm:ss'+00:00'"), S.INSTANT_UTC_OFFSET).alias("utc"),
        S.parse_instant(text("yyyy-MM-dd'T'HH:mm:ss'-0400'"), S.INSTANT_ANY_OFFSET).alias("offset_"),
        S.parse_instant(text("MM/dd/yyyy"), S.DATE_US).alias("us"),
        S.parse_instant(text("dd.MM.yyyy")).alias("bad"),
    )


@query("strip_currency", "select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as varchar) as value from orders")
def _(t):
    return t.orders.select("o_orderkey", S.strip_currency(F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(18,2)"), F.lit("\n"))).alias("value"))


@query("interval_overdue", f"select script, case when epoch(timestamp '2001-06-30 12:00:00' - last_run) > days * 86400 then 1 else 0 end as is_overdue, case when status is not null and status <> 'success' then 1 else 0 end as bad_status from {JOBS_SQL} j")
def _(t):
    from forecourt.plans.health import job_alerts

    return job_alerts(jobs(t), F.lit("2001-06-30 12:00:00").cast("timestamp")).select("script", "is_overdue", "bad_status")


def _labels_query(name, spotlight):
    query(name, f"select o_orderkey as id, {labels_sql(spotlight)} as labels from orders")(
        lambda t: leads(t).select("id", F.array_join(labels_of(F.col, spotlight), "-").alias("labels"))
    )


_labels_query("lead_content_7", False)
_labels_query("lead_content_10", True)
