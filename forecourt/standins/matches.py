"""Joins: lookups, tags, substrings, ranges, nearest match."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions import scalars as S
from forecourt.functions.vehicle import clean_source_domain
from forecourt.operators import joins as J
from forecourt.operators.spread import spread_join
from forecourt.standins.base import LEADS_SQL, labelled, query


@query(
    "join_left_equi",
    "select o_orderkey, c_name, n_name from orders left join customer on c_custkey = o_custkey and c_acctbal > 0 left join nation on n_nationkey = c_nationkey",
)
def _(t):
    rows = J.left_lookup(t.orders, t.customer.where("c_acctbal > 0"), "o_custkey", "c_custkey")
    return J.left_lookup(rows, t.nation, "c_nationkey", "n_nationkey").select("o_orderkey", "c_name", "n_name")


@query("join_inner_equi", "select l_orderkey, l_linenumber, l_partkey, p_brand, p_retailprice from lineitem join part on p_partkey = l_partkey")
def _(t):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return spread_join(rows, part, ["l_partkey"], salts=J.SALTS)


@query(
    "join_equi_residual",
    """select l_orderkey, l_partkey, l_linenumber, p_name from lineitem join part on p_partkey = l_partkey
       where p_size = 1 or (p_retailprice > 0 and abs(l_extendedprice / 50 - p_retailprice) / p_retailprice < 0.05) or contains(lower(p_name), lower(l_returnflag))""",
)
def _(t):
    near = (F.col("p_retailprice") > 0) & (S.relative_difference(F.col("l_extendedprice") / 50, F.col("p_retailprice")) < 0.05)
    on = (F.col("p_size") == 1) | near | S.contains_text(F.col("p_name"), F.col("l_returnflag"))
    rows = t.lineitem.join(t.part, (F.col("p_partkey") == F.col("l_partkey")) & on)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "p_name")


# Events as items: a purchase is a base item, clicks and signups by the same
# user number are applied to it.
_ITEMS_SQL = """(select cast(event_id as varchar) as id, case when event_type in ('click', 'signup') then cast(user_id as varchar) end as applied,
  event_type as kind, value from events)"""


def _items(t):
    applied = F.when(F.col("event_type").isin("click", "signup"), F.col("user_id").cast("string"))
    return t.events.select(F.col("event_id").cast("string").alias("id"), applied.alias("applied"), F.col("event_type").alias("kind"), "value")


@query(
    "join_self_by_tag",
    f"""with i as {_ITEMS_SQL} select a.id, c.value as click, d.value as signup from i a
       left join i c on c.applied = a.id and c.kind = 'click' left join i d on d.applied = a.id and d.kind = 'signup' where a.kind = 'purchase'""",
)
def _(t):
    tags = {"click": "click", "signup": "signup"}
    return J.tagged_self_join(_items(t), F.col("kind") == "purchase", "id", "applied", "kind", "value", tags).select("id", *tags)


@query(
    "join_self_by_tag_pivot",
    f"select applied as id, round(sum(value) filter (kind = 'click'), 4) as click, count(*) filter (kind = 'click') as click_n, round(sum(value) filter (kind = 'signup'), 4) as signup, count(*) filter (kind = 'signup') as signup_n from {_ITEMS_SQL} i where applied is not null group by 1",
)
def _(t):
    out = J.tagged_totals(_items(t), "applied", "kind", "value", {"click": "click", "signup": "signup"})
    return out.select(F.col("_to").alias("id"), *[F.round(c, 4).alias(c) if c in ("click", "signup") else F.col(c) for c in out.columns if c != "_to"])


def _host(t):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return t.pages.select("page_id", "url", host.alias("host"))


@query(
    "join_substring",
    """with d as (select distinct regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^(www|promos|en|fr|vehicles|landing|m|offres|promotions)\\.', '') as domain from pages)
       select page_id, domain from pages join d on contains(url, domain)""",
)
def _(t):
    domains = _host(t).select(clean_source_domain(F.col("host")).alias("domain")).distinct()
    return J.substring_join(t.pages.select("page_id", "url"), "url", domains, "domain").select("page_id", "domain")


@query("join_substring_documents", "select doc_id, item_id from documents d join benchmark b on contains(d.text, b.text)")
def _(t):
    """Documents that hold a benchmark item whole."""
    items = t.benchmark.select("item_id", F.col("text").alias("item"))
    return J.substring_join(t.documents.select("doc_id", "text"), "text", items, "item").select("doc_id", "item_id")


@query("join_semi", "select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def _(t):
    active = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(active, ["o_custkey"], "left_semi").select("o_orderkey")


@query(
    "join_anti_range",
    """select l_orderkey, l_suppkey, l_partkey, l_shipdate from lineitem a where not exists
       (select 1 from lineitem b where b.l_suppkey = a.l_suppkey and b.l_partkey = a.l_partkey and b.l_shipdate < a.l_shipdate - interval 14 days)""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey", "l_shipdate")
    return J.not_seen_before(rows, t.lineitem, ["l_suppkey", "l_partkey"], "l_shipdate", 14)


@query("join_not_in_having", "select p_partkey, p_name from part where p_name not in (select p_name from part group by 1 having count(distinct p_type) > 5)")
def _(t):
    few = t.part.groupBy("p_name").agg(F.countDistinct("p_type").alias("n")).where("n > 5").select("p_name")
    return t.part.select("p_partkey", "p_name").join(few, ["p_name"], "left_anti")


@query("drop_ambiguous", "select o_orderkey, o_custkey from orders where o_custkey not in (select o_custkey from orders group by 1 having count(distinct o_orderpriority) > 1)")
def _(t):
    return J.drop_ambiguous(t.orders, t.orders, "o_custkey", "o_orderpriority").select("o_orderkey", "o_custkey")


@query(
    "join_array_contains",
    f"select c_custkey, max(created_at) as last_trade from customer left join {LEADS_SQL} l on master_business_id = c_custkey and labels like '%trade%' group by 1",
)
def _(t):
    seen = J.last_seen_by_label(labelled(t), "master_business_id", "lead_content", "created_at", {"last_trade": ("trade",)})
    return t.customer.join(seen, F.col("c_custkey") == F.col("master_business_id"), "left").select("c_custkey", "last_trade")


@query("join_scalar_latest", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_suppkey = (select l_suppkey from lineitem order by l_shipdate desc, l_suppkey desc limit 1)")
def _(t):
    return J.at_latest_version(t.lineitem, t.lineitem, "l_suppkey", "l_shipdate").select("l_orderkey", "l_linenumber", "l_partkey")


@query("join_correlated_count_distinct", "select l_orderkey, l_linenumber, l_partkey, n from lineitem join (select l_suppkey, count(distinct l_partkey) as n from lineitem group by 1) c using (l_suppkey)")
def _(t):
    rows = J.distinct_per_group(t.lineitem, ["l_suppkey"], "l_partkey", "n")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "n")


# Parts as vehicle groups: the cheap half of each brand asks, the rest offers.
_KEY = ("year", "make", "model", "trim", "style")
_GROUP_COLS = {
    "year": "p_size",
    "make": "substring(p_brand, 1, 7)",
    "model": "p_type",
    "trim": "p_name",
    "style": "cast(p_partkey as {text})",
    "body_type": "p_brand",
    "msrp": "case when p_partkey < 100 then null else p_retailprice end",
}


def _groups_cte(text):
    return ", ".join(f"{e.replace('{text}', text)} as {n}" for n, e in _GROUP_COLS.items())


_WANTED, _OFFERED = "p_brand in ('Brand#1', 'Brand#2', 'Brand#12') or p_name like 'hot%'", "not (p_brand in ('Brand#1', 'Brand#2', 'Brand#12') or p_name like 'hot%')"
_NEAR = "o.msrp between w.msrp - w.msrp * 0.05 and w.msrp + w.msrp * 0.05"
_O_KEY = "(o.year, o.make, o.model, o.trim, o.style)"


def _tier(n: int, on: str, measured: bool) -> str:
    diff = "abs(o.msrp - w.msrp)" if measured else "0"
    test = _NEAR if measured else "w.msrp is null"
    return f"select w.style as want, {n} as tier, {diff} as diff, o.* from w join o on {on} and {test}"


@query(
    "match_nearest_tiered",
    f"""with w as (select {_groups_cte('varchar')} from part where {_WANTED}), o as (select {_groups_cte('varchar')} from part where {_OFFERED}),
      c as ({_tier(1, 'o.year = w.year and o.make = w.make and o.model = w.model', True)}
        union all {_tier(2, 'o.year = w.year and o.make = w.make and o.body_type = w.body_type', True)}
        union all {_tier(3, 'o.year = w.year - 1 and o.make = w.make and o.model = w.model and o.trim = w.trim', True)}
        union all {_tier(5, 'o.year = w.year and o.body_type = w.body_type', True)}
        union all {_tier(4, 'o.year = w.year and o.make = w.make and o.model = w.model and o.trim = w.trim', False)}),
      r as (select *, row_number() over (partition by want order by tier, diff, year, make, model, trim, style) as rn from c)
      select want as style, tier, style as match_style from r where rn = 1""",
)
def _(t):
    def groups(where):
        return t.part.where(where).selectExpr(*[f"{e.replace('{text}', 'string')} as {n}" for n, e in _GROUP_COLS.items()])

    return J.match_tiered(groups(_WANTED), groups(_OFFERED), _KEY).select("style", "tier", "match_style")
