"""Named pipelines: leads, billing, inventory, catalog, price models, job health."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.functions.vehicle import clean_source_domain
from forecourt.operators.incremental import freshness_gate
from forecourt.operators.merge import register_session
from forecourt.plans import billing, catalog, health, inventory, leads as L, pricing
from forecourt.session import fresh_path, materialize
from forecourt.sources.files import read_text_table
from forecourt.standins.base import LEADS_SQL, LISTINGS_SQL, lead_flags, labelled, labels_sql, leads, listings, query
from forecourt.standins.latests import FILTER_SQL, raw_listings
from forecourt.standins.merges import JOBS_SQL, jobs
from forecourt.standins.payloads import _UUID_DUCK, _UUID_SPARK
from forecourt.standins.rollups import _OFF

# --- leads ----------------------------------------------------------------


def _settings(t):
    """Customers as integration settings: UUID ids, active while not in debt."""
    status = F.when(F.col("c_acctbal") >= 0, "active").otherwise("closed")
    body = F.struct(F.expr(_UUID_SPARK).alias("master_business_id"), status.alias("status"))
    return t.customer.select(F.lower(F.expr(_UUID_SPARK)).alias("id"), F.to_json(body).alias("payload"))


def _landed_leads(t):
    """Orders as landed leads whose payload names the customer's settings."""
    body = F.struct(
        F.expr(_UUID_SPARK).alias("integration_settings_id"),
        F.substring("o_orderpriority", 1, 1).alias("device"),
        *[c.cast("string").alias(k) for k, c in lead_flags().items()],
    )
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"), F.to_json(body).alias("payload"))


_BUSINESS_SQL = _UUID_DUCK.replace("c_custkey", "o_custkey")


@query(
    "lead_content_view",
    f"select o_orderkey as id, {_BUSINESS_SQL} as master_business_id, o_orderdate as created_at, substr(o_orderpriority, 1, 1) as device, {labels_sql(False)} as lead_content from orders",
)
def _(t):
    landed = materialize(_landed_leads(t), "leads"), materialize(_settings(t), "settings")
    return L.lead_content_view(*landed).withColumn("lead_content", F.array_join("lead_content", "-"))


@query("active_businesses", f"select {_UUID_DUCK} as master_business_id from customer where c_acctbal >= 0")
def _(t):
    return L.active_businesses(materialize(_settings(t), "settings"))


def _typed_leads(t):
    return leads(t).drop("master_business_id")


def _typed_settings(t):
    return t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("master_business_id"))


_LEAD_JOIN = f"{LEADS_SQL} l left join customer on c_custkey = integration_settings_id and c_acctbal >= 0"


@query("lead_details", f"select id, c_nationkey as master_business_id, created_at, device, sub_type, labels as lead_content from {_LEAD_JOIN}")
def _(t):
    out = L.lead_details(_typed_leads(t), _typed_settings(t))
    return out.select("id", "master_business_id", "created_at", "device", "sub_type", F.array_join("lead_content", "-").alias("lead_content"))


@query(
    "lead_details_materialized",
    f"select o_orderkey as id, n_nationkey as master_business_id, {labels_sql(False)} as lead_content from orders left join customer on c_custkey = o_custkey and c_acctbal >= 0 left join nation on n_nationkey = c_nationkey and n_regionkey > 1",
)
def _(t):
    known = t.nation.where("n_regionkey > 1").select(F.col("n_nationkey").alias("id"))
    out = L.lead_details_materialized(_typed_leads(t), _typed_settings(t), known)
    return out.select("id", "master_business_id", F.array_join("lead_content", "-").alias("lead_content"))


# Stored: last year's labels of old orders, all called 'unclassified'.
_STORED = "o_orderdate < timestamp '2000-01-01' and o_orderstatus = 'F'"


@query(
    "dashboard_lead_content",
    f"""with fresh as (select * from {_LEAD_JOIN} where (sub_type is null or sub_type = 'generic')
          and created_at >= (select max(o_orderdate) from orders where {_STORED}) - interval 3 days
          and created_at < date_trunc('day', (select max(o_orderdate) from orders))
          and id not in (select l_orderkey from lineitem where l_quantity = 50))
      select id, c_nationkey as master_business_id, created_at, device, labels as lead_content from fresh
      union all select o_orderkey, 0, o_orderdate, 'x', 'unclassified' from orders where {_STORED} and o_orderkey not in (select id from fresh)""",
)
def _(t):
    stored = t.orders.where("o_orderdate < timestamp_ntz'2000-01-01' and o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"),
        F.lit(0).alias("master_business_id"),
        F.col("o_custkey").alias("integration_settings_id"),
        F.col("o_orderdate").alias("created_at"),
        F.lit("x").alias("device"),
        F.array(F.lit("unclassified")).alias("lead_content"),
    )
    details = L.lead_details(_typed_leads(t), _typed_settings(t))
    excluded = t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("id"))
    out = L.dashboard_lead_content(details, stored, leads(t), excluded)
    return out.select("id", "master_business_id", "created_at", "device", F.array_join("lead_content", "-").alias("lead_content"))


_KINDS = {
    "last_credit_lead": "labels like '%credit%' or labels like '%finance%'",
    "last_trade_lead": "labels like '%trade%'",
    "last_testdrive_lead": "labels like '%testdrive%'",
    "last_insurance_lead": "labels like '%insurance%'",
    "last_payments_lead": "labels like '%payments%'",
}


# A business is a customer in one year, so that some have leads of one kind only.
def _single_type(name, fn, wanted):
    seen = ", ".join(f"max(case when {c} then created_at end) as {n}" for n, c in _KINDS.items())
    count = " + ".join(f"({n} is not null)::integer" for n in _KINDS)
    sql = f"""with s as (select master_business_id * 10000 + year(created_at) as id, {seen} from {LEADS_SQL} l group by 1),
      b as (select distinct o_custkey * 10000 + year(o_orderdate) as id, c_name, c_mktsegment, c_nationkey, c_acctbal from orders join customer on c_custkey = o_custkey)
      select c_name as name, c_mktsegment as website_url, id as master_business_id, cast(c_nationkey as varchar) as crm_id, c_mktsegment || '-suite' as subscriptions, {wanted}
      from b join s using (id) where c_acctbal >= 0 and c_mktsegment || '-suite' like '%UR%' and {wanted} is not null and {count} = 1"""

    def run(t):
        id_ = F.col("o_custkey") * 10000 + F.year("o_orderdate")
        rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).withColumn("id", id_)
        businesses = rows.select(
            "id",
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("website_url"),
            F.col("c_nationkey").cast("string").alias("crm_id"),
            F.concat("c_mktsegment", F.lit("-suite")).alias("subscriptions"),
        ).distinct()
        active = rows.where("c_acctbal >= 0").select(F.col("id").alias("master_business_id")).distinct()
        content = labelled(t).withColumn("master_business_id", F.col("master_business_id") * 10000 + F.year("created_at"))
        return fn(businesses, content, active, "UR")

    query(name, sql)(run)


_single_type("trade_leads_only", L.trade_leads_only, "last_trade_lead")
_single_type("credit_leads_only", L.credit_leads_only, "last_credit_lead")

# --- billing --------------------------------------------------------------

# Events as invoice items: view = suite, error = reviews, the others discounts
# applied to the first item of the same user; users are invoices.
_PRODUCTS = {"suite": "Suite", "suite_proration": "Suite -- Proration", "reviews": "Reviews"}
_CHARGE_SQL = """case when event_type = 'view' then case when value > 50 then 'Suite' else 'Suite -- Proration' end when event_type = 'error' then 'Reviews'
  when event_type = 'click' then 'Discount' when event_type = 'signup' then 'DSP Discount' else case when value > 10 then 'SaaS Discount' else 'Held Billing Discount' end end"""
_APPLIED_SQL = "case when event_type in ('click', 'signup', 'purchase') then cast(cast(json_extract_string(props, '$.k') as integer) * 7 as varchar) end"


def _charge():
    kind, value = F.col("event_type"), F.col("value")
    return (
        F.when((kind == "view") & (value > 50), "Suite")
        .when(kind == "view", "Suite -- Proration")
        .when(kind == "error", "Reviews")
        .when(kind == "click", "Discount")
        .when(kind == "signup", "DSP Discount")
        .when(value > 10, "SaaS Discount")
        .otherwise("Held Billing Discount")
    )


def _invoice_items(t):
    applied = F.when(F.col("event_type").isin("click", "signup", "purchase"), (F.get_json_object("props", "$.k").cast("int") * 7).cast("string"))
    return t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("invoiceid"),
        F.col("user_id").cast("string").alias("subscriptionid"),
        _charge().alias("chargename"),
        F.when(F.col("value") > 5, F.col("value").cast("decimal(38,9)")).otherwise(0).cast("decimal(38,9)").alias("chargeamount"),
        F.col("ts").alias("servicestartdate"),
        applied.alias("appliedtoinvoiceitemid"),
        F.lit("4000").alias("accountingcode"),
        F.lit(1).alias("quantity"),
    )


def _invoices(t):
    status = F.when(F.col("c_mktsegment") == "FURNITURE", "Draft").otherwise("Posted")
    return t.customer.select(F.col("c_custkey").cast("string").alias("id"), status.alias("status"), (F.col("c_acctbal") < 0).alias("reversed"))


def _subscriptions(t):
    return t.customer.where("c_nationkey > 3").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").cast("string").alias("creatoraccountid"))


def _accounts(t):
    return t.nation.where("n_regionkey < 4").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("accountnumber"))


_ITEM_SQL = f"""(select cast(event_id as varchar) as id, user_id, {_CHARGE_SQL} as chargename, case when value > 5 then cast(value as decimal(18,2)) else 0 end as chargeamount,
  date_trunc('month', ts)::timestamp as month, {_APPLIED_SQL} as applied from events)"""
_POSTED_SQL = "join customer on c_custkey = user_id and c_mktsegment <> 'FURNITURE' and not (c_acctbal < 0)"


@query(
    "billings_monthly",
    f"""select n_name as master_business_id, case when c_nationkey > 3 then cast(c_custkey as varchar) end as subscriptionid, month as date, '4000' as accountingcode, chargename, chargeamount::double as chargeamount, 1 as quantity
        from {_ITEM_SQL} i {_POSTED_SQL} left join nation on n_nationkey = c_nationkey and c_nationkey > 3 and n_regionkey < 4 where chargeamount <> 0""",
)
def _(t):
    return billing.billings_monthly(_invoice_items(t), _invoices(t), _subscriptions(t), _accounts(t))


def _saas_sql():
    # The four self joins, stated one by one.
    names = {"c": "discount", "d": "dsp_discount", "s": "saas_discount", "h": "held_billing_discount"}
    joins = " ".join(f"left join i {a} on {a}.applied = b.id and {a}.chargename = '{billing.DISCOUNTS[n]}'" for a, n in names.items())
    values = ", ".join(f"coalesce({a}.chargeamount, 0) as {n}" for a, n in names.items())
    sums = [f"sum(case when chargename = '{c}' then {v} else 0 end)::double as {k}_{s}" for s, v in {"price": "chargeamount", **{n: n for n in names.values()}}.items() for k, c in _PRODUCTS.items()]
    return f"""with i as {_ITEM_SQL}, x as (select case when c_nationkey > 3 then cast(c_nationkey as varchar) end as accountid, cast(b.user_id as varchar) as subscriptionid, b.month as servicestartdate, b.chargename, b.chargeamount, {values}
      from i b {_POSTED_SQL.replace('user_id', 'b.user_id')} {joins} where b.chargename in ('Suite', 'Suite -- Proration', 'Reviews'))
      select accountid, subscriptionid, servicestartdate, {', '.join(sums)} from x group by 1, 2, 3"""


@query("saas_revenue_monthly", _saas_sql())
def _(t):
    return billing.saas_revenue_monthly(_invoice_items(t), _invoices(t), _subscriptions(t), _PRODUCTS)


# Items with nine decimals: each event is one, and applies to the event a few before it, so that several
# discounts of a kind meet one item.
_EXACT = "cast(concat(cast(event_id % 50 + 1 as {text}), '.', lpad(cast((event_id * 7919) % 1000000000 as {text}), 9, '0')) as decimal({precision}))"
_EXACT_TO = "case when event_id % 4 <> 0 then cast(event_id - event_id % 8 as {text}) end"
_EXACT_NAME = "case event_id % 8 when 0 then 'Suite' when 4 then 'Reviews' when 1 then 'Discount' when 2 then 'DSP Discount' when 3 then 'SaaS Discount' when 5 then 'Discount' else 'Held Billing Discount' end"


def _exact_sql():
    kinds = {k: f"sum(case when chargename = '{v}' then chargeamount end) as {k}, greatest(count(*) filter (chargename = '{v}'), 1) as {k}_n" for k, v in billing.DISCOUNTS.items()}
    items = f"""(select cast(event_id as varchar) as id, user_id, {_EXACT_NAME} as chargename, {_EXACT.format(text='varchar', precision='18, 9')} as chargeamount,
      {_EXACT_TO.format(text='varchar')} as applied, date_trunc('month', ts)::timestamp as month from events)"""
    copies = lambda *skip: " * ".join(f"coalesce({k}_n, 1)" for k in billing.DISCOUNTS if k not in skip)
    money = {"price": f"chargeamount * cast({copies()} as decimal(9, 0))", **{k: f"coalesce({k}, 0) * cast({copies(k)} as decimal(9, 0))" for k in billing.DISCOUNTS}}
    sums = [f"cast(cast(sum(case when chargename = '{c}' then {e} else 0 end) as decimal(38, 9)) as varchar) as {p}_{m}" for m, e in money.items() for p, c in (("suite", "Suite"), ("reviews", "Reviews"))]
    return f"""with i as {items}, d as (select applied, {', '.join(kinds.values())} from i where applied is not null group by 1)
      select case when c_nationkey > 3 then cast(c_nationkey as varchar) end as accountid, cast(i.user_id as varchar) as subscriptionid, month as servicestartdate, {', '.join(sums)}
      from i {_POSTED_SQL.replace('user_id', 'i.user_id')} left join d on d.applied = i.id where i.chargename in ('Suite', 'Reviews') group by 1, 2, 3"""


@query("saas_revenue_exact", _exact_sql())
def _(t):
    items = t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("invoiceid"),
        F.col("user_id").cast("string").alias("subscriptionid"),
        F.expr(_EXACT_NAME).alias("chargename"),
        F.expr(_EXACT.format(text="string", precision="38, 9")).alias("chargeamount"),
        F.col("ts").alias("servicestartdate"),
        F.expr(_EXACT_TO.format(text="string")).alias("appliedtoinvoiceitemid"),
    )
    out = billing.saas_revenue_monthly(items, _invoices(t), _subscriptions(t), {"suite": "Suite", "reviews": "Reviews"})
    return out.select(*[F.col(f.name).cast("string") if f.dataType.typeName() == "decimal" else f.name for f in out.schema.fields])


# --- inventory ------------------------------------------------------------


@query("dealers_new", f"select dealer_id, domain, min(status_date) as first_seen, max(status_date) as last_seen from {LISTINGS_SQL} l group by 1, 2")
def _(t):
    return inventory.dealers(listings(t))


@query("dealers_used", f"select dealer_id, domain, min(status_date) as first_seen, max(status_date) as last_seen from {LISTINGS_SQL} l where miles >= 10000 group by 1, 2")
def _(t):
    return inventory.dealers(listings(t).where("miles >= 10000"))


# Pages are businesses with their url as website; the hosts of all pages, and
# their parent domains, are dealer domains, a dealer per page.
_HOST_SQL = "regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^(www|promos|en|fr|vehicles|landing|m|offres|promotions)\\.', '')"
_DOMAINS_SQL = f"""(select page_id as dealer_id, {_HOST_SQL} as domain, timestamp '2020-01-01' + to_days(length(html)::integer) as last_seen from pages
  union all select page_id + 100000, regexp_replace({_HOST_SQL}, '^[^.]+\\.', ''), timestamp '2020-01-01' + to_days(length(url)::integer) from pages)"""


def _dealer_domains(t):
    host = clean_source_domain(F.regexp_extract("url", "^https?://([^/]+)", 1))
    day = F.lit("2020-01-01").cast("timestamp")
    own = t.pages.select(F.col("page_id").alias("dealer_id"), host.alias("domain"), (day + F.make_dt_interval(days=F.length("html"))).alias("last_seen"))
    parent = F.regexp_replace(host, r"^[^.]+\.", "")
    up = t.pages.select((F.col("page_id") + 100000).alias("dealer_id"), parent.alias("domain"), (day + F.make_dt_interval(days=F.length("url"))).alias("last_seen"))
    return own.unionByName(up)


def _client_dealer_sql(html):
    return f"""(select master_business_id, dealer_id, last_seen from (select p.page_id as master_business_id, d.dealer_id, d.last_seen, rank() over (partition by p.page_id order by length(d.domain) desc) as r
      from pages p join (select distinct on (domain) dealer_id, domain, last_seen from {_DOMAINS_SQL} x order by domain, last_seen desc, dealer_id) d on contains(p.{html}, d.domain)) y where r = 1)"""


def _businesses(t, text):
    return t.pages.select(F.col("page_id").alias("id"), F.col(text).alias("website_url"))


@query("client_dealer_new", _client_dealer_sql("url"))
def _(t):
    return inventory.client_dealer(_businesses(t, "url"), _dealer_domains(t))


@query("client_dealer_used", f"select * from {_client_dealer_sql('url')} c where dealer_id < 100000")
def _(t):
    return inventory.client_dealer(_businesses(t, "url"), _dealer_domains(t)).where("dealer_id < 100000")


# Customers are the clients of the supplier with their nation's number.
_CLIENTS_SQL = "(select c_custkey as master_business_id, c_nationkey::bigint as dealer_id from customer)"


def _clients(t):
    return t.customer.select(F.col("c_custkey").alias("master_business_id"), F.col("c_nationkey").cast("bigint").alias("dealer_id"))


def _inventory_sql(days, where="true"):
    return f"""(select distinct on (master_business_id, dealer_id, vin) master_business_id, dealer_id, vin, status_date, price, miles
      from {_CLIENTS_SQL} c join {LISTINGS_SQL} l using (dealer_id) where {where} and status_date >= (select max(l_shipdate) from lineitem) - interval {days} days
      order by master_business_id, dealer_id, vin, status_date desc, price desc, miles desc)"""


def _inventory(t, days, where):
    rows = listings(t).where(where)
    return inventory.client_inventory(_clients(t), rows, t.lineitem.agg(F.max("l_shipdate")).scalar(), days)


_FRESH_SQL = "select master_business_id, vin, status_date from {inv} i where not exists (select 1 from {lst} l where {where} and l.dealer_id = i.dealer_id and l.vin = i.vin and l.status_date < i.status_date - interval 14 days)"
for _name, _where in {"new": "true", "used": "miles >= 10000"}.items():
    query(f"client_inventory_{_name}", f"select * from {_inventory_sql(7, _where)} i")(lambda t, w=_where: _inventory(t, 7, w))
    query(f"client_new_listings_{_name}", _FRESH_SQL.format(inv=_inventory_sql(700, _where), lst=LISTINGS_SQL, where=_where))(
        lambda t, w=_where: inventory.client_new_listings(_inventory(t, 700, w), listings(t).where(w))
    )


@query("inventory_gate", "select epoch((select max(l_shipdate) from lineitem) - (select max(l_shipdate) from lineitem where l_returnflag = 'R')) > 86400 as stale")
def _(t):
    return freshness_gate([t.lineitem], t.lineitem.where("l_returnflag = 'R'"), "l_shipdate")


# Parts as catalog: two variants of every pattern, except that wide patterns have two years.
_LOW_CATALOG_SQL = """(select p_partkey as vin_pattern, p_size as year, p_brand as make from part
  union all select p_partkey, case when p_name like 'small%' then p_size + 1 else p_size end, p_type from part)"""


def _low_catalog(t):
    a = t.part.select(F.col("p_partkey").alias("vin_pattern"), F.col("p_size").alias("year"), F.col("p_brand").alias("make"))
    year = F.when(F.col("p_name").startswith("small"), F.col("p_size") + 1).otherwise(F.col("p_size"))
    return a.unionByName(t.part.select(F.col("p_partkey").alias("vin_pattern"), year.alias("year"), F.col("p_type").alias("make")))


def _low_query(region, days):
    # Catalog rows per pattern of one model year, scrapes per pattern, their products per year and make, the newest
    # scrape of each car, and the mean of those per year and make.
    sql = f"""with cars as (select dealer_id as vin, taxonomy_vin as vin_pattern, miles, status_date from {LISTINGS_SQL} l
        where miles between 500 and 299999 and status_date >= (select max(l_shipdate) - interval {days} days from lineitem)),
      sold as {_LOW_CATALOG_SQL},
      kinds as (select vin_pattern, year, make, count(*) as rows_ from sold semi join (select vin_pattern from sold group by 1 having min(year) = max(year)) o using (vin_pattern) group by all),
      scrapes as (select vin_pattern, count(*) as n from cars group by 1),
      sizes as (select year, make from kinds join scrapes using (vin_pattern) group by all having sum(rows_ * n) >= 5),
      named as (select vin_pattern, min(struct_pack(y := year, m := make)) as first from kinds group by 1),
      newest as (select vin_pattern, vin, max(struct_pack(s := status_date, m := miles)) as top from cars group by all),
      met as (select vin_pattern, first.y as year, first.m as make, top.m as miles from newest join named using (vin_pattern)),
      means as (select year, make, trunc(avg(miles) * 0.9::double)::integer as mileage from met semi join sizes using (year, make) group by all)
      select distinct vin_pattern, '' as region, mileage from met join means using (year, make)"""

    def run(t):
        rows = listings(t).withColumn("vin", F.col("dealer_id"))
        return inventory.low_mileage(rows, _low_catalog(t), days, min_vehicles=5)

    query(f"low_mileage_{region}", sql)(run)
    return sql


# The last 300 and 100 days stand for 30 and 10: the test listings are thinner.
for _region, _days in inventory.LOW_MILEAGE_DAYS.items():
    _LOW_SQL = _low_query(_region, _days * 10)


@query("low_mileage_session", f"select *, (select max(n_nationkey) + 1 from nation)::bigint as session_id from ({_LOW_SQL}) x")
def _(t):
    """The last region's limits under a session that the run registers first."""
    known = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit("s").alias("schema"), F.lit("x").alias("script"), F.lit("{}").alias("payload"), F.lit(True).alias("validated"))
    run = register_session(known, F.lit("s"), F.lit("low_mileage"), F.lit("{}")).agg(F.max("id")).scalar()
    rows = listings(t).withColumn("vin", F.col("dealer_id"))
    return inventory.low_mileage(rows, _low_catalog(t), _days * 10, min_vehicles=5, session_id=run)


# --- catalog and price models --------------------------------------------

# Parts as catalog rows: two parts share a pattern; brands are makes.
_PATTERN = "cast(floor(p_partkey / 2) as {int})"
_CAT = {
    "vin_pattern": _PATTERN,
    "market": "case when p_size > 25 then 'CA' else 'US' end",
    "year": "p_size",
    "make": "p_brand",
    "model": "p_type",
    "trim": "case when p_size > 40 then 'ring' else p_name end",
    "style": "concat(p_name, ' ', p_type)",
    "body_type": "p_type",
    "msrp": "case when p_size > 3 then p_retailprice end",
}


def _cat(kind):
    return ", ".join(f"{e.replace('{int}', kind)} as {n}" for n, e in _CAT.items())


def _catalog(t):
    return t.part.selectExpr(*[f"{e.replace('{int}', 'bigint')} as {n}" for n, e in _CAT.items()])


_V = "year, make, model, trim, style"
# Body types per vehicle, the rows that are consistent, their mean price per pattern and market, trims per pattern.
_CLEAN_SQL = f"""(with parts as (select {_cat('bigint')} from part),
  bodies as (select {_V}, count(distinct body_type) as n from parts group by all),
  kept as (select parts.* from parts join bodies using ({_V}) where n = 1 or contains(style, body_type) or body_type = 'Wagon' and contains(style, 'Mini-Van')),
  means as (select vin_pattern, market, avg(msrp) as mean from kept group by all),
  trims as (select vin_pattern, count(distinct trim) as n from parts group by all)
  select vin_pattern, {_V}, body_type, msrp, mean as vin_pattern_market_avg, trims.n as vin_pattern_trims from kept join means using (vin_pattern, market) join trims using (vin_pattern))"""


@query("catalog_clean", f"select * replace (round(vin_pattern_market_avg, 4) as vin_pattern_market_avg) from {_CLEAN_SQL} c")
def _(t):
    out = catalog.catalog_clean(_catalog(t))
    return out.withColumn("vin_pattern_market_avg", F.round("vin_pattern_market_avg", 4))


def _one_listing(t):
    """One row per VIN: a line item is a car whose pattern is that of its part."""
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("vin"),
        F.floor(F.col("l_partkey") / 2).cast("bigint").alias("taxonomy_vin"),
        F.when(F.col("l_returnflag") == "R", "ring").when(F.col("l_returnflag") == "A", "BOLT").alias("trim_orig"),
        (F.col("l_quantity") * 1000).alias("miles"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("status_date"),
    )


_ONE_SQL = """(select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as vin, cast(floor(l_partkey / 2) as bigint) as taxonomy_vin,
  case l_returnflag when 'R' then 'ring' when 'A' then 'BOLT' end as trim_orig, l_quantity * 1000 as miles, l_extendedprice as price, l_shipdate as status_date from lineitem)"""
# Cars met with the vehicles of their pattern; the vehicles' sizes, and for each of their days how many cars are newer.
_TRAIN_SQL = f"""(with cars as {_ONE_SQL}, sold as (select *, vin_pattern_market_avg as mean from {_CLEAN_SQL} v),
  met as (select distinct vin, {_V}, body_type, round(mean, 4) as msrp, miles as mileage, price, status_date from cars join sold on vin_pattern = taxonomy_vin
    where contains(lower(trim), lower(trim_orig)) or vin_pattern_trims = 1 or mean > 0 and abs(msrp - mean) < 0.05 * mean),
  days as (select {_V}, status_date, count(*) as n from met group by all),
  places as (select {_V}, status_date, sum(n) over whole_ as vehicles, sum(n) over from_newest - n + 1 as rank from days
    window whole_ as (partition by {_V}), from_newest as (partition by {_V} order by status_date desc))
  select vin, {_V}, body_type, msrp, mileage, price, vehicles::bigint as vehicles, rank::integer as rank from met join places using ({_V}, status_date))"""


@query("training_set", f"select * from {_TRAIN_SQL} s")
def _(t):
    clean = materialize(catalog.catalog_clean(_catalog(t)), "catalog")
    return catalog.training_set(_one_listing(t), clean).withColumn("msrp", F.round("msrp", 4))


def _current_sql():
    price = "case when l_discount = 0.01 then l_quantity * 10000 else l_extendedprice end"
    rows = f"""select lpad(cast(l_partkey as varchar), 8, 'V') || 'X' || lpad(cast(l_suppkey as varchar), 8, 'W') as v, l_tax, l_quantity * 10000 as miles, {price} as price, l_shipdate as status_date, l_returnflag as body_type, l_linestatus as trim_orig, l_linenumber
      from lineitem where {FILTER_SQL['training']}"""
    return f"(select case when l_tax = 0 then 'SHORT' when l_tax = 0.01 then '' else v end as vin, miles, price, status_date, body_type, trim_orig from ({rows}) x)"


@query(
    "listing_current",
    f"""select vin, status_date from (select vin, status_date, row_number() over (partition by vin order by status_date desc) as rn from {_current_sql()} c) y where rn = 1 and vin is not null""",
)
def _(t):
    raw = raw_listings(t).withColumn("position", F.monotonically_increasing_id())
    rows = catalog.training_listings(raw).where("vin is not null")
    first = rows.where("trim_orig = 'F'").withColumn("file", F.lit("a"))
    second = rows.where("trim_orig = 'O'").withColumn("file", F.lit("b"))
    stored = catalog.merge_listing_file(first.drop("position").limit(0), first)
    return catalog.merge_listing_file(stored, second).select("vin", "status_date")


@query(
    "listing_price_points",
    f"""with c as {_current_sql()}, o as (select vin, miles, price, min(status_date) as status_date from c where trim_orig = 'F' group by 1, 2, 3), n as (select vin, miles, price, min(status_date) as status_date from c where trim_orig = 'O' group by 1, 2, 3)
      select coalesce(o.vin, n.vin) as vin, coalesce(o.miles, n.miles) as miles, coalesce(o.price, n.price) as price,
        case when n.vin is null or o.status_date > n.status_date then o.status_date else n.status_date end as status_date,
        case when n.vin is null or o.status_date > n.status_date then 'a' else 'b' end as file
      from o full join n on o.vin = n.vin and o.miles = n.miles and o.price = n.price""",
)
def _(t):
    rows = catalog.training_listings(raw_listings(t))
    first = rows.where("trim_orig = 'F'").select("vin", "miles", "price", "status_date", F.lit("a").alias("file"))
    second = rows.where("trim_orig = 'O'").select("vin", "miles", "price", "status_date", F.lit("b").alias("file"))
    stored = catalog.merge_price_points(first.limit(0), first)
    return catalog.merge_price_points(stored, second)


# Line items as training rows: year, make and model of the part; the price falls with
# the mileage for some brands and rises for others.
_SLOPE = "case when p_brand < 'Brand#18' then 30000 - l_quantity * 300 + l_discount * 10000 when p_brand < 'Brand#2' then l_extendedprice else 10000 + l_quantity * 100 + l_discount * 1000 end"
_MODEL = {
    "vin": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
    "year": "cast(floor(p_size / 10) as integer)",
    "make": "p_brand",
    "model": "p_type",
    "trim": "case when p_size > 25 then 'hi' else 'lo' end",
    "style": "case when p_name like '%bolt' then 'b' else 'c' end",
    "body_type": "p_type",
    "msrp": "case when p_size > 5 then p_retailprice * 20 end",
    "mileage": "l_quantity * 1000",
    "price": _SLOPE,
}
_ROWS_SQL = f"(select {', '.join(f'{e} as {n}' for n, e in _MODEL.items())} from lineitem join part on p_partkey = l_partkey)"


def _training(t):
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return rows.selectExpr(*[f"{e} as {n}" for n, e in _MODEL.items()])


_G = "year, make, model, trim, style"
def _flags_sql(rows):
    return f"(select *, coalesce(price > avg(price) over (partition by {_G}) * 3, false) as price_outlier, coalesce(msrp > 0 and price > msrp * 1.5, false) as msrp_outlier from {rows} r)"


_FLAGS_SQL = _flags_sql(_ROWS_SQL)


@query("price_outliers", f"select vin, price, price_outlier, msrp_outlier, coalesce(price / mileage > mean_ratio * 2, false) as ratio_outlier from (select *, avg(price / mileage) over (partition by {_G}) as mean_ratio from {_FLAGS_SQL} f) x")
def _(t):
    return pricing.price_outliers(_training(t), ratio=2.0).select("vin", "price", "price_outlier", "msrp_outlier", "ratio_outlier")


def _fit_sql(rows):
    return f"""(with f as {_flags_sql(rows)}, w as (select {_G}, count(*) as rows, avg(msrp) as msrp, min(body_type) as body_type from f group by all),
    k as (select {_G}, count(*) as size, coalesce(regr_slope(price, mileage), 0) as slope, coalesce(regr_intercept(price, mileage), avg(price)) as intercept, regr_r2(price, mileage) as r2 from f where not (price_outlier or msrp_outlier) group by all)
  select w.*, k.size, k.slope, k.intercept, k.r2,
    case when rows < 15 or coalesce(size, 0) < 15 then 1 when not (slope < 0) then 4 when intercept < 0 then 4 when -100000 * slope / intercept < 0.125 then 6 when -100000 * slope / intercept > 0.75 then 5 else 3 end as verdict
  from w left join k using ({_G}))"""


_FIT_SQL = _fit_sql(_ROWS_SQL)


@query("training_status", f"select vin, price, case when (price_outlier or msrp_outlier) and rows >= 15 then 2 else verdict end as status from {_FLAGS_SQL} f join {_FIT_SQL} g using ({_G})")
def _(t):
    return pricing.training_status(_training(t)).select("vin", "price", "status")


_RECORD_SQL = "slope, intercept, r2, size, body_type, msrp, mae, mse, observed, predicted, lo, hi"


def _models_sql(rows=_ROWS_SQL):
    def tier(n, on, measured=True):
        test = "o.msrp between w.msrp - w.msrp * 0.05 and w.msrp + w.msrp * 0.05" if measured else "w.msrp is null"
        key = "w.year as wy, w.make as wmk, w.model as wmd, w.trim as wt, w.style as ws"
        return f"select {key}, {n} as tier, {'abs(o.msrp - w.msrp)' if measured else '0'} as diff, o.* from w join o on {on} and {test}"

    same = lambda *cols: " and ".join(f"o.{c} = w.{c}" for c in cols)
    tiers = [
        tier(1, same("year", "make", "model")),
        tier(2, same("year", "make", "body_type")),
        tier(3, "o.year = w.year - 1 and " + same("make", "model", "trim")),
        tier(5, same("year", "body_type")),
        tier(4, same("year", "make", "model", "trim"), False),
    ]
    return f"""(with fit as {_fit_sql(rows)}, o as (select * from fit where verdict = 3), w as (select * from fit where verdict <> 3),
      e as (select {_G}, avg(abs(price - (intercept + slope * mileage))) as mae, avg(power(price - (intercept + slope * mileage), 2)) as mse,
        avg(price) as observed, avg(intercept + slope * mileage) as predicted, min(price) as lo, max(price) as hi from {_flags_sql(rows)} f join o using ({_G}) where not (price_outlier or msrp_outlier) group by all),
      c as ({' union all '.join(tiers)}), r as (select *, row_number() over (partition by wy, wmk, wmd, wt, ws order by tier, diff, year, make, model, trim, style) as rn from c)
      select {_G}, 0 as tier, {', '.join(f'null as match_{c.strip()}' for c in _G.split(','))}, {_RECORD_SQL} from o join e using ({_G})
      union all select wy, wmk, wmd, wt, ws, tier, {_G}, {_RECORD_SQL} from r join e using ({_G}) where rn = 1)"""


def _model_columns(rows):
    return f"""select {_G}, tier, match_year::integer as match_year, match_make, match_model, match_trim, match_style, round(slope, 6) as coefficient, round(intercept, 2) as intercept,
      round(r2, 6) as r2, size, body_type, round(msrp, 3) as msrp, round(mae, 3) as mean_absolute_error, round(mse / 1e6, 6) as mean_squared_error, round(observed + {_OFF}, 3) as mean_observed_list_price,
      round(predicted + {_OFF}, 3) as mean_predicted_list_price, lo as minimum_list_price, hi as maximum_list_price from {_models_sql(rows)} m"""


def _rounded_models(training):
    out = pricing.price_models(training)
    rounded = {"coefficient": 6, "intercept": 2, "r2": 6, "msrp": 3, "mean_absolute_error": 3, "mean_observed_list_price": 3, "mean_predicted_list_price": 3}
    for c in ("mean_observed_list_price", "mean_predicted_list_price"):  # off exact ties, as in the SQL
        out = out.withColumn(c, F.col(c) + _OFF)
    plain = [*catalog.VEHICLE, "tier", *[f"match_{c}" for c in catalog.VEHICLE], "size", "body_type", "minimum_list_price", "maximum_list_price"]
    squared = F.round(F.col("mean_squared_error") / 1e6, 6).alias("mean_squared_error")
    return out.select(*plain, squared, *[F.round(c, n).alias(c) for c, n in rounded.items()])


@query("price_models", _model_columns(_ROWS_SQL))
def _(t):
    return _rounded_models(materialize(_training(t), "training"))


# Parts of a brand and type as one catalog vehicle, matched to the line items by
# part; only the newest hundred listings of a vehicle, ties included, train it.
_TRAIN_CATALOG = {
    "vin_pattern": "p_partkey",
    "market": "'CA'",
    "year": "cast(floor(p_size / 25) as integer)",
    "make": "p_brand",
    "model": "p_type",
    "trim": "'base'",
    "style": "p_type",
    "body_type": "p_type",
    "msrp": "case when p_size > 5 then p_retailprice * 20 end",
}
_TRAIN_LISTING = {
    "vin": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)",
    "taxonomy_vin": "l_partkey",
    "trim_orig": "l_returnflag",
    "miles": "l_quantity * 1000",
    "price": "30000 - l_quantity * 100 + l_discount * 10000",
    "status_date": "l_shipdate",
}
_NEWEST_SQL = f"""(select * from (select l.*, p_partkey, c.year, c.make, c.model, c.trim, c.style, c.body_type, c.msrp, l.miles as mileage,
    rank() over (partition by c.year, c.make, c.model, c.trim, c.style order by status_date desc) as rank
  from (select {', '.join(f'{e} as {n}' for n, e in _TRAIN_LISTING.items())} from lineitem) l join (select p_partkey, {', '.join(f'{e} as {n}' for n, e in _TRAIN_CATALOG.items())} from part) c on c.vin_pattern = l.taxonomy_vin) x where rank <= 100)"""


@query("price_models_trained", _model_columns(_NEWEST_SQL))
def _(t):
    listed = t.lineitem.selectExpr(*[f"{e} as {n}" for n, e in _TRAIN_LISTING.items()])
    rows = t.part.selectExpr(*[f"{e} as {n}" for n, e in _TRAIN_CATALOG.items()])
    return _rounded_models(pricing.training_rows(listed, rows))


@query("price_models_session", f"select session_id, count(*) as models from (select (select max(n_nationkey) + 1 from nation)::bigint as session_id, tier from {_models_sql()} m) x group by 1")
def _(t):
    """A run registers its session and names it in every row."""
    known = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit("s").alias("schema"), F.lit("x").alias("script"), F.lit("{}").alias("payload"), F.lit(True).alias("validated"))
    run = register_session(known, F.lit("s"), F.lit("models"), F.lit("{}")).agg(F.max("id")).scalar()
    out = pricing.price_models(materialize(_training(t), "training"), run)
    return out.groupBy("session_id").agg(F.count("*").alias("models"))


@query(
    "catalog_typed",
    """select p_partkey::varchar as vin_pattern, p_partkey::integer as vehicle_id, 'CA' as market, (1990 + p_size)::integer as year, p_brand as make, p_type as model, p_name as trim, p_type as style, p_type as body_type,
       case when p_size % 2 = 0 then p_retailprice end as msrp from part where 1990 + p_size >= 2000""",
)
def _(t):
    """A catalog file, read and typed; rows of vehicles over twenty years old go."""
    path = fresh_path(t.spark, "catalog")
    row = {
        "VIN_PATTERN": "p_partkey", "VEHICLE_ID": "p_partkey", "MARKET": "'CA'", "YEAR": "1990 + p_size", "MAKE": "p_brand", "MODEL": "p_type", "TRIM": "p_name", "STYLE": "p_type", "BODY_TYPE": "p_type",
        "MSRP": "case when p_size % 2 = 0 then p_retailprice end",
    }
    t.part.selectExpr(*[f"{e} as {n}" for n, e in row.items()]).write.options(header=True, sep="\t", compression="gzip").csv(path)
    return catalog.typed_catalog(read_text_table(t.spark, path, "\t"), F.lit(2020))


def _published(t):
    return pricing.price_models(materialize(_training(t), "training")).withColumn("session_id", F.col("year").cast("bigint"))


_VIEW_SQL = """select year::bigint as session_id, 0 as vehicle_id, round(intercept, 2) as list_price_intercept, -2500.0::double as trade_value_intercept, {year}::integer as year, {make} as make, size::integer as vehicles,
  0.9::double as multiplier, round(power(2020 - {year} + 2, -0.06), 9) as factor from {models} m"""


def _view(df):
    factor = F.get_json_object("trade_value_coefficients", "$.estimated_list_price").cast("double")
    return df.select("session_id", "vehicle_id", F.round("list_price_intercept", 2).alias("list_price_intercept"), "trade_value_intercept", "year", "make", "vehicles", "multiplier", F.round(factor, 9).alias("factor"))


def _as_of():
    return F.lit("2020-06-01").cast("date")


@query("models", _VIEW_SQL.format(year="year", make="make", models=_models_sql()))
def _(t):
    return _view(pricing.models_view(_published(t), _as_of()))


@query("models_as_shipped", _VIEW_SQL.format(year="coalesce(match_year, year)", make="coalesce(match_make, make)", models=_models_sql()))
def _(t):
    return _view(pricing.models_view(_published(t), _as_of(), as_shipped=True))


_COMPLETE_SQL = f"""select year::bigint as session_id, 0 as vehicle_id, round(intercept, 2) as list_price_intercept, round(slope, 6) as mileage, -2500.0::double as trade_value_intercept,
  round(power(2020 - year + 2, -0.06), 9) as factor, year::integer as year, make, model, trim, style, size::integer as vehicles, body_type, round(msrp, 2) as msrp, 0.9::double as multiplier,
  round(lo, 2) as minimum_list_price, round(hi, 2) as maximum_list_price, 0.0::double as minimum_mileage_threshold from {_models_sql()} m"""


@query("models_complete", _COMPLETE_SQL)
def _(t):
    """Every column of the published view, its two JSON texts by the number they hold."""
    view = pricing.models_view(_published(t), _as_of())
    of = lambda c, key: F.get_json_object(c, f"$.{key}").cast("double")
    numbers = {"list_price_coefficients": F.round(of("list_price_coefficients", "mileage"), 6).alias("mileage"), "trade_value_coefficients": F.round(of("trade_value_coefficients", "estimated_list_price"), 9).alias("factor")}
    places = {"list_price_intercept": 2, "msrp": 2, "minimum_list_price": 2, "maximum_list_price": 2}
    return view.select(*[numbers[c] if c in numbers else F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in view.columns])


@query("latest_models", _VIEW_SQL.format(year="year", make="make", models=_models_sql()) + " where year = (select max(n_nationkey) from nation where n_nationkey < 4)")
def _(t):
    sessions = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), (F.col("n_nationkey") < 4).alias("validated"))
    return _view(pricing.latest_models(_published(t), sessions, _as_of()))


# --- job health -----------------------------------------------------------


@query("job_alerts", f"select schema, script, epoch(timestamp '2001-06-30 12:00:00' - last_run)::bigint as seconds, case when epoch(timestamp '2001-06-30 12:00:00' - last_run) > days * 86400 then 1 else 0 end as is_overdue, case when status is not null and status <> 'success' then 1 else 0 end as bad_status from {JOBS_SQL} j")
def _(t):
    now = F.lit("2001-06-30 12:00:00").cast("timestamp")
    alerts = health.job_alerts(jobs(t), now)
    waited = F.unix_seconds(now) - F.unix_seconds(now - F.col("time_since_last_run"))
    return alerts.select("schema", "script", waited.alias("seconds"), "is_overdue", "bad_status")


@query("job_monitor", f"select script from {JOBS_SQL} j where status <> 'success' or last_update < last_run - to_days(days) or (last_run < timestamp '2001-06-30 12:00:00' - interval 6 hours and schema <> 'MACHINERY' and script <> 'monitor')")
def _(t):
    return health.job_monitor(jobs(t), F.lit("2001-06-30 12:00:00").cast("timestamp"), "MACHINERY", "monitor").select("script")


@query("duplicate_keys", "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return health.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("empty_arrays", "select p_partkey from part where p_name not like '%bolt%'")
def _(t):
    rows = t.part.withColumn("words", F.filter(F.split("p_name", " "), lambda w: w == "bolt"))
    return health.empty_arrays(rows, "words").select("p_partkey")
