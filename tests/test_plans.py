import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from forecourt.functions.payload import typed_view
from forecourt.operators.joins import not_seen_before
from forecourt.operators.spread import with_group_stats
from forecourt.plans import billing, catalog, health, impressions, inventory, leads as L, pricing
from forecourt.plans.specs import view_spec
from forecourt.session import setting
from forecourt.sources import sinks as K
from forecourt.standins import QUERIES

SF = "/root/testdata/sf0.001"
TRAIN = "vin string, year int, make string, model string, trim string, style string, body_type string, msrp double, mileage double, price double"


def group(name, n, price, msrp=40000.0, style="s"):
    return [(f"{name}-{i}", 2020, "Make", name, "t", style, "SUV", msrp, 1000.0 * (i + 1), float(price(1000.0 * (i + 1)))) for i in range(n)]


def test_training_status_and_models(spark):
    rows = (
        group("few", 14, lambda m: 20000 - m / 10)
        + group("good", 20, lambda m: 20000 - m / 10)
        + group("rising", 20, lambda m: 20000 + m)
        + group("negative", 20, lambda m: -5000 - m / 10)
        + group("slow", 20, lambda m: 20000 - m / 100)
        + group("fast", 20, lambda m: 20000 - m / 2)
        + [(f"out-{i}", 2020, "Make", "out", "t", "s", "SUV", 40000.0, 1000.0 * (i + 1), 90000.0 if i < 6 else 20000.0 - 100 * i) for i in range(20)]
        + group("constant", 20, lambda m: 20000.0)
        + [("bare", 2020, "Make", None, "t", "s", "SUV", None, 1.0, 1.0)]
    )
    df = spark.createDataFrame(rows, TRAIN)
    got = {}
    for r in pricing.training_status(df).collect():
        got.setdefault(r.model, set()).add(r.status)
    # Prices below zero all exceed three times their mean.
    assert got == {"few": {1}, "good": {3}, "rising": {4}, "negative": {2}, "slow": {6}, "fast": {5}, "out": {2, 1}, "constant": {4}, None: {None}}
    models = {r.model: r for r in pricing.price_models(df).collect()}
    assert models["good"].tier == 0 and abs(models["good"].coefficient + 0.1) < 1e-9 and abs(models["good"].intercept - 20000) < 1e-6
    assert models["good"].size == 20 and models["good"].maximum_list_price == 19900.0
    # The others have the same year, make, body type and msrp, so they borrow the good model in tier 2.
    assert {m: models[m].tier for m in ("few", "slow", "fast")} == {"few": 2, "slow": 2, "fast": 2}
    assert models["slow"].match_model == "good" and models["slow"].intercept == models["good"].intercept
    view = pricing.models_view(pricing.price_models(df).withColumn("session_id", F.lit(1)), F.lit("2024-01-01").cast("date"))
    assert {r.model for r in view.collect()} == set(models)
    shipped = pricing.models_view(pricing.price_models(df).withColumn("session_id", F.lit(1)), F.lit("2024-01-01").cast("date"), as_shipped=True)
    assert {r.model for r in shipped.collect()} == {"good"}


def test_zero_intercept_loses_without_bound(spark):
    df = spark.createDataFrame([(-1.0, 0.0), (-0.1, 20000.0)], "slope double, intercept double")
    assert [r[0] for r in df.select(pricing._loss()).collect()] == [float("inf"), 0.5]


def test_training_set_matches_once(spark):
    listings = spark.createDataFrame(
        [("v1", "P", "ring", 1.0, 2.0, datetime(2024, 1, 1)), ("v2", "P", None, 1.0, 2.0, datetime(2024, 1, 2)), ("v3", "Q", "zz", 1.0, 2.0, datetime(2024, 1, 2))],
        "vin string, taxonomy_vin string, trim_orig string, miles double, price double, status_date timestamp",
    )
    rows = [("P", 2020, "M", "m", t, "s", "SUV", msrp, "CA") for t, msrp in (("Ring Sport", 100.0), ("Base", 300.0), ("Ring Sport", 101.0))] + [("Q", 2020, "M", "m", "One", "s", "SUV", None, "CA")]
    cat = spark.createDataFrame(rows, "vin_pattern string, year int, make string, model string, trim string, style string, body_type string, msrp double, market string")
    got = sorted((r.vin, r.trim, r.vehicles, r.rank) for r in catalog.training_set(listings, catalog.catalog_clean(cat)).collect())
    assert got == [("v1", "Ring Sport", 1, 1), ("v3", "One", 1, 1)]


def test_saas_revenue_equals_row_by_row(spark):
    random.seed(1)
    names = ["Suite", "Reviews", "Discount", "DSP Discount", "SaaS Discount", "Held Billing Discount"]
    items = [(str(i), "i1", "s1", random.choice(names), float(random.randint(1, 9)), datetime(2024, 1, 5), str(random.randint(0, 5))) for i in range(60)]
    df = spark.createDataFrame(items, "id string, invoiceid string, subscriptionid string, chargename string, chargeamount double, servicestartdate timestamp, appliedtoinvoiceitemid string")
    df = df.withColumn("chargeamount", F.col("chargeamount").cast("decimal(38,9)"))
    invoices = spark.createDataFrame([("i1", "Posted", False)], "id string, status string, reversed boolean")
    subs = spark.createDataFrame([("s1", "a1")], "id string, creatoraccountid string")
    products = {"suite": "Suite", "reviews": "Reviews"}
    got = billing.saas_revenue_monthly(df, invoices, subs, products).first()
    from forecourt.operators.joins import tagged_self_join

    wide = tagged_self_join(df, F.col("chargename").isin(*products.values()), "id", "appliedtoinvoiceitemid", "chargename", "chargeamount", billing.DISCOUNTS).collect()
    for alias, name in products.items():
        mine = [r for r in wide if r.chargename == name]
        assert got[f"{alias}_price"] == sum(r.chargeamount for r in mine)
        for k in billing.DISCOUNTS:
            assert got[f"{alias}_{k}"] == sum(r[k] or 0 for r in mine)


def test_unique_impressions_resume_after_done(spark):
    feed = spark.createDataFrame([("b", datetime(2024, m, 3), ip) for m in (1, 2, 3) for ip in ("1", "2", "1")], "master_business_id string, happened_at timestamp, ip_address string")
    got = impressions.unique_impressions([feed, feed], "month").orderBy("date").collect()
    assert [(r.date.month, r.impressions) for r in got] == [(1, 2), (2, 2)]
    done = spark.createDataFrame([(datetime(2024, 1, 1),)], "date timestamp")
    assert [r.date.month for r in impressions.unique_impressions([feed], "month", done).collect()] == [2]
    u = "0A1B2C3D-0000-4000-8000-000000000001"
    raw = spark.createDataFrame([(datetime(2024, 1, 1), f'{{"master_business_id":"{x}","ip_address":"9"}}') for x in (u, "b")], "happened_at timestamp, payload string")
    assert [tuple(r) for r in impressions.visits(raw).collect()] == [(u.lower(), datetime(2024, 1, 1), "9"), (None, datetime(2024, 1, 1), "9")]


def test_lead_view_chain(spark):
    u = "0a1b2c3d-0000-4000-8000-00000000000"
    landed = spark.createDataFrame(
        [("l1", datetime(2024, 1, 1), datetime(2024, 1, 1), f'{{"integration_settings_id":"{u}1","is_trade":"1","is_credit_finance":"","device":"m"}}')], "id string, created_at timestamp, updated_at timestamp, payload string"
    )
    settings = spark.createDataFrame([(f"{u}1", f'{{"master_business_id":"{u}9","status":"active"}}')], "id string, payload string")
    details = L.lead_details(typed_view(landed, view_spec("v_marketplace_leads")), L.settings_view(settings))
    assert details.first().lead_content == ["trade"] and details.first().master_business_id == f"{u}9"
    assert L.active_businesses(settings).first()[0] == f"{u}9"
    assert L.lead_content_view(landed, settings).first().lead_content == ["trade"]


def test_daily_leads_sum_to_monthly(spark):
    total = lambda name: QUERIES[name](spark, SF).agg(F.sum("leads")).first()[0]
    assert total("master_leads_daily") == total("master_leads_monthly") == total("mixed_leads_lifetime") == 1500


def test_monitor_precedence(spark):
    jobs = spark.sql(
        """select 'op' schema, 'monitor' script, timestamp'2024-01-01' last_run, timestamp'2024-01-01' last_update, 'failed' status, interval '1' day frequency
           union all select 'op', 'monitor', timestamp'2024-01-01', timestamp'2024-01-01', 'success', interval '1' day
           union all select 'x', 'job', timestamp'2024-01-01', timestamp'2024-01-01', 'success', interval '1' day
           union all select 'x', 'new', null, null, null, interval '1' day"""
    )
    got = health.job_monitor(jobs, F.lit("2024-01-01 07:00:00").cast("timestamp"), "op", "monitor").collect()
    # The monitor itself is only excused from the idle test.
    assert sorted((r.script, r.status) for r in got) == [("job", "success"), ("monitor", "failed")]


@pytest.mark.parametrize("name", ["client_dealer_new", "join_substring", "client_new_listings_new", "match_nearest_tiered", "rank_recency_topn", "low_mileage_ca", "unique_impressions_monthly", "saas_revenue_monthly", "dashboard_lead_content"])
def test_core_plans_stay_distributed(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan, bad


def test_windows_push_down_to_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = QUERIES["high_water_window"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,ScalarSubquery" in plan and "LessThan(o_orderdate,2001-06-30" in plan


def _reads(df):
    """Scans of the plan as planned, before Spark reuses any."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


@pytest.mark.parametrize("name, most", [("client_dealer_new", 8), ("training_status", 4), ("upsert_newest", 2)])
def test_costly_inputs_are_planned_once(spark, name, most):
    assert _reads(QUERIES[name](spark, SF)) <= most


def test_training_set_runs_no_job_while_it_is_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    catalog.training_set(_no_listings(spark), catalog.catalog_clean(_no_catalog(spark)))
    jobs = tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_training_set_sends_a_match_once_and_without_names(spark, broadcast):
    """Vehicles of several patterns and body types, one of them hot; equal to ranks by hand, and matches are shuffled narrow."""
    cat = [(f"P{k}", 2020, "M", f"m{k // 2}", t, "Wagon SUV", b, 1.0, 100.0 + k, 2) for k in range(90) for t in ("Ring Sport", "Base") for b in ("SUV", "Wagon")[: 1 + k % 2]]
    cars = [(f"v{k}", "P0" if k % 3 else f"P{k % 89}", ["ring", "BASE", None, "s"][k % 4], float(k), 2.0, datetime(2024, 1, 1 + k % 7) if k % 11 else None) for k in range(1200)]
    met = [(v, *c[1:7], c[8], m, p, d) for v, at, t, m, p, d in cars for c in cat if c[0] == at and d and t and t.lower() in c[4].lower()]
    want = {}
    for row in met:
        same = [m[-1] for m in met if m[1:6] == row[1:6]]
        want[(*row[:-1], 1 + sum(d > row[-1] for d in same), len(same))] = 1
    listings = spark.createDataFrame(cars, "vin string, taxonomy_vin string, trim_orig string, miles double, price double, status_date timestamp")
    types = "vin_pattern string, year int, make string, model string, trim string, style string, body_type string, msrp double, vin_pattern_market_avg double, vin_pattern_trims long"
    clean = spark.createDataFrame([(*c[:7], 1.0, c[8], c[9]) for c in cat], types)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", broadcast):
        got = catalog.training_set(listings, clean)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
        assert sorted(tuple(r) for r in catalog.training_set(listings, clean, 5).collect()) == sorted(w for w in want if w[-2] <= 5)
        lines = got._jdf.queryExecution().executedPlan().toString().split("\n")
    sent = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning(" in line and "vin#" in below]
    assert sent and not any("style#" in below for below in sent)


def _no_listings(spark):
    return spark.range(3).selectExpr("cast(id as string) vin", "'P' taxonomy_vin", "'t' trim_orig", "1D miles", "2D price", "timestamp'2024-01-01' status_date")


def _no_catalog(spark):
    return spark.range(3).selectExpr("'P' vin_pattern", "2020 year", "'m' make", "'m' model", "'t' trim", "'s' style", "'b' body_type", "3D msrp", "'CA' market")


def test_hot_keys_split_or_salt(spark):
    """Two thirds of the rows on one key, no broadcast: the final plan splits the join or holds a salt."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(300_000).selectExpr("if(id % 3 = 0, id % 997, 1000) as k", "id as v", "timestamp'2024-01-01' as ts", "uuid() as u")
        stats = with_group_stats(rows, ["k"], F.avg("v").alias("m"))
        seen = not_seen_before(rows, rows.select("k", "ts"), ["k"], "ts", 3)
        for df in (stats, seen):
            df.agg(F.max("v"), F.max("u")).collect()
            big = df.agg(F.sum("v"), F.max("u"))
            big.collect()
            plan = big._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan or "_salt" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_amounts_keep_nine_decimals_or_fail(spark):
    item = "id string, invoiceid string, subscriptionid string, chargename string, chargeamount decimal(38,9), servicestartdate timestamp, appliedtoinvoiceitemid string"
    invoices = spark.createDataFrame([("i1", "Posted", False)], "id string, status string, reversed boolean")
    subs = spark.createDataFrame([("s1", "a1")], "id string, creatoraccountid string")

    def price(*amounts):
        rows = [(str(k), "i1", "s1", "Suite" if k == 0 else "Discount", Decimal(a), datetime(2024, 1, 5), "0" if k else None) for k, a in enumerate(amounts)]
        return billing.saas_revenue_monthly(spark.createDataFrame(rows, item), invoices, subs, {"suite": "Suite"}).first()

    assert price("1.123456789").suite_price == Decimal("1.123456789")
    three = price("1.123456789", "0.000000001", "0.000000002", "0.1")
    assert three.suite_price == Decimal("3.370370367") and three.suite_discount == Decimal("0.100000003")
    with pytest.raises(Exception, match="out of range"):
        price("12345678901234567890123456789")


def test_inventory_gate_and_dealers(spark):
    listings = spark.createDataFrame([(1, "a.ca", datetime(2024, 1, d)) for d in (3, 1, 2)], "dealer_id int, domain string, status_date timestamp")
    assert tuple(inventory.dealers(listings).first()) == (1, "a.ca", datetime(2024, 1, 1), datetime(2024, 1, 3))


def test_dashboard_tables_come_of_one_rollup(spark, rows):
    """Each table of the one aggregate equals the view counted on its own; a refresh swaps them, empty ones included."""
    at = datetime(2024, 1, 1)
    label = [["trade"], ["credit", "trade"], ["other"], [], None]
    content = spark.createDataFrame(
        [(f"b{k % 3}", at + timedelta(hours=37 * k) if k % 11 else None, [None, "phone", "tablet"][k % 3 if k % 2 else 1], label[k % 5]) for k in range(400)],
        "master_business_id string, created_at timestamp, device string, lead_content array<string>",
    )
    values = spark.createDataFrame([("trade", 100.5, 0.25), ("credit", 20.0, None)], "master_lead_type string, value double, conversion_rate double")
    want = {}
    for name in L.dashboard_columns():
        kind, period = name.removesuffix("_device").rsplit("_", 1)
        if kind.endswith("leads"):
            fn = L.master_leads if kind == "master_leads" else L.mixed_leads
            want[name] = fn(content, period, name.endswith("_device"))
        else:
            fn = L.estimated_revenue if kind == "estimated_revenue" else L.estimated_vehicles_sold
            want[name] = fn(content, values, {"lifetime": None, "monthly": "month", "quarterly": "quarter", "yearly": "year"}[period])
    tables = K.refresh_views(L.dashboard_rollup(content, values), L.dashboard_columns(), prefix="dash_")
    assert len(tables) == 21
    for name, table in tables.items():
        assert spark.table(table).columns == want[name].columns, name
        assert rows(spark.table(table)) == rows(want[name]), name
    K.refresh_views(L.dashboard_rollup(content.limit(0), values), L.dashboard_columns(), prefix="dash_")
    assert all(spark.table(t).count() == 0 for t in tables.values())
    plan = L.dashboard_rollup(content, values)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_view") == 1 and plan.count("Generate explode") == 1


def test_dashboard_groups_are_sent_once(spark):
    """Groups are whole where they are made and shuffled once, by their table, on the way to its files; as many tasks make them as the session names."""
    content = spark.range(300).selectExpr("concat('b', id % 9) master_business_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 40 as int)) created_at", "'d' device", "array('trade') lead_content")
    values = spark.createDataFrame([("trade", 100.5, 0.25)], "master_lead_type string, value double, conversion_rate double")
    rollup = L.dashboard_rollup(content, values)
    assert rollup.where("view = 'master_leads_lifetime'").agg(F.sum("leads")).first()[0] == 300
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode")
    assert above.count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_COL" in above and "REPARTITION_BY_NUM" in below


def test_amounts_of_very_many_discounts(spark):
    """Four kinds with hundreds of discounts each: more copies than nine digits count, and no decimal is lost."""
    items = spark.range(1200).selectExpr(
        "cast(id as string) id", "'i1' invoiceid", "'s1' subscriptionid", "case id % 4 when 0 then 'Discount' when 1 then 'DSP Discount' when 2 then 'SaaS Discount' else 'Held Billing Discount' end chargename",
        "cast(-0.000000007 as decimal(38,9)) chargeamount", "timestamp'2024-01-05' servicestartdate", "'base' appliedtoinvoiceitemid",
    )
    base = items.limit(1).selectExpr("'base' id", "invoiceid", "subscriptionid", "'Suite' chargename", "cast(12.345678901 as decimal(38,9)) chargeamount", "servicestartdate", "cast(null as string) appliedtoinvoiceitemid")
    invoices = spark.createDataFrame([("i1", "Posted", False)], "id string, status string, reversed boolean")
    subs = spark.createDataFrame([("s1", "a1")], "id string, creatoraccountid string")
    got = billing.saas_revenue_monthly(items.unionByName(base), invoices, subs, {"suite": "Suite"}).first()
    assert got.suite_price == Decimal("12.345678901") * 300**4
    assert got.suite_discount == got.suite_held_billing_discount == Decimal("-0.000000007") * 300**4
