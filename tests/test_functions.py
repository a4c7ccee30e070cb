from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forecourt.functions import labels, payload as P, periods, scalars as S, vehicle as V
from forecourt.plans.specs import VIEW_NAMES, view_spec


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_vin_pattern(spark):
    got = values(spark, [("1HGCM82633A004352",), ("SHORT",), (None,)], "v string", V.vin_pattern(F.col("v")))
    assert got == [("1HGCM8263A",), (None,), (None,)]
    with pytest.raises(Exception, match="Invalid VIN"):
        values(spark, [("SHORT",)], "v string", V.vin_pattern(F.col("v"), strict=True))


def test_domain_loses_one_label(spark):
    urls = ["WWW.m.dealer.ca", "en.dealer.ca", "dealer.ca", "promotions.x.ca", "wwwx.ca", "", None]
    got = values(spark, [(u,) for u in urls], "u string", V.clean_source_domain(F.col("u")))
    assert [g[0] for g in got] == ["m.dealer.ca", "dealer.ca", "dealer.ca", "x.ca", "wwwx.ca", None, None]


def test_body_type_falls_back_to_vehicle_type(spark):
    data = [("Crossover", "x"), ("Roadster", "Car"), ("Roadster", "boat"), ("mini mpv", None), (None, "Car")]
    got = values(spark, data, "b string, v string", V.normalize_body_type(F.col("b"), F.col("v")))
    assert [g[0] for g in got] == ["SUV", "Sedan", "Roadster", "Wagon", None]


def test_title_words_restart_after_any_non_letter(spark):
    got = values(spark, [("MX-ABC",), ("MAZDA3X",), ("CX 5 GT",)], "m string", V.title_words(F.col("m")))
    assert [g[0] for g in got] == ["Mx-Abc", "Mazda3X", "Cx 5 Gt"]


def test_catalog_wording(spark):
    data = [
        ("Toyota", "RAV4", "Adventure", "Adventure AWD 4X4", "SUV"),
        ("Ram", "Ram Pickup 1500", "Tradesman 1500", "Tradesman Crew 5.5 ft. Box", "Chassis"),
        ("Hyundai", "Veracruz", "GL", "GL Mini-Van", "Mini-Van"),
        ("Ford", "Transit", "", "  Van  XL", "Mini-Van"),
    ]
    df = spark.createDataFrame(data, "make string, model string, trim string, style string, body_type string")
    got = [tuple(r) for r in V.normalize_catalog(df).collect()]
    assert got == [
        ("Toyota", "RAV4", "Trail", "AWD 4x4", "SUV"),
        ("Ram", "1500", "Tradesman", "Crew Box", "Pickup"),
        ("Hyundai", "Veracruz", "GL", "Mini-Van", "SUV"),
        ("Ford", "Transit", "", "Van  XL", "Wagon"),
    ]


def test_labels_treat_null_as_off(spark):
    names = ["insurance", "trade", "partial", "verified", "finance", "ecom", "test", "spot"]
    data = [
        (0, 0, 0, 0, 0, 0, 0, 0),
        (1, 1, 1, 0, 0, 1, 1, 1),
        (0, 0, 1, 1, None, 0, 0, 0),
        (None, None, None, None, 1, None, None, None),
    ]
    cols = [F.col(n) for n in names]
    schema = ", ".join(f"{n} int" for n in names)
    got = values(spark, data, schema, labels.lead_labels(*cols), labels.lead_labels(*cols[:-1]))
    assert got[0] == (["unclassified"], ["unclassified"])
    assert got[1][0] == ["credit", "testdrive", "trade", "insurance", "payments", "spotlight"]
    assert got[1][1] == ["credit", "testdrive", "trade", "insurance", "payments"]
    assert got[2][0] == ["unclassified"]
    assert got[3][0] == ["finance"]


def test_closed_periods(spark):
    bounds = spark.createDataFrame(
        [(datetime(2024, 1, 7, 23), datetime(2024, 1, 22, 0, 1)), (datetime(2024, 1, 2), datetime(2024, 1, 3))], "lo timestamp, hi timestamp"
    )
    weeks = [r.period for r in periods.closed_periods(bounds, "lo", "hi", "week").collect()]
    assert weeks == [datetime(2024, 1, 1), datetime(2024, 1, 8), datetime(2024, 1, 15)]
    quarters = periods.closed_periods(bounds.select("lo", periods.add_months(F.col("hi"), 7).alias("hi")), "lo", "hi", "quarter")
    assert [r.period for r in quarters.collect()][:2] == [datetime(2024, 1, 1), datetime(2024, 4, 1)]


def test_next_run(spark):
    start = datetime(2024, 1, 1)
    data = [(start, None), (start, datetime(2024, 1, 1, 5)), (start, datetime(2024, 1, 2)), (start, datetime(2023, 12, 31, 12)), (start, datetime(2023, 12, 29))]
    due = periods.next_run(F.col("s"), F.expr("INTERVAL '1' DAY"), F.col("l"))
    got = [r[0] for r in values(spark, data, "s timestamp, l timestamp", due)]
    # A run half a day before the start still lands in slot 0; three days before, in slot -3.
    assert got == [start, datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 2), datetime(2023, 12, 30)]


def test_months_are_clamped(spark):
    got = values(spark, [(datetime(2024, 1, 31),)], "d timestamp", periods.add_months(F.col("d"), 1), periods.add_minutes(F.col("d"), -90))
    assert got == [(datetime(2024, 2, 29), datetime(2024, 1, 30, 22, 30))]


def test_typed_view_sharp_cases(spark):
    spec = P.ViewSpec(("id",), P.parse_fields("A.Mrr:numeric A.Due:ts_local A.Made:ts_offset B.Id=b n:int day:date_us flag:boolean j:json e:unescape_json u:uuid z:strip_spaces"))
    data = [
        (1, '{"A.Mrr":"1.50","A.Due":"2024-07-01","A.Made":"2024-07-01 10:00:00-0400","B.Id":"x","n":" 12 ","day":"7/4/2024","flag":"yes","j":"{\\"a\\":1}","u":"0A1B2C3D-0000-4000-8000-000000000001","z":"M5V 1A1"}'),
        (2, '{"A.Mrr":"","A.Due":"2024-01-01","A.Made":"2024-07-01T10:00:00Z","B.Id":"","n":"12.0","day":"2024-07-04","flag":"maybe","j":"{a","u":"1","z":""}'),
        (3, "{}"),
    ]
    got = P.typed_view(spark.createDataFrame(data, "id int, payload string"), spec).collect()
    one, two, three = got
    assert float(one.mrr) == 1.5 and one.due == datetime(2024, 7, 1, 4) and one.made == datetime(2024, 7, 1, 14)
    assert (one.b, one.n, one.day, one.flag, one.j, one.z) == ("x", 12, datetime(2024, 7, 4), True, '{"a":1}', "M5V1A1")
    assert one.u == "0a1b2c3d-0000-4000-8000-000000000001"
    assert two.due == datetime(2024, 1, 1, 5) and two.made == datetime(2024, 7, 1, 10)
    assert [two[c] for c in ("mrr", "b", "n", "day", "flag", "j", "u", "z")] == [None] * 8
    assert all(v is None for k, v in three.asDict().items() if k != "id")


def test_rejects_and_strict(spark):
    spec = P.ViewSpec(("id",), P.parse_fields("n:int t"))
    df = spark.createDataFrame([(1, '{"n":"1","t":"a"}'), (2, '{"n":"x","t":""}'), (3, '{"n":""}')], "id int, payload string")
    assert {r.field: r.rejects for r in P.count_rejects(df, spec).collect()} == {"n": 1, "t": 0}
    with pytest.raises(Exception, match="n is not int"):
        P.typed_view(df, spec, strict=True).collect()


def test_nested_json_keeps_its_text(spark):
    df = spark.createDataFrame([('{"lead":{"id":"x","n":[1,2]},"k":null}',)], "p string")
    got = df.select(S.json_field(F.col("p"), "lead", "id"), P.has_key(F.col("p"), "k"), P.has_key(F.col("p"), "m"), P.add_key(F.col("p"), "m.n", F.lit('a"b'))).first()
    assert tuple(got) == ("x", True, False, '{"lead":{"id":"x","n":[1,2]},"k":null,"m.n":"a\\"b"}')
    empty = spark.createDataFrame([(" { } ",)], "p string").select(P.add_key(F.col("p"), "a", F.lit("1"))).first()[0]
    assert empty.strip() == '{"a":"1"}'


def test_specs_have_unique_outputs_and_known_rules():
    for name in VIEW_NAMES:
        spec = view_spec(name, {"trade": "tr", "credit": "cr"})
        outs = [f.out for f in spec.fields]
        assert len(set(outs)) == len(outs), name
        assert {f.rule for f in spec.fields} <= set(P.RULES)
    assert len(view_spec("v_marketplace_leads").fields) == 91
    assert "tr_report_id" in [f.out for f in view_spec("v_trade_leads", {"trade": "tr"}).fields]


def test_pack_payload_text_for_other_types(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), None, 2.5)], "id int, at timestamp, t string, x double")
    assert P.pack_payload(df, ["id"]).first().payload == '{"at":"2024-01-01 00:00:00","t":null,"x":2.5}'
