import gzip
import json
import zipfile
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from forecourt.functions import payload as P
from forecourt.session import materialize
from forecourt.sources import extracts, files as S, ledger as G, sinks as K


def event(name="view", id_="e1", at="2024-01-01T10:00:00+00:00", **extra):
    body = {"event_id": id_, "happened_at": at, "ip_address": "1.2.3.4", **extra}
    return json.dumps({"event_name": name, **body} if name else body)


def write_zip(path, *entries):
    with zipfile.ZipFile(path, "w") as z:
        for i, lines in enumerate(entries):
            z.writestr(f"part{i}.json", "".join(line + "\n" for line in lines))


def test_event_archives(spark, tmp_path):
    same = event(lead={"id": "x", "n": 1})
    write_zip(tmp_path / "a.zip", [same, same, event("click"), event(None), event(id_="e2", at="yesterday")], [event(id_="second-entry")])
    write_zip(tmp_path / "b.zip", [same])
    write_zip(tmp_path / "c.zip")
    write_zip(tmp_path / "d.zip", [])
    got = S.scan_event_archive(S.read_archives(spark, str(tmp_path)), ["view"]).collect()
    assert sorted((r.file.rsplit("/", 1)[-1], r.event_id) for r in got) == [("a.zip", "e1"), ("a.zip", "e2"), ("b.zip", "e1")]
    one = [r for r in got if r.event_id == "e1"][0]
    assert one.happened_at == datetime(2024, 1, 1, 10)
    assert json.loads(one.payload) == {"ip_address": "1.2.3.4", "lead": {"id": "x", "n": 1}}
    assert [r.happened_at for r in got if r.event_id == "e2"] == [None]


def test_archives_are_streamed_from_where_they_lie(spark, tmp_path):
    """Archives that Spark may not hold as one value are read; a task's memory does not follow their size."""
    import resource

    folder = tmp_path / "with space é%"
    folder.mkdir()
    line = event(id_="x", more="y" * 200)
    write_zip(folder / "big one.zip", [line.replace('"x"', f'"{k}"') for k in range(200_000)])
    size = (folder / "big one.zip").stat().st_size
    old = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(size // 2))
    try:
        archives = S.read_archives(spark, str(folder))
        assert S.scan_event_archive(archives, ["view"]).select("event_id").distinct().count() == 200_000
        with pytest.raises(Exception, match="(?i)exceed"):
            S.archive_lines(S.read_archives(spark, str(folder), content=True)).count()

        def peak(batches):
            before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
            with S._opened(next(iter(batches))["path"][0]) as file, zipfile.ZipFile(file) as z, z.open(z.infolist()[0]) as entry:
                rows = sum(1 for _ in entry)
            import pandas as pd

            yield pd.DataFrame({"rows": [rows], "kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before]})

        got = archives.mapInPandas(peak, "rows long, kb long").first()
        assert got.rows == 200_000 and got.kb * 1024 < 20 << 20 and size > 40 << 20
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", old)
    assert S.archive_lines(S.read_archives(spark, str(folder), content=True)).count() == 200_000


def test_json_lines_and_gz(spark, tmp_path):
    (tmp_path / "a.json").write_text(event() + "\n")
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write(event(id_="e9") + "\n")
    got = S.parse_events(S.read_json_lines(spark, str(tmp_path)), ["view"])
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e9"]


LISTING = {
    "id": "7", "dealer_id_is": "12", "vin_ss": "1HGCM82633A004352", "taxonomy_vin_ss": "1HGCM8263A", "price_fs": "9000.5", "miles_fs": "5000",
    "miles_indicator_ss": "KILOMETERS", "currency_indicator_ss": "CAD", "scraped_at_dts": "2024-01-02T03:04:05Z", "status_date_dts": "2024-01-02T03:04:05Z",
    "zip_is": "M5V 1A1", "latitude_fs": "x", "longitude_fs": "-79.4", "city_ss": "", "state_ss": "ON", "source_ss": "WWW.Dealer.ca", "more_info_ss": 'say ""hi"", ok',
}


def write_listings(path, *changes):
    rows = [{**LISTING, **c} for c in changes]
    with gzip.open(path, "wt") as f:
        f.write(",".join(LISTING) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r.values()) + "\n")


def test_listing_profiles(spark, tmp_path):
    path = str(tmp_path / "v1.csv.gz")
    write_listings(
        path, {}, {"id": "vin16", "vin_ss": "1HGCM82633A00435"}, {"id": "pattern", "taxonomy_vin_ss": "1HGCM8263B"}, {"id": "dealer", "dealer_id_is": ""},
        {"id": "same", "price_fs": "5000"}, {"id": "miles", "miles_indicator_ss": "MILES"}, {"id": "noprice", "price_fs": ""}, {"id": "nodate", "status_date_dts": ""},
    )
    ids = lambda p: sorted(r.id for r in S.scan_listing_csv(spark, path, p).collect())
    assert ids("ca_new") == ["7", "miles", "noprice", "same"]
    assert ids("ca_used") == ["7", "same"]
    assert ids("us_used") == ["7", "miles"]
    row = S.scan_listing_csv(spark, path, "ca_new").where("id = '7'").first()
    assert (row.zip, row.domain, row.city, row.latitude, row.price) == ("M5V1A1", "dealer.ca", None, None, 9000.5)
    assert row.file.endswith("v1.csv.gz")
    kept = S.column_subset(S.read_text_table(spark, path), ["state_ss", "absent", "more_info_ss"]).first().payload
    assert json.loads(kept) == {"state_ss": "ON", "more_info_ss": 'say "hi", ok'}


def test_sectioned_report(spark, tmp_path):
    head = ["Report", "Kia of X,,", "a", "b", "c", "d", "e", "Deal,Gross,Front"]
    body = ["101 x 07/04/2024,$1,200", "102 x 7/5/2024,$3", "", "999 x 07/06/2024,$9,9"]
    (tmp_path / "one.csv").write_text("\n".join(head + body) + "\n")
    (tmp_path / "two.csv").write_text("\n".join([*head[:1], "Ford", *head[2:], body[0]]) + "\n")
    got = sorted((r.dealer, r.purchase_number, r.purchase_date, json.loads(r.payload)) for r in S.scan_sectioned_report(spark, str(tmp_path)).collect())
    assert got == [
        ("Ford", 101, datetime(2024, 7, 4), {"Gross": "1", "Front": "200"}),
        ("Kia of X", 101, datetime(2024, 7, 4), {"Gross": "1", "Front": "200"}),
        ("Kia of X", 102, datetime(2024, 7, 5), {"Gross": "3"}),
    ]


def test_billing_and_keyed(spark, tmp_path):
    (tmp_path / "Invoice.csv").write_text("Invoice.Id,Invoice.UpdatedDate,Invoice.is_deleted,Invoice.Amount\na,2024-07-01T00:00:00-0400,false,1\nb,2024-07-01T00:00:00-0400,true,2\n")
    got = S.scan_billing_export(spark, str(tmp_path / "Invoice.csv"), "Invoice").orderBy("id").collect()
    assert [(r.id, r.updateddate, r.deleted) for r in got] == [("a", datetime(2024, 7, 1, 4), "false"), ("b", datetime(2024, 7, 1, 4), "true")]
    assert json.loads(got[0].payload) == {"Invoice.is_deleted": "false", "Invoice.Amount": "1"}
    (tmp_path / "Sales Data.CSV").write_text("lId,name\n1,x\nbad,y\n2,z\n")
    keyed = S.import_keyed_csv(spark, str(tmp_path / "Sales Data.CSV"), "lId").orderBy("id").collect()
    assert [(r.id, r.payload) for r in keyed] == [(1, '{"name":"x"}'), (2, '{"name":"z"}')]
    assert S.table_name("/a/Sales Data.CSV") == "sales data"


def test_versions_and_modified_after(spark, tmp_path):
    for v in ("v1", "v2"):
        write_listings(tmp_path / f"{v}.csv.gz", {"id": v})
    assert S.snapshot_versions(spark, str(tmp_path)).select("file").distinct().count() == 2
    assert S.snapshot_versions(spark, str(tmp_path), F.lit("2999-01-01").cast("timestamp")).count() == 0
    assert S.scan_listing_csv(spark, str(tmp_path), "ca_new", modified_after="2000-01-01T00:00:00").count() == 2


def test_ledger_reads_each_file_once(spark, tmp_path):
    write_listings(tmp_path / "v1.csv.gz", {})
    ledger = spark.createDataFrame([], G.LEDGER_SCHEMA)
    raw = S.read_text_table(spark, str(tmp_path), file=True)
    fresh = G.new_files(raw.select("file", "last_modified").distinct(), ledger, "job")
    ledger = materialize(G.record_files(ledger, fresh, "job", F.lit("2024-01-01").cast("timestamp")), "ledger")
    assert G.with_file_id(raw, ledger, "job").count() == 1
    write_listings(tmp_path / "v2.csv.gz", {}, {"id": "8"})
    raw = S.read_text_table(spark, str(tmp_path), file=True)
    assert G.rows_of_new_files(raw, ledger, "job").count() == 2
    assert G.rows_of_new_files(raw, ledger, "other").count() == 3
    listing = raw.select("file", "last_modified").distinct()
    again = G.record_files(ledger, G.new_files(listing, ledger, "job"), "job", F.lit("2024-01-02").cast("timestamp"))
    assert again.count() == 2 and G.newer_than(listing, again, "job").count() == 0


def test_day_slices_cover_everything():
    assert extracts.day_slices("t", ["2024-01-01", "2024-01-02"]) == [
        "t < '2024-01-01' OR t IS NULL", "t >= '2024-01-01' AND t < '2024-01-02'", "t >= '2024-01-02'",
    ]


def test_replace_table_reads_itself(spark, tmp_path):
    spark.sql("drop table if exists swap_me")
    K.replace_table(spark.range(3), "swap_me", str(tmp_path))
    K.replace_table(spark.table("swap_me").selectExpr("id + 10 as id"), "swap_me", str(tmp_path))
    assert sorted(r.id for r in spark.table("swap_me").collect()) == [10, 11, 12]


def test_upsert_partitions_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "k int, p string, v int").write.partitionBy("p").parquet(path)
    before = {f.name for f in (tmp_path / "t" / "p=b").iterdir()}
    K.upsert_partitions(spark.createDataFrame([(2, "a", 9), (4, "c", 9)], "k int, p string, v int"), path, ["k"], "p")
    got = sorted((r.k, r.p, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", 1), (2, "a", 9), (3, "b", 1), (4, "c", 9)]
    assert {f.name for f in (tmp_path / "t" / "p=b").iterdir()} == before


def test_columns_go_by_each_files_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city\n1,x\n2,\n")
    (tmp_path / "b.csv").write_text("city,id\ny,3\n")
    (tmp_path / "c.csv").write_text("id,more\n4,m\n5\n6,n,o\n")
    (tmp_path / "d.csv").write_text("")
    got = S.read_text_table(spark, str(tmp_path))
    assert sorted((r.id, r.city, r.more) for r in got.collect() if r.id < "5") == [("1", "x", None), ("2", None, None), ("3", "y", None), ("4", None, "m")]
    broken = {r.file.rsplit("/", 1)[-1]: r.broken for r in S.count_broken(spark, str(tmp_path)).collect()}
    assert broken == {"a.csv": 0, "b.csv": 0, "c.csv": 2}
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_text_table(spark, str(tmp_path), strict=True).collect()
    with pytest.raises(ValueError):
        S.read_text_table(spark, str(tmp_path / "d.csv"))


def test_broken_event_lines_are_counted_or_fail(spark):
    lines = spark.createDataFrame([("f", '{"event_name":"a","event_id":"1"}'), ("f", "{broken"), ("f", " "), ("g", "{}")], "file string, line string")
    assert S.parse_events(lines, ["a"]).count() == 1
    assert {r.file: r.broken for r in S.count_broken_events(lines).collect()} == {"f": 1, "g": 0}
    with pytest.raises(Exception, match="not an event"):
        S.parse_events(lines, ["a"], strict=True).collect()


def test_rejects_count_lost_digits(spark):
    spec = P.ViewSpec((), P.parse_fields("n:numeric"))
    rows = spark.createDataFrame([(f'{{"n":"{n}"}}',) for n in ("1.123456789", "1.1234567891", "1.1000000000", "x", "")], "payload string")
    assert P.count_rejects(rows, spec).first().rejects == 2
    with pytest.raises(Exception, match="numeric"):
        P.typed_view(rows.limit(2), spec, strict=True).collect()


V = "v int"


def landed_files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_publish_survives_a_stop_between_rows_and_ledger(spark, tmp_path, monkeypatch):
    now = F.lit("2024-01-02").cast("timestamp")
    rows = spark.createDataFrame([("a", datetime(2024, 1, 1), 1), ("a", datetime(2024, 1, 1), 2), ("b", datetime(2024, 1, 1), 3)], "file string, last_modified timestamp, v int")
    paths = str(tmp_path / "rows"), str(tmp_path / "ledger")
    seen = lambda script="job": sorted(r.v for r in G.published(G.read_rows(spark, paths[0], V), G.read_ledger(spark, paths[1]), script).collect())
    assert seen() == []
    real = G.append_ledger
    monkeypatch.setattr(G, "append_ledger", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        G.publish_files(rows.withColumn("v", F.col("v") + 100), *paths, "job", now)
    assert seen() == [] and G.read_rows(spark, paths[0], V).count() == 3
    monkeypatch.setattr(G, "append_ledger", real)
    G.publish_files(rows, *paths, "job", now)
    assert seen() == [1, 2, 3]
    before = {**landed_files(tmp_path / "rows"), **landed_files(tmp_path / "ledger")}
    again = rows.unionByName(rows.limit(1).withColumn("file", F.lit("c")))
    G.publish_files(again, *paths, "job", now)
    after = {**landed_files(tmp_path / "rows"), **landed_files(tmp_path / "ledger")}
    assert seen() == [1, 1, 2, 3] and before.items() <= after.items() and len(after) == len(before) + 2  # c's rows and ledger row


def test_purging_a_job_drops_its_partitions_only(spark, tmp_path):
    now = F.lit("2024-01-02").cast("timestamp")
    rows = spark.createDataFrame([(f, datetime(2024, 1, 1), v) for v, f in enumerate("aabc")], "file string, last_modified timestamp, v int")
    paths = str(tmp_path / "rows"), str(tmp_path / "ledger")
    for job in ("one", "the other/job"):
        G.publish_files(rows, *paths, job, now)
    before = landed_files(tmp_path / "rows")
    G.purge_job(spark, *paths, "the other/job")
    stored, ledger = G.read_rows(spark, paths[0], V), G.read_ledger(spark, paths[1])
    assert [r.script for r in ledger.select("script").distinct().collect()] == ["one"]
    assert {r.script for r in stored.collect()} == {"one"} and landed_files(tmp_path / "rows").items() < before.items()
    assert G.rows_of_new_files(rows, ledger, "the other/job").count() == 4 and G.rows_of_new_files(rows, ledger, "one").count() == 0
    plan = G.published(stored, ledger, "one")._jdf.queryExecution().executedPlan().toString()
    assert "script#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "dynamicpruning" in plan


def test_headers_are_read_without_the_files(spark, tmp_path):
    import bz2
    import io
    import zlib

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    body = b"\xef\xbb\xbfid,city\r\n" + b"1,x\r\n" * 500_000
    for codec, data in (("", body), ("gz", gzip.compress(body)), ("bz2", bz2.compress(body)), ("deflate", zlib.compress(body))):
        stream = Counted(data)
        assert S.first_line(stream, codec) == b"\xef\xbb\xbfid,city" and stream.taken <= 4 * S.HEAD_BYTES
        (tmp_path / f"f.csv{codec and '.' + codec}").write_bytes(data)
    assert S.first_line(Counted(b"")) is None and S.first_line(Counted(b"\nx")) == b"" and S.first_line(Counted(b"a" * 9000)) == b"a" * 9000
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "none.csv.gz").write_bytes(gzip.compress(b""))
    heads = S.header_lines(spark, str(tmp_path))
    assert sorted((r.file.rsplit("/", 1)[-1], r.header) for r in heads.collect()) == [(n, "id,city") for n in ("f.csv", "f.csv.bz2", "f.csv.deflate", "f.csv.gz")]
    assert sorted(r for r in heads.collect()) == sorted(S.scanned_header_lines(spark, str(tmp_path)).collect())
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema: ")[1]
    assert S.read_text_table(spark, str(tmp_path)).count() == 4 * 500_000


def test_headers_fall_back_to_sparks_reader(spark, tmp_path, monkeypatch):
    """Files that only Spark can open are read by it."""
    (tmp_path / "a.csv").write_text("id,city\n1,x\n")
    (tmp_path / "b.csv").write_text("id\n2\n")
    monkeypatch.setattr(S, "header_lines", lambda *_: S.scanned_header_lines(spark, str(tmp_path)).withColumn("header", F.lit(None).cast("string")))
    assert sorted((r.id, r.city) for r in S.read_text_table(spark, str(tmp_path)).collect()) == [("1", "x"), ("2", None)]


def test_scratch_folder_must_be_named_and_is_pruned(spark):
    from forecourt.session import fresh_path, prune_scratch, scratch_root

    path = fresh_path(spark, "old")
    spark.range(1).write.parquet(path)
    assert prune_scratch(spark, 10**15, 10**15) == []
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError):
        scratch_root(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default)))


def test_written_files_have_bounded_rows(spark, monkeypatch):
    """The more rows, the more files: a gzip file is one task's work."""
    from forecourt.standins import files as standin

    monkeypatch.setattr(standin, "FILE_ROWS", 100, raising=False)
    path = standin._written(SimpleNamespace(spark=spark), spark.range(5000).selectExpr("id", "id % 7 as n"), "bounded")
    sizes = spark.read.csv(path, header=True).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 5000 and max(r["count"] for r in sizes) <= 100


def test_reports_and_archives_are_opened_once(spark, tmp_path):
    """What several passes need is written once: no pass opens the files again."""
    from forecourt.standins import QUERIES

    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.csv").write_text("\n".join(["t", "D,x", *["t"] * 5, "Deal,Gross", "7 x 01/02/2024,$1", "", "Total,$1"]))
    report = S.scan_sectioned_report(spark, str(tmp_path / "r"))
    assert [(r.dealer, r.purchase_number) for r in report.collect()] == [("D", 7)]
    assert "FileScan text" not in report._jdf.queryExecution().executedPlan().toString()
    kinds = "element_at(array('view', 'click', 'signup', 'purchase'), cast(id % 4 + 1 as int))"
    events = spark.range(400).selectExpr("id event_id", "id % 5 user_id", f"{kinds} event_type", "timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id % 20 as int)) ts", "1D value", """'{"k": "7"}' props""")
    events.write.parquet(str(tmp_path / "events.parquet"))
    visits = QUERIES["unique_impressions_resumed"](spark, str(tmp_path))
    # Days 11 to 16: the feeds end on the 17th to 20th, and each day has one user of each of five.
    assert {r.date.day for r in visits.collect()} == set(range(11, 17))
    assert "MapInPandas" not in visits._jdf.queryExecution().executedPlan().toString()


def test_a_first_delivery_shuffles_nothing_by_file_and_lands_in_parts(spark, tmp_path, monkeypatch):
    rows = spark.range(200_000).selectExpr("'one' file", "id", "timestamp'2024-01-01' last_modified")
    plan = G.rows_of_new_files(rows, G.read_ledger(spark, str(tmp_path / "ledger")), "job")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    monkeypatch.setattr(G, "LANDED_BYTES", "64k", raising=False)
    G.publish_files(rows, str(tmp_path / "rows"), str(tmp_path / "ledger"), "job", F.current_timestamp())
    landed = G.read_rows(spark, str(tmp_path / "rows"), "id long")
    assert landed.count() == 200_000 and landed.select(F.input_file_name()).distinct().count() > 1
