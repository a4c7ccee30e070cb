from datetime import datetime, timedelta

import pytest

from forecourt.streaming import epochs as V
from forecourt.streaming import streams as R

SCHEMA = "id int, k string, ts timestamp"


def drop(spark, folder, *rows):
    """Put one more file into the source folder."""
    data = [(i, k, datetime(2024, 1, 1) + timedelta(days=d)) for i, k, d in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def test_ingest_reads_each_file_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    for n in (1, 2):
        drop(spark, src, (n, "a", n))
        R.append_new(R.file_stream(spark, src, SCHEMA), out, check).awaitTermination()
    R.append_new(R.file_stream(spark, src, SCHEMA), out, check).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_tumbling_counts_wait_for_late_rows(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))

    def run():
        counts = R.tumbling_counts(R.file_stream(spark, src, SCHEMA), "ts", ["k"], "day")
        R.append_new(counts, out, check).awaitTermination()
        return {r.date.day: r.n for r in spark.read.parquet(out).collect()}

    drop(spark, src, (1, "a", 0), (2, "a", 3))
    assert run() == {}
    drop(spark, src, (3, "a", 0.5), (4, "a", 6))  # inside the three days
    assert run() == {1: 2}
    drop(spark, src, (5, "a", 0.5), (6, "a", 9))  # outside: dropped
    assert run() == {1: 2, 4: 1}


def test_late_counts_equal_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    for batch in ([(1, "a", 0), (2, "b", 1)], [(3, "a", 0.2), (4, "a", 1)], [(5, "a", 1.5)]):
        drop(spark, src, *batch)
        R.late_counts(R.file_stream(spark, src, SCHEMA), "ts", ["k"], out, check).awaitTermination()
    got = {(r.k, r.date.day): r.n for r in V.newest_rows(spark, out, "k string, date date, n bigint", ["k", "date"]).collect()}
    assert got == {("a", 1): 2, ("a", 2): 2, ("b", 2): 1}


def rows_of(spark, out, table=None):
    return {r.k: r.id for r in V.newest_rows(spark, out, SCHEMA, ["k"], table).collect()}


def test_upsert_stream_keeps_newest(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    assert rows_of(spark, out) == {}
    for batch in ([(1, "a", 0), (2, "b", 0)], [(3, "a", 2), (4, "a", 1)], [(5, "c", 0)], [(6, None, 0)]):
        drop(spark, src, *batch)
        R.upsert_stream(R.file_stream(spark, src, SCHEMA), out, ["k"], "ts", check).awaitTermination()
    assert rows_of(spark, out) == {"a": 3, "b": 2, "c": 5, None: 6}
    assert V.epochs(spark, out) == [0, 1, 2, 3]


def test_a_batch_that_stops_after_its_write_is_repeated_and_counts_once(spark, tmp_path, monkeypatch):
    """The batch is landed, but the stream stops before it is committed, and before any compaction."""
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    run = lambda: R.upsert_stream(R.file_stream(spark, src, SCHEMA), out, ["k"], "ts", check).awaitTermination()
    drop(spark, src, (1, "a", 0), (2, "b", 0))
    run()

    def stops(batch, path, epoch):
        V.land(batch.withColumn("id", batch.id + 100), path, epoch)
        raise RuntimeError("stopped")

    monkeypatch.setattr(R, "land", stops)
    drop(spark, src, (3, "a", 1))
    with pytest.raises(Exception, match="stopped"):
        run()
    assert rows_of(spark, out) == {"a": 103, "b": 2} and V.epochs(spark, out) == [0, 1]
    monkeypatch.setattr(R, "land", V.land)
    run()
    assert rows_of(spark, out) == {"a": 3, "b": 2} and V.epochs(spark, out) == [0, 1]
    assert V.landed(spark, out, spark.createDataFrame([], SCHEMA).schema).count() == 3


def test_compaction_takes_all_but_the_newest_batch(spark, tmp_path, monkeypatch):
    spark.sql("drop table if exists compacted")
    out, base = str(tmp_path / "out"), str(tmp_path / "base")
    put = lambda epoch, *rows: V.land(spark.createDataFrame([(i, k, datetime(2024, 1, 1)) for i, k in rows], SCHEMA), out, epoch)
    fold = lambda: V.compact(spark, out, SCHEMA, ["k"], "compacted", base)
    assert fold() == []
    put(0, (1, "a"), (2, "b"), (3, None))
    assert fold() == [] and rows_of(spark, out, "compacted") == {"a": 1, "b": 2, None: 3}
    put(1, (4, "a"))
    put(2, (5, "b"))
    assert fold() == [0, 1] and V.epochs(spark, out) == [2]
    assert rows_of(spark, out, "compacted") == {"a": 4, "b": 5, None: 3}
    put(2, (6, "b"))  # the newest batch once more
    put(3, (7, "c"))
    monkeypatch.setattr(V, "remove_folder", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        fold()
    assert rows_of(spark, out, "compacted") == {"a": 4, "b": 6, "c": 7, None: 3} and V.epochs(spark, out) == [2, 3]
    monkeypatch.undo()
    assert fold() == [2] and rows_of(spark, out, "compacted") == {"a": 4, "b": 6, "c": 7, None: 3}
    assert spark.table("compacted").count() == 3


def test_distinct_visits_and_calendar(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    drop(spark, src, (1, "a", 0), (1, "a", 0.5), (2, "a", 0.6), (1, "a", 1))
    drop(spark, src, (1, "a", 0.7))
    R.append_new(R.distinct_visits(R.file_stream(spark, src, SCHEMA), "ts", ["k"], "id"), out, check).awaitTermination()
    assert sorted((r.date.day, r.id) for r in spark.read.parquet(out).collect()) == [(1, 1), (1, 2), (2, 1)]
    days = [("a", datetime(2024, 1, 30), 2), ("a", datetime(2024, 1, 31), 1), ("a", datetime(2024, 2, 1), 5)]
    daily = spark.createDataFrame(days, "k string, date timestamp, n bigint")
    assert [(r.date, r.n) for r in R.calendar_counts(daily, ["k"], "month").collect()] == [(datetime(2024, 1, 1), 3)]


def test_slowest_feed_decides(spark, tmp_path):
    feeds = []
    for name, days in {"x": (0, 20), "y": (0, 5)}.items():
        drop(spark, tmp_path / name, *[(1, name, d) for d in days])
        feeds.append(R.file_stream(spark, str(tmp_path / name), SCHEMA))
    counts = R.tumbling_counts(R.union_feeds(feeds, "ts"), "ts", ["k"], "day", late=None)
    R.append_new(counts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    # y is at day 5, so only days before day 2 are closed, although x is at day 20.
    assert sorted((r.k, r.date.day) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("x", 1), ("y", 1)]
