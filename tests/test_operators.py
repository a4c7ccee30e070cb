import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.operators import aggregates as A
from forecourt.operators import filters as X
from forecourt.operators import incremental as I
from forecourt.operators import joins as J
from forecourt.operators import latest as W
from forecourt.operators import merge as M
from forecourt.operators.latest import flag_old
from forecourt.operators.spread import heavy_keys, recency_ranks, spread_join, top_recency_ranks, with_group_stats, with_recency_rank

DAY = datetime(2024, 1, 1)


def at(n, seconds=0):
    return DAY + timedelta(days=n, seconds=seconds)


def table(spark, data, schema="k int, ts timestamp, v string"):
    return spark.createDataFrame(data, schema)


def test_upsert_replace_is_idempotent(spark, rows):
    target = table(spark, [(1, at(0), "a"), (2, at(0), "b")])
    batch = table(spark, [(2, at(1), "c"), (3, at(1), "d")])
    once = M.upsert_replace(target, batch, ["k"])
    assert rows(once) == rows(M.upsert_replace(once, batch, ["k"]))
    assert [r[2] for r in rows(once)] == ["a", "c", "d"]
    assert rows(M.upsert_replace(target.limit(0), batch, ["k"])) == rows(batch)
    assert rows(M.upsert_replace(target, batch.limit(0), ["k"])) == rows(target)


def test_upsert_newest_keeps_ties_and_ignores_batch_order(spark, rows):
    target = table(spark, [(1, at(5), "old"), (2, at(5), "old")])
    a = table(spark, [(1, at(5), "tie"), (2, at(6), "new"), (3, at(0), "in")])
    b = table(spark, [(2, at(7), "newest"), (3, at(-1), "older")])
    up = lambda t, c: M.upsert_newest(t, c, ["k"], "ts")
    ab, ba = rows(up(up(target, a), b)), rows(up(up(target, b), a))
    assert ab == ba
    assert [r[2] for r in ab] == ["old", "newest", "in"]


def test_partial_upsert_moves_only_named_columns(spark, rows):
    schema = "k int, ts timestamp, f string, note string"
    target = spark.createDataFrame([(1, at(5), "f1", "n1"), (2, at(9), "f1", "n1")], schema)
    batch = spark.createDataFrame([(1, at(5), "f2", "n2"), (2, at(5), "f2", "n2"), (3, at(1), "f2", "n2")], schema)
    got = rows(M.upsert_newest_partial(target, batch, ["k"], "ts", ["ts", "f"]))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, "f2", "n1"), (2, "f1", "n1"), (3, "f2", "n2")]


def test_file_date_upsert_both_ways(spark, rows):
    ledger = spark.createDataFrame([(1, at(1)), (2, at(2))], "id bigint, last_modified timestamp")
    target = spark.createDataFrame([("x", 1, "old")], "k string, file_id bigint, v string")
    batch = spark.createDataFrame([("x", 2, "new")], "k string, file_id bigint, v string")
    assert rows(M.upsert_by_file_date(target, batch, ["k"], ledger)) == [("x", 2, "new")]
    assert rows(M.upsert_by_file_date(target, batch, ["k"], ledger, prefer="as_shipped")) == [("x", 1, "old")]


def test_insert_if_absent_first_wins(spark, rows):
    target = table(spark, [(1, at(0), "a")])
    batch = table(spark, [(1, at(0), "z"), (2, at(2), "second"), (2, at(1), "first")])
    assert [r[2] for r in rows(M.insert_if_absent(target, batch, ["k"], "ts"))] == ["a", "first"]


def test_change_batch_with_tombstones(spark, rows):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int")
    batch = spark.createDataFrame([("a", 2, "true"), ("b", 2, "false"), ("c", 2, None)], "id string, v int, gone string")
    assert rows(M.apply_change_batch(target, batch, "id", "gone")) == [("b", 2), ("c", 2)]


def test_delete_by_json_key_keeps_rows_without_key(spark, rows):
    df = spark.createDataFrame([(1, '{"e":"x"}'), (2, '{"e":"y"}'), (3, "{}")], "id int, payload string")
    ids = spark.createDataFrame([("x",)], "id string")
    out = M.delete_by_json_key(df, F.get_json_object("payload", "$.e"), ids)
    assert [r[0] for r in rows(out)] == [2, 3]


def test_sessions_and_jobs(spark, rows):
    sessions = spark.createDataFrame([], "id bigint, schema string, script string, payload string, validated boolean")
    args = (F.lit("public"), F.lit("s"), F.lit("{}"))
    twice = M.register_session(M.register_session(sessions, *args), *args)
    assert [r[0] for r in rows(twice)] == [1, 2]
    jobs = spark.sql("select 'a' schema, 's' script, timestamp'2024-01-01' start_date, interval '1' day frequency, timestamp'2024-01-02' last_run, cast(null as timestamp) last_update, 'success' status, interval '1' hour run_time")
    plan = spark.sql("select 'a' schema, 's' script, timestamp'2024-02-01' start_date, interval '7' day frequency union all select 'b', 't', timestamp'2024-02-01', interval '7' day")
    got = {r.script: r for r in M.upsert_job_plan(jobs, plan).collect()}
    assert got["s"].frequency == timedelta(days=7) and got["s"].status == "success" and got["t"].last_run is None


@pytest.mark.parametrize("seed", [1, 20])
def test_recency_rank_equals_window(spark, rows, seed):
    random.seed(seed)
    data = []
    for i in range(600):
        key = "hot" if random.random() < 0.4 else random.choice(["a", "b", None, "c"])
        when = None if random.random() < 0.03 else at(random.randint(0, 3), random.choice([0, 1, 59, 60, 3600, 7261]))
        data.append((key, when, i))
    df = spark.createDataFrame(data, "k string, ts timestamp, i int")
    w = Window.partitionBy("k")
    want = df.withColumn("rank", F.rank().over(w.orderBy(F.col("ts").desc_nulls_first()))).withColumn("n", F.count("*").over(w))
    cols = ["k", "ts", "i", "rank", "n"]
    got = with_recency_rank(df, ["k"], "ts", "rank", "n")
    assert rows(got.select(cols)) == rows(want.select(cols))
    top = with_recency_rank(df, ["k"], "ts", "rank", "n", top=5)
    assert rows(top.select(cols)) == rows(want.where("rank <= 5").select(cols))
    for n in (1, 40, 10_000):
        assert rows(with_recency_rank(df, ["k"], "ts", "rank", "n", top=n).select(cols)) == rows(want.where(F.col("rank") <= n).select(cols))
        flagged = want.withColumn("is_old", F.when(F.col("rank") > n, 1).otherwise(0))
        assert rows(flag_old(df, ["k"], "ts", n).select("i", "is_old")) == rows(flagged.select("i", "is_old"))
    per_ts = recency_ranks(df, ["k"], "ts", "rank", "n")
    assert rows(per_ts) == rows(want.select("k", "ts", "rank", "n").distinct())


def test_top_ranks_cut_groups_before_the_shuffle(spark):
    """No window, and no sort, sees more of a group than each task's newest instants."""
    df = spark.range(20_000).selectExpr("id % 3 as k", "timestamp_seconds(id) as ts")
    ranks = top_recency_ranks(df.repartition(4), ["k"], "ts", 5)
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [k" in plan and "Partial" in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted((r.k, r["rank"]) for r in ranks.collect()) == [(k, n) for k in range(3) for n in range(1, 6)]


def test_heavy_keys_are_found_and_others_are_not(spark):
    rows = [("hot", k) for k in range(600)] + [(None, k) for k in range(200)] + [(f"k{k}", k) for k in range(200)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    hashes = {r.k: r.h for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert heavy_keys(df, ["k"]) == sorted([hashes["hot"], hashes[None]])
    assert heavy_keys(df.where("k like 'k%'"), ["k"]) == [] and heavy_keys(df.limit(0), ["k"]) == []


def test_only_heavy_keys_are_salted(spark, rows):
    small = spark.range(1000).selectExpr("concat('k', id) as k", "id as s")
    even = spark.range(5000).selectExpr("concat('k', id % 1000) as k", "id as v")
    skewed = spark.range(5000).selectExpr("if(id % 3 = 0, concat('k', id % 1000), 'k7') as k", "id as v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    try:
        assert "Generate" not in plan(spread_join(skewed, small, ["k"], salts=5))  # broadcast: no key is hot
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Generate" not in plan(spread_join(even, small, ["k"], salts=5))
        split = spread_join(skewed, small, ["k"], salts=5)
        assert "Generate" in plan(split) and rows(split) == rows(spread_join(skewed, small, ["k"]))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = split.where("k = 'k7'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_spread_join_equals_plain_join(spark, rows):
    big = spark.createDataFrame([("hot", 1)] * 50 + [("cold", 2), (None, 3), ("none", 4)], "k string, v int").repartition(7)
    small = spark.createDataFrame([("hot", "h"), ("cold", "c"), (None, "n")], "k string, s string")
    plain = rows(spread_join(big, small, ["k"]))
    assert len(plain) == 52 and plain == rows(spread_join(big, small, ["k"], salts=5))
    assert rows(spread_join(big, small, ["k"], "left_anti", salts=5)) == [("none", 4)]
    assert len(rows(spread_join(big, small, ["k"], salts=5, null_safe=False))) == 51
    stats = with_group_stats(big, ["k"], F.count("*").alias("n"), salts=3)
    assert {r.k: r.n for r in stats.collect()} == {"hot": 50, "cold": 1, None: 1, "none": 1}


def test_latest_earliest_and_first_seen(spark, rows):
    df = spark.createDataFrame([(1, at(1), 10), (1, at(2), 20), (1, at(2), 30), (2, None, 5)], "k int, ts timestamp, p int")
    assert [r[2] for r in rows(W.latest_per_key(df, ["k"], "ts", [F.col("p")]))] == [30, 5]
    assert [r[2] for r in rows(W.earliest_per_key(df, ["k"], "ts", [F.col("p")]))] == [10, 5]
    assert [r[2] for r in rows(W.latest_first_seen(df, ["k"], "ts", "p"))] == [20, 5]


def test_rank_longest_keeps_ties(spark, rows):
    df = spark.createDataFrame([(1, "aa"), (1, "bb"), (1, "c")], "k int, t string")
    assert [r[1] for r in rows(W.rank_longest(df, "k", "t"))] == ["aa", "bb"]


def test_a_row_is_made_of_gram_hits_only(spark):
    """Long texts in many pieces, characters of several bytes, needles shorter than a gram and over the ends of pieces."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdeé日") for _ in range(r.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 400))) for _ in range(60)] + ["", "x", None]
    needles = [t[a : a + r.choice([1, 3, 7, 8, 9, 40, 300])] for t in texts[:40] if t for a in [r.randrange(len(t))]] + ["", None, "nowhere at all", "zz"]
    left = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    right = spark.createDataFrame([(i, n) for i, n in enumerate(needles)], "nid int, needle string")
    got = {(x["id"], x["nid"]) for x in J.substring_join(left, "text", right, "needle").select("id", "nid").collect()}
    assert got == {(i, k) for i, t in enumerate(texts) for k, n in enumerate(needles) if t is not None and n is not None and n in t}
    index = J.rarest_grams(right, "needle")
    grams = {x["gram"] for x in index.collect()}
    hits = J.gram_hits(left.where("text is not null").withColumnRenamed("id", "_id"), "text", index.select("gram")).collect()
    want = [(i, p + 1, t[p : p + w]) for i, t in enumerate(texts) if t for w in {len(g) for g in grams} for p in range(len(t) - w + 1) if t[p : p + w] in grams]
    assert sorted(tuple(h) for h in hits if h["gram"] in grams) == sorted(want)
    assert len(hits) - len(want) < 0.01 * sum(len(t) for t in texts if t)  # grams that share a slot with a wanted one
    of = {n: [g["gram"] for g in index.collect() if g["gram"] in n] for n in needles if n}
    share = lambda g: sum(g in n for n in {n for n in needles if n})
    assert all(min(map(share, of[n])) == min(share(n[a : a + 8]) for a in range(max(1, len(n) - 7))) for n in of)


def test_merged_moments_equal_those_of_all_rows(spark):
    """Sessions that each add one file give the fit that reads them all; far from zero, with constant and lone groups and NULLs."""
    r = random.Random(12)
    data = [(k % 5, s, None if r.random() < 0.05 else 1e4 + (7.0 if k % 5 == 3 else r.gauss(0, 50)), None if r.random() < 0.05 else 1e5 - 3 * k + r.gauss(0, 40)) for k in range(900) for s in [r.randrange(4) if k % 5 != 4 else 2]]
    data += [(None, s, float(s), 2.0 * s + 1) for s in range(4)] + [(9, 0, None, 1.0)]
    df = spark.createDataFrame(data, "k int, session int, x double, y double")
    parts = [A.moments(df.where(df.session == s), ["k"], "x", "y") for s in range(4)]
    merged = parts[0]
    for p in parts[1:]:
        merged = A.merge_moments(merged, p, ["k"])
    got = {x.k: x for x in A.fit_of_moments(merged, ["k"]).collect()}
    rows = df.where("x is not null and y is not null")
    fits = A.linear_fit(rows, ["k"], "x", "y")
    whole = {x.k: x for x in fits.collect()}
    errors = {x.k: x for x in A.fit_errors(rows, fits, ["k"], "x", "y").collect()}
    assert set(got) == {0, 1, 2, 3, 4, None}
    for k, x in got.items():
        assert x.size == whole[k].size and x.slope == pytest.approx(whole[k].slope, rel=1e-6, abs=1e-9)
        assert x.r2 is whole[k].r2 is None or x.r2 == pytest.approx(whole[k].r2, rel=1e-6)
        assert x.intercept == pytest.approx(whole[k].intercept, rel=1e-6)
        assert x.mean_squared_error == pytest.approx(errors[k].mean_squared_error, rel=1e-4, abs=1e-3)
        assert (x.minimum, x.maximum) == (errors[k].minimum, errors[k].maximum) and x.mean_predicted == pytest.approx(errors[k].mean_predicted)


def test_substring_join_equals_brute_force(spark, rows):
    random.seed(7)
    word = lambda n: "".join(random.choice("ab.") for _ in range(n))
    texts = [(i, word(random.randint(0, 14))) for i in range(60)] + [(99, None)]
    needles = sorted({word(random.randint(0, 8)) for _ in range(40)} | {"", "aaaa"})
    left = spark.createDataFrame(texts, "id int, url string")
    right = spark.createDataFrame([(n, i) for i, n in enumerate(needles)] + [(None, -1)], "domain string, d int")
    want = sorted((i, n) for i, t in texts if t is not None for n in needles if n in t)
    got = J.substring_join(left, "url", right, "domain").select("id", "domain")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_match_tiered_equals_brute_force(spark):
    random.seed(3)
    key = ["year", "make", "model", "trim", "style"]
    schema = "year int, make string, model string, trim string, style string, body_type string, msrp double"

    def row(i):
        msrp = None if random.random() < 0.15 else float(random.choice([0, 100, 101, 102, 104, 105, 106, 110, 200]))
        return (random.randint(2000, 2002), random.choice("AB"), random.choice("xy"), random.choice("tu"), f"s{i}", random.choice(["S", "P"]), msrp)

    offers, wanted = [row(i) for i in range(60)], [row(1000 + i) for i in range(150)]

    def expect(w):
        year, make, model, trim, _, body, msrp = w
        if msrp is None:
            keys = [o[:5] for o in offers if o[:4] == (year, make, model, trim)]
            return (4, min(keys)) if keys else None
        near = [o for o in offers if o[6] is not None and msrp - msrp * 0.05 <= o[6] <= msrp + msrp * 0.05]
        tests = {
            1: lambda o: o[:3] == (year, make, model),
            2: lambda o: (o[0], o[1], o[5]) == (year, make, body),
            3: lambda o: o[:4] == (year - 1, make, model, trim),
            5: lambda o: (o[0], o[5]) == (year, body),
        }
        for tier, test in tests.items():
            hits = [(abs(o[6] - msrp), o[:5]) for o in near if test(o)]
            if hits:
                return tier, min(hits)[1]
        return None

    got = J.match_tiered(spark.createDataFrame(wanted, schema), spark.createDataFrame(offers, schema), key).collect()
    found = {tuple(r[k] for k in key): (r.tier, tuple(r[f"match_{k}"] for k in key)) for r in got}
    assert found == {w[:5]: expect(w) for w in wanted if expect(w)}
    assert {t for t, _ in found.values()} == {1, 2, 3, 4, 5}


def test_not_seen_before_boundary(spark, rows):
    now = table(spark, [(1, at(20), "a"), (2, at(20), "b"), (3, at(20), "c")])
    past = table(spark, [(1, at(6), "x"), (2, at(5), "x"), (2, at(19), "x")])
    assert [r[0] for r in rows(J.not_seen_before(now, past, ["k"], "ts", 14))] == [1, 3]


def test_duplicate_column_names_are_an_error(spark):
    a = spark.createDataFrame([(1, 2)], "id int, status int")
    b = spark.createDataFrame([(1, 2)], "lead_id int, status int")
    with pytest.raises(ValueError, match="status"):
        J.join_unique_names(a, b, F.col("id") == F.col("lead_id"), "left")


def test_exclude_ids_is_sql_not_in(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert rows(X.exclude_ids(df, "id", spark.createDataFrame([(2,)], "id int"))) == [(1,)]


def test_training_filter_bounds_and_nan(spark, rows):
    base = ("KILOMETERS", "CAD")
    data = [("999", "9000"), ("1000", "9000"), ("250000", "9000"), ("250001", "9000"), ("5000", "499"), ("5000", "500"), ("5000", "5000"), ("nan", "9000"), ("x", "9000")]
    df = spark.createDataFrame([(*d, *base) for d in data], "miles_fs string, price_fs string, miles_indicator_ss string, currency_indicator_ss string")
    kept = [r[0] + "/" + r[1] for r in df.where(X.training_listing()).collect()]
    assert kept == ["1000/9000", "250000/9000", "5000/500", "nan/9000"]
    assert df.where(X.training_listing(False)).count() == 5


def test_barrier_and_gate(spark):
    feed = lambda *days: spark.createDataFrame([(at(d),) for d in days], "ts timestamp")
    got = I.multi_feed_barrier([feed(0, 40), feed(3, 35)], "ts", "month").first()
    assert (got.lo, got.hi) == (datetime(2024, 1, 1), datetime(2024, 2, 1))
    done = spark.createDataFrame([(datetime(2024, 1, 1),)], "date timestamp")
    assert I.multi_feed_barrier([feed(0, 40)], "ts", "month", done).first().lo == datetime(2024, 2, 1)
    empty = spark.createDataFrame([], "ts timestamp")
    with pytest.raises(Exception, match="a feed is empty"):
        I.multi_feed_barrier([feed(0), empty], "ts", "month").collect()
    gate = lambda s, t, inc: I.freshness_gate(s, t, "ts", 24, inc).first().stale
    assert gate([feed(2)], feed(1), True) and not gate([feed(2)], feed(1), False)
    assert gate([feed(2)], empty, False)
    assert not gate([feed(2), feed(1)], feed(1), True)


def test_high_water_starts_at_the_epoch(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    lo, hi = I.high_water_window(empty, "ts", F.lit(at(0)), reupload_minutes=-1440, lag_minutes=15)
    got = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (got.lo, got.hi) == (datetime(1999, 12, 31), at(0, 900))


def test_grams_of_many_texts_are_hashed_at_once(spark, monkeypatch):
    """Texts of a piece don't mix, needles go over the ends of pieces, and letters beyond 16 bits count as one."""
    import numpy as np

    text = "𝒳yz 😀 the quick brown fox"
    slots = J.gram_slots(text, 5)
    assert len(slots) == len(text) - 4 and all(J.gram_slots(text[i : i + 5], 5) == slots[i : i + 1] for i in range(len(slots))) and not len(J.gram_slots("abc", 5))
    assert slots.min() >= 0 and slots.max() < J.SLOTS and len(np.unique(J.gram_slots("ab" * 50, 8))) == 2
    monkeypatch.setattr(J, "PIECE", 40)
    texts = ["ab", "cd", "", None, text, "x" * 37 + text + "y" * 90 + text, "abcd", "quick brown"]
    needles = ["ab", "bc", "x" * 8 + "𝒳", "fox", "😀", "quick brown fox", "y" * 80, "z" * 9]
    left = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(1)
    right = spark.createDataFrame([(n,) for n in needles], "needle string")
    got = {(r["id"], r["needle"]) for r in J.substring_join(left, "text", right, "needle").collect()}
    assert got == {(i, n) for i, t in enumerate(texts) for n in needles if t is not None and n in t}
