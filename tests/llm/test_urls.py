import pytest

from forecourt.llm import urls as U

RULES = "select * from values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block') as r(rule_host, rule_path, rule_verdict)"


def judged(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string, rules string")
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in sorted(U.judge(df, spark.sql(RULES), **kw).collect(), key=lambda r: r["page_id"])]


@pytest.mark.parametrize(
    "url, row",
    [
        (None, ("", "", None, "allow")),
        ("", ("", "", None, "allow")),
        ("no scheme/x", ("", "", None, "allow")),
        ("http://", ("", "", None, "allow")),
        ("http://X.ÉXAMPLE.Org", ("x.ÉxamplE.org".replace("E", "e"), "", None, "allow")),
        ("http://a.org/p?q#f", ("a.org", "/p", "org/", "allow")),
        ("http://org/", ("org", "/", "org/", "allow")),
        ("http://xorg/", ("xorg", "/", None, "allow")),
        ("http://a.EXAMPLE.org/es/1://x", ("a.example.org", "/es/1://x", "example.org/es/", "block")),
        ("http://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")),
        ("http://notexample.org/en/12", ("notexample.org", "/en/12", "org/", "allow")),
        ("x://a.com?p=/de/", ("a.com", "", None, "allow")),
        ("x://a.com#/de/", ("a.com", "", None, "allow")),
        ("http://a.com/DE/", ("a.com", "/DE/", None, "allow")),
    ],
)
def test_host_path_and_rules(spark, url, row):
    assert judged(spark, [(url, None)]) == [row]


def test_trust_and_distrust_spread_over_links(spark):
    link = lambda *to: "".join(f'<a class=c href="{t}">x</a> <A HREF=\'/own\'>y</A>' for t in to)
    rows = [
        ("http://good.com/fr/1", link("http://friend.net/a", "//friend.net/b")),
        ("http://bad.com/de/1", None),
        ("http://friend.net/", link("http://far.net/")),
        ("http://far.net/", ""),
        ("http://farm.net/", link("http://BAD.com/x", "http://bad.com/y")),
        ("http://feeder.net/", link("http://farm.net/")),
        ("http://alone.net/", link("/here")),
        ("http://both.com/de/1", None),
        ("http://both.com/fr/1", None),
        ("http://both.com/x", None),
        ("http://bad.com/x", None),
    ]
    verdicts = {(r[0], r[1]): r[3] for r in judged(spark, rows)}
    blocked = {k for k, v in verdicts.items() if v == "block"}
    assert blocked == {("bad.com", "/de/1"), ("bad.com", "/x"), ("farm.net", "/"), ("feeder.net", "/"), ("both.com", "/de/1")}


def test_verdicts_do_not_depend_on_how_small_masses_are(spark):
    """Four hosts in a row, each with a ten-thousandth of the links to the next; with and without many other pages."""
    names = ["bad.com", "a.net", "b.net", "c.net", "d.net"]
    rows = [("http://bad.com/de/1", None)]
    for to, own in zip(names, names[1:]):
        rows += [(f"http://{own}/", f"<a href='http://{to}/'>x</a>"), (f"http://crowd-{own}/", f"<a href='http://{to}/'>x</a>" * 9999)]
    rows += [("http://both.com/de/1", None), ("http://both.com/fr/1", None), ("http://near.net/", "<a href='http://both.com/'>x</a>")]
    few = judged(spark, rows)
    blocked = {h for h, _, _, v in few if v == "block"}
    assert blocked == {"both.com", *names, *(f"crowd-{n}" for n in names[1:])} | {"near.net"}
    many = judged(spark, rows + [("http://other.org/", None)] * 20000)
    assert many[: len(rows)] == few


def test_masses_equal_plain_iteration(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "a", 1), ("c", "a", 3), ("d", "c", 1)]
    seeds = [("trust", "a", 0.5), ("distrust", "c", 0.5)]
    got = {(r["kind"], r["host"]): r["mass"] for r in U.spread_masses(spark.createDataFrame(seeds, "kind string, host string, mass double"), spark.createDataFrame(edges, "src string, dst string, links long")).collect()}
    for kind, flip in (("trust", False), ("distrust", True)):
        arcs = [(d, s, n) if flip else (s, d, n) for s, d, n in edges]
        start = {h: m for k, h, m in seeds if k == kind}
        mass = dict(start)
        for _ in range(500):
            new = {h: (1 - U.DAMPING) * m for h, m in start.items()}
            for s, d, n in arcs:
                new[d] = new.get(d, 0) + U.DAMPING * mass.get(s, 0) * n / sum(x for a, _, x in arcs if a == s)
            mass = new
        for h in "abcd":
            assert got.get((kind, h), 0) == pytest.approx(mass.get(h, 0), abs=1e-9)


def test_a_chain_of_sixty_hosts_and_a_cycle_equal_the_exact_solution_and_the_sql(spark, tmp_path):
    """Trust and distrust from both ends of a long chain, with links back; the last hosts are 60 links away."""
    import duckdb
    import numpy as np

    n = 60
    names = ["good.com"] + [f"h{k:02}.net" for k in range(1, n)] + ["bad.com"]
    html = {h: f"<a href='http://{to}/'>x</a>" for h, to in zip(names, names[1:])}
    html["h07.net"] += "<a href='http://h03.net/'>back</a>"
    html["h40.net"] += "<a href='http://h55.net/'>on</a>" * 2
    rows = [(k, f"http://{h}/" + {"good.com": "fr/", "bad.com": "de/"}.get(h, ""), html.get(h)) for k, h in enumerate(names)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # some two hundred rounds over a few rows
    try:
        got = {r["host"]: r["verdict"] for r in U.judge(df.coalesce(1), spark.sql(RULES)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    at = {h: k for k, h in enumerate(names)}
    a = np.zeros((n + 1, n + 1))
    for h, text in html.items():
        for to in text.split("http://")[1:]:
            a[at[to.split("/")[0]], at[h]] += 1
    solve = lambda m, seed: np.linalg.solve(np.eye(n + 1) - U.DAMPING * m, (1 - U.DAMPING) * np.eye(n + 1)[seed] * 0.5)
    share = lambda m: m / np.maximum(1, m.sum(0))
    trust, distrust = solve(share(a), 0), solve(share(a.T), n)
    want = {h: "block" if d > t * (1 + U.EQUAL) else "allow" for h, t, d in zip(names, trust, distrust)}
    want |= {"good.com": "allow", "bad.com": "block"}
    assert got == want and {"allow", "block"} == {want[h] for h in names[1:n]}
    df.write.parquet(str(tmp_path / "pages"))
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages/*.parquet'")
    assert {r[1]: r[4] for r in db.execute(U._sql()).fetchall()} == want


def test_empty_table_and_repeats(spark):
    assert judged(spark, []) == []
    assert judged(spark, [("http://a.org/", None)] * 2) == [("a.org", "/", "org/", "allow")] * 2
