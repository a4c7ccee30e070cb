import pytest

from forecourt.llm import html as H


@pytest.mark.parametrize(
    "page, text, marked",
    [
        (None, [], False),
        ("", [], False),
        ("plain  words\n here", ["plain words here"], False),
        ("<nav>menu</nav><article><h1>T</h1><p>a <b>b</b>c<br>d</p></article><footer>f</footer>", ["T", "a bc", "d"], True),
        ("<article><p>x &amp y &lt;z&gt; &#233;&am</article>", ["x & y <z> é&am"], True),
        ("<main><header>kept</header><form>no</form><aside>no</aside><p>yes<!-- no -->!</p></main>rest", ["kept", "yes!"], True),
        ("<article><p>one<div class='comments'>no</div><div id=ad>no</div><p>two", ["one", "two"], True),
        ("<header>no</header><div>yes<script>if (a < b) '<p>no'</script> more</div><div class='cookie-notice'>no</div>", ["yes more"], False),
        ("<article>a <svg><text>no</text></svg>b<style>p{}</style> c</article>", ["a b c"], True),
        ("<article>open<script>never closed <p>no", ["open"], True),
        ("<article>5 < 6 and <b", ["5 < 6 and"], True),
        ("<div><p>a<p>b<li>c<li>d</div><img src='x>y'>e", ["a", "b", "c", "d", "e"], False),
        ("<article><a title='a > b'>link</a></article><article>second</article>", ["link", "second"], True),
        ("<body class='sidebar'><p>kept</p><div class='sidebar'>no</div></body>", ["kept"], False),
    ],
)
def test_blocks(page, text, marked):
    assert H.blocks(page) == (text, marked)


def test_suffix_groups_equal_all_runs():
    import random

    r = random.Random(1)
    streams = [[[r.choice("abc") for _ in range(r.randint(1, 12))] for _ in range(r.randint(0, 4))] for _ in range(12)]
    want = {}
    for page, blocks in enumerate(streams):
        at = 0
        for block in blocks:
            for i in range(len(block) - 2):
                want.setdefault((" ".join(block[i : i + 3]), page), []).append(at + i)
            at += len(block)
    got = {(run, page): places for run, page, places in H.suffix_groups(streams, 3)}
    assert got == want
    assert H.suffix_groups([], 3) == []


def test_repeats_of_a_host_go_and_unique_runs_stay(spark):
    line = "sign up for our weekly letter and never miss a thing"
    rows = [(i, f"http://h.org/{i}", f"<div>{line}</div><p>text number {i} of this page is its own</p><p>{line} then something new for page {i}</p>") for i in range(3)]
    rows += [(10, "http://other.org/", f"<p>{line}</p>"), (11, None, None), (12, None, f"<p>{line}</p>"), (12, None, f"<p>{line}</p>"), (13, "http://h.org/x", f"<article>{line}</article>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, key int")
    got = sorted((r["page_id"], r["text"]) for r in H.extract(df).collect())
    assert got == [
        *[(i, f"text number {i} of this page is its own then something new for page {i}") for i in range(3)],
        (10, line),
        (11, ""),
        (12, line),
        (12, line),
        (13, line),
    ]
    assert H.extract(df.limit(0)).count() == 0


def _brute(rows, share=0.25):
    """Texts of pages without marks, from (page_id, host, blocks), by the definition: every block, every beginning and end
    of a block and every string of 24 tokens looked up in all different texts of the host."""
    out = []
    for page, host, texts in rows:
        others = [[b.split() for b in x] for x in {tuple(x) for _, h, x in rows if h == host}]
        least = max(2, -(-len(others) * share // 1))
        many = lambda test: sum(map(test, others)) >= least
        known = {tuple(b) for x in others for b in x if len(b) >= 8 and many(lambda y, b=b: b in y)}
        left = []
        for block in texts:
            t = block.split()
            gone = set()
            if many(lambda y: t in y):
                continue
            for n in range(8, len(t)):
                gone |= set(range(n)) if tuple(t[:n]) in known else set()
                gone |= set(range(len(t) - n, len(t))) if tuple(t[-n:]) in known else set()
            for i in range(len(t) - 23):
                if many(lambda y: any(b[j : j + 24] == t[i : i + 24] for b in y for j in range(len(b) - 23))):
                    gone |= set(range(i, i + 24))
            left += [x for i, x in enumerate(t) if i not in gone]
        out.append((page, " ".join(left)))
    return sorted(out)


def test_pages_without_marks_equal_brute_force(spark):
    import random

    r = random.Random(5)
    menu = ["Home", "About us", "Contact", "Sign in"]
    rows = []
    for page in range(24):
        host = f"h{page % 9}.org"  # hosts of two and three pages
        own = [" ".join(r.choice("abcdefgh") + str(r.randrange(40)) for _ in range(r.randint(1, 14))) for _ in range(r.randint(0, 4))]
        by = ["by Kim Lee", f"{page} comments"]
        tail = ["read the terms of use and", "our privacy notice before you go on"]
        texts = menu + by + own + r.choice([[], ["Ok"], [f"only{page}"]]) + [f"More of it {r.randrange(3)} and so on to the very end of part {page}"] + tail
        rows.append((page, host, texts))
    rows += [(100, "solo.org", menu), (101, "twice.org", menu), (101, "twice.org", menu), (102, "pair.org", ["Ok", "a b c d e f g", "one"]), (103, "pair.org", ["b c", "d e f g x", "Ok"])]
    df = spark.createDataFrame([(p, f"http://{h}/{p}", "".join(f"<{t}>{b}</{t}>" for b, t in zip(x, ["li", "div", "p"] * len(x)))) for p, h, x in rows], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in H.extract(df.repartition(5)).collect())
    assert got == _brute(rows)
    left = dict(got)
    assert not any("Home" in t or "Kim" in t for p, t in got if p < 24) and all(f"{p} comments" in left[p] for p in range(24))
    assert left[100] == left[101] == " ".join(menu) and left[102] == "a b c d e f g one" and left[103] == "b c d e f g x"


def test_long_repeats_inside_blocks_and_hosts_of_many_texts(spark):
    """Repeats inside blocks, and what a few of a host's many texts share, which stays."""
    import random

    r = random.Random(6)
    word = lambda: r.choice("abcdefghij") + str(r.randrange(60))
    notice = [word() for _ in range(40)]
    lead = [word() for _ in range(11)]
    quote = [word() for _ in range(30)]
    rows = []
    for page in range(20):
        own = [word() for _ in range(r.randint(0, 30))]
        at = r.randint(0, 10)
        texts = [" ".join(own[:9] + notice[at : at + 24 + r.randint(0, 6)] + own[9:]), " ".join(lead), " ".join(lead + own[:5] + ["tail"]), " ".join([str(page)] + own[-5:] + lead)]
        texts += [" ".join(quote)] if page < 4 else []
        rows.append((page, "many.org", [t for t in texts if t]))
    rows += [(page, "copies.org", ["the same page in many copies", "all of it"]) for page in range(50, 60)]
    df = spark.createDataFrame([(p, f"http://{h}/{p}", "".join(f"<p>{b}</p>" for b in x)) for p, h, x in rows], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in H.extract(df.repartition(4)).collect())
    assert got == _brute(rows)
    left = dict(got)
    assert all(" ".join(quote) in left[p] for p in range(4)) and not any(" ".join(notice[10:30]) in t for t in left.values())
    assert left[55] == "the same page in many copies all of it"


def test_marked_articles_are_compared_with_those_of_their_host(spark):
    """What nearly all articles of a host hold goes from them; what some share, and near copies, stay."""
    import random

    r = random.Random(8)
    words = lambda n: [r.choice("abcdefghij") + str(r.randrange(90)) for _ in range(n)]
    notice, lead, some, few, common = words(30), words(10), words(12), words(9), words(60)
    rows = []
    for page in range(8):
        own = words(r.randint(70, 90))
        texts = [" ".join(own[:40]), "Share this", " ".join(own[40:50] + notice + own[50:60]), " ".join(own[60:])]
        texts += [" ".join(lead)] * (page != 3) + [" ".join(lead + own[:4])] * (page % 2) + [" ".join(some)] * (page < 5) + [" ".join(few)] * (page < 2)
        rows.append((page, "many.org", texts))
    rows += [(20 + k, "near.org", [" ".join(common), f"part {k}", "Share this"]) for k in range(3)]
    rows += [(30 + k, "two.org", [" ".join(lead), " ".join(words(30))]) for k in range(2)]
    rows += [(40 + k, "copies.org", [" ".join(lead), "Share this"]) for k in range(6)]
    rows += [(50, "empty.org", [])]
    page = "<nav>menu</nav><p>outside</p><article>{}</article><p>Share this</p>"
    data = [(p, f"http://{h}/{p}", page.format("".join(f"<p>{b}</p>" for b in x))) for p, h, x in rows]
    data += [(60 + k, f"http://many.org/x{k}", f"<p>{' '.join(few)}</p><p>Page {k} says more</p>") for k in range(3)]  # without a mark
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {x["page_id"]: x["text"] for x in H.extract(df.repartition(5)).collect()}
    want = dict(_brute([x for x in rows if x[1] == "many.org"], 0.75))
    assert {p: got[p] for p in want} == want
    whole = {p: " ".join(x) for p, _, x in rows if p >= 20}
    assert {p: got[p] for p in whole} == whole
    assert [got[60 + k] for k in range(3)] == [f"Page {k} says more" for k in range(3)]
    assert not any("Share this" in got[p] or " ".join(notice) in got[p] or " ".join(lead) in got[p] for p in range(8))
    assert all(" ".join(some) in got[p] for p in range(5)) and " ".join(few) in got[1]


def test_anchors_are_in_every_long_string():
    import random

    r = random.Random(7)
    for _ in range(40):
        tokens = [r.choice("abc") for _ in range(r.randint(0, 60))]
        places = [p for p, _ in H.anchors(tokens)]
        assert all(any(i <= p <= i + H.LONG - H.RUN for p in places) for i in range(len(tokens) - H.LONG + 1))
        want = {min(range(i, i + 17), key=lambda k: (H.digest(tokens[k : k + 8]), k)) for i in range(len(tokens) - 23)}
        assert set(places) == want


def test_given_pages_with_their_marks_renamed_give_their_articles(spark):
    """The same pages with ``article`` and ``main`` made ``div``: at least as many whole articles as marks alone would."""
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    renamed = pages.selectExpr("page_id", "url", r"regexp_replace(html, '<(/?)(article|main)\\b', '<$1div') as html")
    want = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    got = {r["page_id"]: r["text"] for r in H.extract(renamed).collect()}
    assert renamed.where("html like '%<article%'").count() == 0
    assert sum(got[p] == t for p, t in want.items()) >= 0.83 * len(want)


def test_query_gives_the_articles(spark):
    """The given pages mark their articles; their text read off by a plain cut."""
    import re
    from html import unescape

    from forecourt.llm.common import QUERIES

    folder = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in QUERIES["op10_html_text"](spark, folder).collect()}
    assert got.keys() == pages.keys()
    for page, row in got.items():
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", pages[page]["html"])[1]
        plain = re.sub(r"</?(\w+)[^>]*>", lambda m: "" if m[1] == "b" else " ", article)
        assert row["text"] == " ".join(unescape(plain).split())
        assert row["n_chars"] == len(row["text"]) and row["url"] == pages[page]["url"]
