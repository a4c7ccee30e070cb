import random
import re
from collections import Counter

import duckdb
import pytest

from forecourt.llm import divergence as D


def sorted_terms(n, seed):
    r = random.Random(seed)
    return sorted({"".join(r.choice("abé日") for _ in range(r.randint(1, 7))).encode() for _ in range(n)})


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_transducer_maps_terms_to_places_and_back(n):
    terms = sorted_terms(n, n)
    t = D.Transducer.unpack(D.Transducer.build(terms).pack())
    assert t.places(terms).tolist() == list(range(len(terms)))
    assert [t.term(k) for k in range(len(terms))] == terms
    others = [b"", b"zz", "日" * 9, *(x + b"!" for x in terms[:9]), *(x[:-1] for x in terms)]
    others = [x.encode() if isinstance(x, str) else x for x in others]
    assert t.places(others).tolist() == [terms.index(x) if x in terms else -1 for x in others]


def test_transducer_is_minimal():
    def classes(terms):
        """States of the minimal automaton: distinct sets of what may follow a prefix."""
        heads = {t[:k] for t in terms for k in range(len(t) + 1)}
        return len({frozenset(t[len(h) :] for t in terms if t.startswith(h)) for h in heads})

    for n in (1, 30, 200):
        terms = sorted_terms(n, 100 + n)
        assert len(D.Transducer.build(terms).final) == classes(terms)
    with pytest.raises(ValueError):
        D.Transducer.build([b"b", b"a"])


def brute(rows, least, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for x, _, w in docs if x == lang for t in set(w))
        kept = [t for t, n in held.items() if n >= least]
        sources = {s for x, s, _ in docs if x == lang}
        count = {s: Counter(t for x, y, w in docs if (x, y) == (lang, s) for t in w if held[t] >= least) for s in sources}
        count[None] = sum(count.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in count.items()}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][t], p[None][t]), t.encode()) for t in kept if count[s][t] and p[s][t] > p[None][t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out, key=repr)


def corpus(n, seed):
    r = random.Random(seed)
    words = ["the", "The", "é", "É", "日本", "x1y", "don't", "rare" * 50] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [(k, " ".join(r.choices(words, range(1, len(words) + 1), k=r.randint(0, 30))), r.choice(["en", "de", None, ""]), r.choice(["a", "b", "ü", None, "c'"])) for k in range(n)]
    return rows + [(None, None, "only", "alone"), (None, "", "two", "b"), (1, "x", "two", "a"), (1, "x", "two", "a")]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("settings", [{}, {"piece": 3, "round_bytes": 1, "block_bytes": 1, "cells": 4}, {"piece": 5, "cells": 1}])
def test_equals_brute_force(spark, rows, settings):
    given = corpus(150, 3)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in given], SCHEMA + ", n int, term string, number int").repartition(6)
    got = rows(D.audit(df, least=4, **settings))
    assert got == brute(given, 4) and len(got) > 100


def test_empty_tables_and_vocabularies(spark, rows):
    assert D.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    given = corpus(5, 4)
    assert rows(D.audit(spark.createDataFrame(given, SCHEMA), least=1000)) == brute(given, 1000)


def test_shares_are_exact_for_large_counts(spark):
    counts = [(0, 7), (10**13 + 7, 3 * 10**13 + 1), (9 * 10**14, 10**15 - 3), (10**15 - 5, 10**15)]
    df = spark.createDataFrame(counts, "c long, w long").select(D.share(D.F.col("c"), D.F.col("w")))
    assert [r[0] for r in df.collect()] == [1 + 10**9 * (c + 2) // w for c, w in counts]


def test_query_equals_sql(spark):
    db = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    db.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = db.execute(D.SQL).fetchall()
    assert sorted(map(tuple, D.op11(spark, folder).collect())) == sorted(want) and len(want) > 100
