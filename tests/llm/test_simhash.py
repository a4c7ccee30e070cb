import random
import re

import numpy as np
import pytest
import xxhash

from forecourt.llm import simhash as S


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def grouped(ids, near):
    """Smallest id reachable."""
    root = {i: i for i in ids}

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and near(a, b):
                x, y = of(a), of(b)
                root[max(x, y)] = min(x, y)
    return {i: of(i) for i in ids}


def test_fingerprints_equal_the_definition(docs, by_id):
    rows = [(1, "The QUICK brown fox jumps"), (2, "a b"), (3, ""), (4, None), (5, "É x y\tz\nw É"), (6, "word " * 3000 + "end")]
    got = by_id(S.fingerprints(docs(rows)), "fp")
    assert {k: v % 2**64 for k, v in got.items()} == {i: fingerprint(t) for i, t in rows}
    assert got[3] == got[4] == 0


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_bit_sliced_pairs_equal_all_pairs(radius):
    r = random.Random(radius)
    fps, unit = [], []
    for u in range(30):
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 63, 64, 65, 130])):
            fps.append(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
            unit.append(u)
    found = list(S.close_pairs(np.array(fps, np.uint64), np.array(unit), radius))
    a, b = (np.concatenate(x) for x in zip(*found))
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if unit[i] == unit[j] and (fps[i] ^ fps[j]).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_a_dense_unit_joins_its_links_without_holding_them():
    """8192 fingerprints of which nearly all pairs are links: some 33 million, of which few are made."""
    import tracemalloc

    r = random.Random(4)
    fps = sorted({sum(1 << b for b in r.sample(range(40), r.randint(0, 2))) for _ in range(60_000)})[:8192]
    fps += [r.getrandbits(64) | 1 << 63 for _ in range(300)]
    doc = np.array(r.sample(range(10**6), len(fps)))
    tracemalloc.start()
    to = S.roots(doc, np.array(fps, np.uint64), np.zeros(len(fps), np.int64), 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    close = len(fps) - 300
    assert set(to[:close]) == {doc[:close].min()} and (to[close:] == doc[close:]).all()


@pytest.mark.parametrize("radius", [1, 4])
def test_roots_equal_components(radius):
    r = random.Random(radius)
    fps, unit = [], []
    for u in range(12):
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 64, 65, 200])):
            base ^= 1 << r.randrange(64) if r.random() < 0.7 else r.getrandbits(64)
            fps.append(base)
            unit.append(u)
    doc = r.sample(range(10**6), len(fps))
    of = dict(zip(doc, zip(fps, unit)))
    want = grouped(sorted(doc), lambda a, b: of[a][1] == of[b][1] and (of[a][0] ^ of[b][0]).bit_count() <= radius)
    assert S.roots(np.array(doc), np.array(fps, np.uint64), np.array(unit), radius).tolist() == [want[d] for d in doc]


@pytest.mark.parametrize("chunk", [S.CHUNK, 7])
def test_links_connect_all_that_are_close_also_in_split_buckets(spark, chunk):
    r = random.Random(3)
    fps = {r.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(20):
            f ^= 1 << r.randrange(64)
            fps.add(f)
    fps = dict(enumerate(sorted(fps)))
    signed = lambda x: x - 2**64 if x >> 63 else x
    classes = spark.createDataFrame([(i, signed(f)) for i, f in fps.items()], "doc long, fp long")
    found = {x["node"]: x["root"] for x in S.components(S.links(classes, 4, chunk)).collect()}
    want = grouped(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert {i: found.get(i, i) for i in fps} == want


def test_long_chains_reach_their_smallest_node(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100), (100, 99)], "u long, v long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100: 99, 101: 99}


def test_one_of_each_group_stays(docs):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text), (3, text), (4, text.replace("w7 ", "w7  ")), (9, "quite another text about nothing"), (9, "quite another text about nothing"), (8, None), (7, ""), (None, text), (None, None)]
    given = docs(rows)
    left = S.one_of_each(given)
    assert left.columns == given.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted([3, 9, 7, None, None], key=repr)


def test_empty_table_and_null_ids(docs):
    assert S.near_duplicates(docs([])).count() == 0
    got = [(r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs([(None, "a b c"), (2, "a b c"), (None, "other words")])).collect()]
    assert sorted(got, key=repr) == sorted([(None, 2), (2, 2), (None, None)], key=repr)


def test_query_equals_brute_force(spark, by_id):
    from forecourt.llm.common import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    fps = {i: fingerprint(t) for i, t in texts.items()}
    roots = grouped(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    got = by_id(QUERIES["op9_simhash"](spark, folder), "fingerprint", "component_id")
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
