import random

import pytest

from forecourt.llm import licenses as L


def test_increasing_is_a_longest_one():
    r = random.Random(2)
    for _ in range(100):
        v = r.sample(range(30), r.randint(0, 12))
        best = 0
        for mask in range(1 << len(v)):
            picked = [x for k, x in enumerate(v) if mask >> k & 1]
            if picked == sorted(picked):
                best = max(best, len(picked))
        got = L.increasing(v)
        assert len(got) == best and [v[k] for k in got] == sorted(v[k] for k in got)


def longest(a, b):
    """Length of a longest common subsequence, by the table."""
    above = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for k, y in enumerate(b):
            row.append(above[k] + 1 if x == y else max(above[k + 1], row[-1]))
        above = row
    return above[-1]


def plain(a, b):
    """Patience alignment by its definition, recursively; a longest common subsequence where no word is unique in both."""
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + plain(a[1:], b[1:])
    if a[-1] == b[-1]:
        return 1 + plain(a[:-1], b[:-1])
    both = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    if not both:
        return longest(a, b)
    at = L.increasing([y for _, y in both])
    total, i, j = 0, 0, 0
    for x, y in [both[k] for k in at]:
        total += 1 + plain(a[i:x], b[j:y])
        i, j = x + 1, y + 1
    return total + plain(a[i:], b[j:])


def test_align_equals_the_definition():
    r = random.Random(5)
    for _ in range(300):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 14))] for _ in range(2))
        got = L.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert len(got) == plain(a, b)


@pytest.mark.parametrize("name", L.TEMPLATES)
def test_every_template_is_found_whole_and_changed(name):
    scanner = L.Scanner(L.TEMPLATES)
    template = L.words(L.TEMPLATES[name])
    around = [f"w{i}" for i in range(3000)]
    assert (name, 3000, 3000 + len(template), 1.0) in scanner.find(around + template + around)
    cut = template[: len(template) // 2] + template[len(template) // 2 + 1 :]
    if len(cut) >= 0.8 * len(template):
        assert any(f[0] == name and f[3] == len(cut) / len(template) for f in scanner.find(around + cut + around))
    twice = [f for f in scanner.find(template + template) if f[0] == name]
    assert [(f[1], f[2]) for f in twice] == [(0, len(template)), (len(template), 2 * len(template))]


def test_seed_pruning_loses_no_finding():
    """Every window of every offset, aligned without pruning, finds nothing more."""
    r = random.Random(8)
    template = [f"t{i}" for i in range(12)] + ["the", "of"] * 3
    scanner = L.Scanner({"x": " ".join(template)}, 0.8)
    for _ in range(60):
        text = list(template)
        for _ in range(r.randint(0, 5)):
            k = r.randrange(len(text))
            if r.random() < 0.5:
                del text[k]
            else:
                text.insert(k, r.choice(["zz", "the", "of"]))
        text = ["a"] * r.randint(0, 30) + text + ["b"] * r.randint(0, 30)
        size, drift = len(template), len(template) // 4
        best = max((len(L.align(text[max(0, s - drift // 2) : s + size + drift - drift // 2], template)) for s in range(-size, len(text))), default=0)
        found = scanner.find(text)
        if best >= 0.8 * size + 1:
            assert found
        assert all(f[3] * size <= best + 1e-9 for f in found)


def test_rows(docs, by_id):
    rows = [(1, None), (2, ""), (3, "…!"), (4, "x Released under the MIT License. y"), (5, "The license is MIT"), (None, "licensed under cc by-nc 4.0")]
    got = L.scan(docs([*rows, rows[3]]))
    assert got.count() == 7
    hits = by_id(got, "n_words", "found")
    assert {k: (n, [f["license"] for f in found]) for k, (n, found) in hits.items()} == {
        1: (0, []), 2: (0, []), 3: (0, []), 4: (7, ["MIT"]), 5: (4, []), None: (7, ["CC-BY-NC-4.0"])
    }
    assert L.scan(docs([])).count() == 0


def test_query_finds_the_planted_lines(spark, by_id):
    from forecourt.llm.common import QUERIES

    folder = "/root/testdata/sf0.01"
    texts = by_id(spark.read.parquet(f"{folder}/documents.parquet"), "text")
    got = by_id(QUERIES["op1_license_scan"](spark, folder), "n_words", "licenses")
    short = {k: " ".join(L.words(v)) for k, v in L.TEMPLATES.items() if len(L.words(v)) < 15}
    for doc, text in texts.items():
        plain = f" {' '.join(L.words(text))} "
        assert got[doc][0] == len(plain.split())
        named = set(got[doc][1].split(","))
        assert all(k in named for k, v in short.items() if f" {v} " in plain)
        if not any(w in plain for w in ("license", "licensed", "software", "permission")):
            assert named == {""}
