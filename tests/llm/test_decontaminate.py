import re

import pytest
from pyspark.sql import functions as F

from forecourt.llm import decontaminate as D

LONG = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture
def bench(spark):
    rows = [(1, LONG.upper() + "!"), (2, "Short item"), (2, "Short item"), (3, None), (4, " .,; "), (11, "x " + LONG), (5, "été à Œuvre")]
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(docs, items, size=10):
    cut = lambda t: re.findall(D.WORD + "+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for doc, text in docs:
        w = cut(text)
        hit, found = set(), set()
        for item, t in items:
            v = cut(t)
            m = min(size, len(v))
            grams = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
            for i in range(len(w) - m + 1):
                if m and tuple(w[i : i + m]) in grams:
                    hit.update(range(i, i + m))
                    found.add(item)
        out[doc] = (len(w), len(hit), sorted(found))
    return out


ROWS = [
    (1, f"before, {LONG} after"),
    (2, f"{LONG} {LONG} short ITEM end"),
    (3, None),
    (4, ""),
    (5, "nothing here at all"),
    (6, LONG.replace("five", "cinq")),
    (7, "short item short item"),
    (8, "1 été à Œuvre 2 ÉTÉ"),
    (None, "a short-item!"),
    (9, "y " * 30000 + LONG),
]


@pytest.mark.parametrize("most", [D.BROADCAST_WINDOWS, 0])
def test_verdicts_equal_brute_force_on_both_joins(docs, bench, by_id, most):
    got = D.verdicts(docs(ROWS), bench, broadcast_windows=most)
    got = got.select("doc_id", "n_words", D.n_hit(F.col("spans")).alias("h"), F.array_sort("items").alias("items"))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert by_id(got, "n_words", "h", "items") == brute(ROWS, items)


def test_spans_go_and_clean_rows_stay(docs, bench):
    rows = ROWS + [(5, "nothing here at all")]
    given = docs(rows)
    left = D.decontaminate(given, bench, length="n_chars")
    assert left.columns == given.columns
    texts = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in left.collect()), key=repr)
    assert texts.count((5, "nothing here at all", 19)) == 2
    assert (3, None, 0) in texts and (4, "", 0) in texts
    assert not {1, 2, 7} & {i for i, _, _ in texts}  # mostly benchmark
    assert (9, "y " * 30000, 60000) in texts


def brute_cut(text, items, size=10):
    """``text`` without its hit words, each with the gap after it; words are found letter by letter."""
    word = lambda c: c.isascii() and c.isalnum() or ord(c) > 127
    begins = [k for k, c in enumerate(text) if word(c) and not (k and word(text[k - 1]))]
    pieces = [text[a:b] for a, b in zip(begins, begins[1:] + [len(text)])]
    cut = lambda t: re.findall(D.WORD + "+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit = cut(text), set()
    assert len(w) == len(pieces)
    for _, t in items:
        v = cut(t)
        m = min(size, len(v))
        grams = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
        hit.update(k for i in range(len(w) - m + 1) if m and tuple(w[i : i + m]) in grams for k in range(i, i + m))
    return text[: begins[0]] + "".join(p for k, p in enumerate(pieces) if k not in hit)


def test_capitals_stay_with_their_words(docs, bench, by_id):
    filler = "I saw A Big NASA iPhone, OK? And then We went Home to Zürich É ÉTÉ McDonald X2 2X W"
    rows = [
        (1, f"{filler} {LONG} {filler}"),
        (2, f"  «{filler}» {LONG.title()}! {filler}"),
        (3, f"...{LONG.upper()}; {filler} {filler}"),
        (4, f"{filler} {filler} -- oNe Two THREE fOUR Five sIx Seven EIGHT nine TEN Eleven TWELVE"),
        (5, f"{filler}\nSHORT iTem\n{filler}"),
        (6, f"{filler} and {LONG.replace('five', 'FIVES')} and {filler}"),
    ]
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = {i: brute_cut(t, items) for i, t in rows}
    assert want[5] == f"{filler}\n{filler}" and want[6] == rows[5][1]
    assert by_id(D.decontaminate(docs(rows), bench), "text") == want


def test_empty_tables(docs, bench):
    assert D.decontaminate(docs([]), bench).count() == 0
    clean = D.verdicts(docs(ROWS), bench.limit(0)).collect()
    assert len(clean) == len(ROWS) and not any(r["spans"] or r["items"] for r in clean)
