import random

import pytest

from forecourt.llm import hamming as H

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    width = max((len(v) for _, v in rows if v is not None), default=0)
    code = {(i, tuple(1 if x is not None and x > 0 else 0 for x in (*v, *[0] * (width - len(v))))) for i, v in rows if v is not None}
    out = []
    for q, c in code:
        if q % 100 == 0:
            near = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in code)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def search(spark, rows, k):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    return sorted(tuple(r) for r in H.top_k(df, df.where("vec_id % 100 = 0"), k).collect())


@pytest.mark.parametrize("width, k", [(64, 5), (20, 3)])
def test_equals_brute_force(spark, width, k):
    r = random.Random(width)
    rows = [(i, [r.gauss(0, 1) for _ in range(width)]) for i in range(350)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # many equal codes, one of them asked for
    assert search(spark, rows, k) == brute(rows, k)


def test_nulls_repeats_short_vectors_and_few_rows(spark):
    rows = [(0, [1.0, -1.0, None]), (0, [1.0, -1.0, None]), (100, None), (7, [1.0]), (8, None), (200, []), (9, [0.0, 0.0, 0.0, 2.0])]
    assert search(spark, rows, 10) == brute(rows, 10)
    assert search(spark, [(100, None)], 3) == []
    assert search(spark, [], 3) == []
