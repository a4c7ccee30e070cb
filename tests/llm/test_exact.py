import hashlib
import random

import numpy as np
import pytest

from forecourt.llm import exact as X


def classes(rows):
    of = {}
    for i, t in rows:
        of.setdefault(t or "", []).append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in of.items()}
    return sorted(((i, top[t or ""], len(of[t or ""]), i == top[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)


ROWS = [(1, None), (2, ""), (3, "a"), (4, "a "), (5, "a"), (5, "a"), (None, "a"), (None, "null only"), (None, "null only"), (6, "é" * 90_000), (7, "é" * 90_000), (8, "é" * 90_000 + "x")]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_classes_equal_the_definition_and_collisions_are_chained(spark, docs, rows, bits):
    r = random.Random(bits)
    many = ROWS + [(100 + k, f"text {r.randrange(60)}") for k in range(400)] + [(1000 + k, "hot") for k in range(300)]
    assert rows(X.duplicates(docs(many).repartition(5), bits=bits)) == classes(many)


def test_buckets_split_and_hot_ones_get_pages(spark, docs, rows):
    r = random.Random(1)
    many = [(k, r.choice(["hot " * 50, f"{r.randrange(300)} " * 30])) for k in range(2000)]
    df = docs(many).repartition(20)
    keyed = df.select(X.text_key(df.text).alias("key"), X.F.octet_length("text").cast("long").alias("n_bytes"))
    slots, depth, buckets, more = X.directory(keyed, capacity=1000, block_bytes=500)
    assert more and buckets == slots.select("bucket").distinct().count() and depth > 5 and slots.where("pages > 1").count() and slots.select("bucket").distinct().count() > 10
    assert rows(X.duplicates(df, capacity=1000, block_bytes=500)) == classes(many)


def test_directory_doubles_only_where_a_bucket_is_overfull():
    sizes = np.array([9, 1, 1, 1, 0, 0, 2, 2])
    depth, held = X.doubled(sizes, 4)
    assert depth.tolist() == [3, 3, 2, 2, 1, 1, 1, 1] and held.tolist() == [9, 1, 2, 2, 4, 4, 4, 4]
    assert X.doubled(np.array([3, 1]), 4)[0].tolist() == [0, 0] and X.doubled(np.array([3, 2]), 4)[0].tolist() == [1, 1]


def test_index_holds_every_distinct_text_once(spark, docs):
    got = X.build(docs(ROWS)).collect()
    assert sorted(r["text"].decode() for r in got) == sorted({t or "" for _, t in ROWS}) and sum(r["n"] for r in got) == len(ROWS)


def test_empty_table(spark, docs):
    assert X.duplicates(docs([])).collect() == []


def test_ids_of_another_type(spark, rows):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None)], "doc_id string, text string")
    assert [t[:4] for t in rows(X.duplicates(df))] == [("a", "b", 2, False), ("b", "b", 2, True), ("c", "c", 1, True)]
