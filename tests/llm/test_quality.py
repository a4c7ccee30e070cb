import random
import zlib

import numpy as np
import pytest

from forecourt.llm import quality as Q


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    p = {"W": rng.normal(size=(Q.WIDTH, 3)) / 12, "b": rng.normal(size=3), "V": rng.normal(size=(3, 2)), "U": rng.normal(size=(3, 2)), "w": rng.normal(size=2), "c": rng.normal(size=3), "d": np.array(0.3)}
    x, counts, y = rng.normal(size=(9, Q.WIDTH)), np.array([1, 5, 3]), np.array([1.0, 0.0, 0.5])

    def loss():
        s = Q.forward(p, x, counts)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grad = Q.gradient(p, Q.forward(p, x, counts), y)
    for name in p:
        flat = p[name].reshape(-1)
        for k in range(min(5, len(flat))):
            old = flat[k]
            flat[k] = old + 1e-6
            up = loss()
            flat[k] = old - 1e-6
            down = loss()
            flat[k] = old
            assert (up - down) / 2e-6 == pytest.approx(np.ravel(grad[name])[k], abs=1e-6)


def test_passages_are_whole_and_texts_do_not_mix():
    texts = ["one two", None, "", "A " * 130, " \n ", "é!? 12 12"]
    x, counts = Q.passages(texts)
    assert counts.tolist() == [1, 1, 1, 3, 1, 1]
    for text, part in zip(texts, np.split(x, np.cumsum(counts)[:-1])):
        assert np.array_equal(Q.passages([text])[0], part)
    assert not x[1].any() and not x[2].any() and not x[6].any()
    names = dict(zip(["upper", "lower", "digit", "wide", "mark", "caps", "mixed", "marks", "tail", "stop", "same"], x[-1]))
    assert names["digit"] == pytest.approx(4 / 8) and names["wide"] == pytest.approx(2 / 8) and names["same"] == pytest.approx(1 / 3)
    assert x[3][11] == pytest.approx(1 / 64)


def test_score_of_an_empty_text_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(3)
    texts = ["one two three", "", "A!! " * 200, None, " ", "b c"]
    x, counts = Q.passages(texts * 9)
    weights = Q.fit(x.astype(float), counts, rng.random(len(counts)))
    for given in (["", None], ["", "a b"], ["x " * 300, ""]):
        for text, score in zip(given, Q.predict(weights, *Q.passages(given))):
            assert score == pytest.approx(Q.predict(weights, *Q.passages([text]))[0], abs=1e-12)


def test_forward_equals_a_loop_over_bags():
    """Score by the definition: encode each passage, weigh by gated attention, score the weighted sum."""
    rng = np.random.default_rng(2)
    p = {"W": rng.normal(size=(Q.WIDTH, 4)) / 12, "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "c": rng.normal(size=4), "d": np.array(-0.2)}
    x, counts = rng.normal(size=(12, Q.WIDTH)), np.array([3, 1, 6, 2])
    want, at = [], 0
    for n in counts:
        hidden, weight = [], []
        for row in x[at : at + n]:
            h = np.array([np.tanh(sum(row * p["W"][:, k]) + p["b"][k]) for k in range(4)])
            gate = [np.tanh(h @ p["V"][:, k]) / (1 + np.exp(-(h @ p["U"][:, k]))) for k in range(3)]
            hidden.append(h)
            weight.append(np.exp(sum(g * w for g, w in zip(gate, p["w"]))))
        z = sum(w / sum(weight) * h for w, h in zip(weight, hidden))
        want.append(1 / (1 + np.exp(-(z @ p["c"] + p["d"]))))
        at += n
    assert Q.forward(p, x, counts)["score"] == pytest.approx(want)


def test_training_is_bounded_by_documents_and_bytes(spark, docs):
    rows, labels = corpus(120)
    known = spark.createDataFrame(labels, LABELS)
    whole = Q.train(docs(rows), known, limit_bytes=10**9)
    long = [(i, t + " z" * 300_000) if i % 10 == 0 else (i, t) for i, t in rows]
    short = [(i, t) for i, t in rows if i % 10]
    a, b = Q.train(docs(long), known, limit_bytes=16 * 5000), Q.train(docs(short), known, limit_bytes=16 * 5000)
    assert all(np.array_equal(a.params[k], b.params[k]) for k in a.params) and not np.array_equal(a.params["W"], whole.params["W"])


def corpus(n=400):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = ["".join(r.choice("etaoins") for _ in range(r.randint(2, 8))) for _ in range(r.randint(20, 300))]
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((i, int(good), 0, 1.0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, score double"


def test_held_out_accuracy_and_filter(spark, docs, by_id):
    rows, labels = corpus()
    given, known = docs(rows + [(1000, None), (1001, ""), (1, rows[1][1])]), spark.createDataFrame(labels + [(5, None, 0, 1.0), (None, 1, 0, 1.0)], LABELS)
    weights = Q.train(given, known)
    out = Q.scored(given, weights)
    assert out.columns == [*given.columns, "score_"]
    scores = by_id(out, "score_")
    assert len(scores) == 402 and all(0 <= s <= 1 for s in scores.values()) and scores[1000] == scores[1001]
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and np.mean([(scores[i] >= 0.7) == (i % 3 > 0) for i in held]) > 0.98
    kept = Q.only_good(given, known)
    assert kept.columns == given.columns
    assert {r["doc_id"] for r in kept.collect()} - {1000, 1001} == {i for i, _ in rows if scores[i] >= 0.7}
    assert kept.where("doc_id = 1").count() == 2


def test_held_out_labels_are_never_read(spark, docs):
    rows, labels = corpus(80)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t, s) for i, q, t, s in labels]
    a, b = (Q.train(docs(rows), spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert all(np.array_equal(a.params[k], b.params[k]) for k in a.params)


def test_without_labels_and_rows(spark, docs):
    rows, labels = corpus(10)
    none = spark.createDataFrame([], LABELS)
    assert Q.train(docs(rows), none) is None
    assert {r["score_"] for r in Q.scored(docs(rows), None).collect()} == {0.5}
    assert Q.only_good(docs(rows), none).count() == 10
    assert Q.only_good(docs([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_accuracy_on_the_given_labels(spark, by_id):
    from forecourt.llm.common import QUERIES

    folder = "/root/testdata/sf0.01"
    got = by_id(QUERIES["op6_quality"](spark, folder), "held_out", "score", "predicted")
    assert len(got) == 1000 and all((s >= 0.7) == p for _, s, p in got.values())
    truth = by_id(spark.read.parquet(f"{folder}/labels.parquet"), "quality")
    held = [i for i in truth if got[i][0]]
    assert all(got[i][0] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i][2] == truth[i] for i in held]) >= 0.95
