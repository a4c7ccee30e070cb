import hashlib
import random

import pyarrow as pa
import pytest

from forecourt.llm import suffixes as X


def brute(rows):
    big = 2**63 - 1
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - X.SPAN + 1):
            s = data[i : i + X.SPAN]
            first[s] = min(first.get(s, big), big if doc is None else doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - X.SPAN + 1):
            if first[data[i : i + X.SPAN]] < (big if doc is None else doc):
                gone[i : i + X.SPAN] = b"\1" * X.SPAN
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(seed, n=160):
    r = random.Random(seed)
    words = ["".join(r.choice("abcde") for _ in range(r.randint(1, 6))) for _ in range(50)]
    base = [" ".join(r.choice(words) for _ in range(150)) for _ in range(4)]
    out = []
    for doc in range(n):
        text = ""
        for _ in range(r.randint(0, 5)):
            kind, b = r.random(), r.choice(base)
            at = r.randint(0, len(b))
            text += b[at : at + r.randint(1, 300)] if kind < 0.5 else r.choice(["ab", "\0", "é", "日"]) * r.randint(1, 60) if kind < 0.7 else "".join(r.choice("xyz ") for _ in range(80))
        out.append((doc, text))
    line = "a line that very many of the documents have in common, word for word, up to here"
    return out + [(1000 + k, f"{line} {k}") for k in range(60)]


def result(rows):
    return sorted(((r["doc_id"], *(r[c] for c in r.asDict() if c in NAMES)) for r in rows), key=repr)


NAMES = {"n_bytes_", "n_removed", "n_spans", "kept_sha256"}
CASES = [(2, "same " * 30), (1, "same " * 30), (2, "same " * 30), (None, "same " * 30), (None, "other text " * 9), (None, "other text " * 9), (3, None), (4, ""), (5, "x" * 49), (6, "x" * 50), (7, "y" * 200000), (8, "y" * 60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(docs, seed):
    rows = texts(seed) + [(i + 5000 if i is not None else None, t) for i, t in CASES]
    got = X.deduplicate(docs(rows), block_bytes=4000, bucket_bytes=3000)
    assert result(got.collect()) == brute(rows)


def test_columns_pass_and_texts_are_cut(docs):
    line = "this sentence of more than fifty bytes stands in two of the documents here"
    left = X.deduplicate(docs([(1, f"first {line}."), (2, f"é {line} ü")]))
    assert left.columns[:8] == ["doc_id", "text", "lang", "n_chars", "score", "block", "Spans", "n_bytes"]
    assert {r["doc_id"]: (r["text"], r["n_bytes"]) for r in left.collect()} == {1: (f"first {line}.", "b"), 2: ("é ü", "b")}
    assert X.deduplicate(docs([])).count() == 0


def local(rows, blocks, buckets):
    """The four steps without Spark, so that the limits can be small."""
    by_block = {}
    for doc, text in rows:
        by_block.setdefault(hash(doc) % blocks, []).append((doc, text))
    made = {b: X.Block(pa.table({"doc_id": pa.array([d for d, _ in r], pa.int64()), "text": pa.array([t for _, t in r], pa.string()), "b": pa.array([b] * len(r), pa.int64())}), "b") for b, r in by_block.items()}
    group = lambda t, c: {k: t.filter(pa.compute.equal(t[c], k)) for k in set(t[c].to_pylist())}
    sent = pa.concat_tables([X._sent_heads(b, buckets) for b in made.values()])
    answers = pa.concat_tables([X._answered_heads(t) for t in group(sent, "bucket").values()])
    of = group(answers, "block")
    found = pa.concat_tables([X._sent_runs(b, of.get(k, answers.slice(0, 0)), buckets) for k, b in made.items()])
    covers = pa.concat_tables([X._judged(t) for t in group(found, "bucket").values()])
    of = group(covers, "block")
    done = [X._cut(b, of.get(k, covers.slice(0, 0)), "b", X.ADDED) for k, b in made.items()]
    return sorted((tuple(r[c] for c in ["doc_id", *X.ADDED]) for t in done for r in t.to_pylist()), key=repr), set(found["kind"].to_pylist())


@pytest.mark.parametrize("hot", [0, 2, 10**9])
def test_hot_heads_small_batches_and_slices_change_nothing(monkeypatch, hot):
    for name, value in (("HOT", hot), ("BATCH", 40), ("SLICE", 300)):
        monkeypatch.setattr(X, name, value)
    rows = texts(3)
    got, kinds = local(rows, 5, 4)
    assert got == brute(rows)
    assert kinds == {0: {"s", "c"}, 2: {"r", "s", "c"}, 10**9: {"r", "c"}}[hot]


@pytest.mark.parametrize("runs", [32767, 32768, 65536, 98304])
def test_many_runs_of_a_head_in_one_block_alone(runs):
    """Each byte of a text of blanks is a run of one head; the block's runs of it add up to ``runs``."""
    half = runs // 2
    rows = [(1, " " * (half + X.SPAN - 1)), (2, " " * (runs - half + X.SPAN - 1)), (3, "of its own: " + "".join(map(str, range(60))))]
    got, kinds = local(rows, 1, 4)
    assert kinds == {"s", "c"}
    assert [r[2] for r in got] == [0, len(rows[1][1]), 0]
    assert got == brute(rows)


def test_family_levels_grow_geometrically():
    import numpy as np

    r = random.Random(4)
    keys = np.array([f"{r.randrange(3000):05d}" for _ in range(5000)], "S5")
    doc = np.array([r.randrange(900) for _ in range(5000)])
    first = {}
    for k, d in zip(keys, doc):
        first[k] = min(first.get(k, d), d)
    assert X.known_before(keys, doc, 50).tolist() == [bool(first[k] < d) for k, d in zip(keys, doc)]
    family = X.Family()
    for at in range(0, 64):
        family.add(np.array([f"{at:05d}"], "S5"))
        assert all(len(a) > 2 * len(b) for a, b in zip(family.levels, family.levels[1:]))


def test_strings_of_a_bucket_are_held_some_heads_at_a_time():
    """60 000 runs of shared heads have some two million strings; a fraction of them is held at once."""
    import tracemalloc

    import numpy as np

    r = random.Random(6)
    heads = ["".join(r.choice("abcdefgh") for _ in range(X.HEAD)).encode() for _ in range(600)]
    keys = np.zeros((60_000, X.WIDE + 2), np.uint8)
    for k in range(len(keys)):
        place, tail = 34, bytes(r.choices(b"xy", k=X.WIDE))
        keys[k, : X.WIDE] = np.frombuffer(tail[:place] + r.choice(heads) + tail, np.uint8)[: X.WIDE]
        keys[k, X.WIDE :] = place, X.PLACES
    doc = np.array([r.randrange(10**6) for _ in range(len(keys))])
    keys = keys.view(f"S{X.WIDE + 2}")[:, 0]
    tracemalloc.start()
    whole, of, offset = X._judged_runs(keys, doc)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90 << 20  # all strings at once take over 100 MB, and several times that to sort
    some = set(r.sample(range(len(keys)), 200))
    rows = keys.view(np.uint8).reshape(-1, X.WIDE + 2)
    first = {}
    for k in range(len(keys)):
        for o in range(X.PLACES):
            s = rows[k, o : o + X.SPAN].tobytes()
            first[s] = min(first.get(s, 10**9), doc[k])
    hit = set(zip(of.tolist(), offset.tolist())) | {(k, o) for k in whole.tolist() for o in range(X.PLACES)}
    for k in some:
        for o in range(X.PLACES):
            assert ((k, o) in hit) == (first[rows[k, o : o + X.SPAN].tobytes()] < doc[k])


def test_a_text_longer_than_a_block(docs):
    r = random.Random(9)
    long = " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randrange(10**6)) for _ in range(25_000))
    rows = [(1, long), (2, "new: " + long[100_000:200_000]), (None, long[-70_000:]), (None, long[:60])]
    assert len(long) > 250_000
    assert result(X.deduplicate(docs(rows), block_bytes=20_000, bucket_bytes=20_000).collect()) == brute(rows)
