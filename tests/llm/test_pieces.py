import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece

from forecourt.llm import pieces as P

TEXTS = [None, "", " ", "a", "  two  spaces ", "line\nbreak\t tab", "été Œuvre 日本語 𝄞 \x00 end", "x" * 3000, "ab" * 50 + " " * 40 + "c", "<s> <0x0A> </s> <unk>", "the " * 500, "é   ﬁ"]


@pytest.fixture(scope="module")
def model():
    return P.load(P.default_model())


def encode(texts, model):
    ids, counts = P.encode(texts, model, re.compile(model.words, re.DOTALL))
    return [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]


def viterbi(word, model, pieces):
    """Best total score of one word, one character at a time."""
    worst = min(model.scores[i].min() for i in model.ids.values()) - 10
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for k in range(1, min(16, end) + 1):
            piece = word[end - k : end]
            score = pieces.get(piece, worst if k == 1 else -np.inf)
            best[end] = max(best[end], best[end - k] + score)
    return best[-1]


def test_scores_equal_a_plain_viterbi_and_the_librarys_lattice(model):
    """The library takes its exact lattice for n-best lists of a unigram model, so the model is marked as one."""
    path = P.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {library.id_to_piece(i): library.get_score(i) for ids in model.ids.values() for i in ids.tolist()}
    with open(path, "rb") as file:
        raw = file.read()
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01", 1))
    r = random.Random(1)
    words = ["".join(r.choice("etaoinshrdlu,.é") for _ in range(r.randint(1, 14))) for _ in range(400)] + ["the", "hested", "understanding", "Versicherung"]
    for word, ids in zip(words, encode(words, model)):
        score = sum(library.get_score(i) for i in ids)
        assert score == viterbi(P.SPACE + word, model, pieces)
        assert score == sum(library.get_score(i) for i in unigram.nbest_encode_as_ids(word, nbest_size=2)[0])


def test_round_trip(model):
    coded = encode(TEXTS, model)
    assert coded[0] == coded[1] == []
    flat, counts = np.array([i for c in coded for i in c]), np.array([len(c) for c in coded])
    assert P.decode(flat, counts, model) == [t or "" for t in TEXTS]
    library = sentencepiece.SentencePieceProcessor(model_file=P.default_model())
    assert [library.decode(c) for c in coded] == [t or "" for t in TEXTS]


def test_a_batch_codes_like_its_texts_alone(model):
    assert encode(TEXTS, model) == [encode([t], model)[0] for t in TEXTS]


def test_other_normalisers_are_refused(tmp_path):
    with open(P.default_model(), "rb") as file:
        raw = file.read()
    other = tmp_path / "m.model"
    other.write_bytes(raw.replace(b"\x18\x01\x20\x00\x32\x00", b"\x18\x01\x20\x01\x32\x00"))
    with pytest.raises(ValueError):
        P.load(str(other))


def test_frames(docs, model):
    rows = list(enumerate(TEXTS)) + [(3, "a"), (None, "null id")]
    coded = P.encoded(docs(rows), P.default_model())
    back = P.decoded(coded, P.default_model())
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=repr) == sorted([(i, t or "") for i, t in rows], key=repr)
    digest = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["round_trip"]) for r in P.encoded(docs(rows), P.default_model(), digest=True).collect()}
    assert digest == {(i, len(c), hashlib.sha256(np.array(c, "<i4").tobytes()).hexdigest(), True) for (i, _), c in zip(rows, encode([t for _, t in rows], model))}
    empty = P.encoded(docs([]), P.default_model())
    assert empty.count() == 0 and P.decoded(empty, P.default_model()).count() == 0
    nothing = coded.sparkSession.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in P.decoded(nothing, P.default_model()).collect()} == {1: None, 2: ""}


def test_long_words_take_the_same_pieces_one_by_one(model, monkeypatch):
    r = random.Random(5)
    words = ["".join(r.choice("etaoinshrdlu,.é日𝄞") for _ in range(r.randint(1, 90))) for _ in range(300)] + ["a", "aaaaaaaaaaaaaaaaa", "the" * 30]
    ids, count = P.segment(words, model)
    for word, part in zip(words, np.split(ids, np.cumsum(count)[:-1])):
        assert P.segment_long(word, model).tolist() == part.tolist()
    texts = [" ".join(r.sample(words, 9)) for _ in range(30)] + [None, "", "".join(words)]
    whole = encode(texts, model)
    monkeypatch.setattr(P, "LONG", 20)
    assert encode(texts, model) == whole
    monkeypatch.setattr(P, "LONG", 0)
    assert encode(texts, model) == whole


def test_a_million_characters_without_a_space(model):
    import time

    r = random.Random(6)
    text = "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    start = time.perf_counter()
    (ids,) = encode([text], model)
    assert time.perf_counter() - start < 20
    assert P.decode(np.array(ids), np.array([len(ids)]), model) == [text]
