import hashlib
import os
from collections import Counter

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

import sentencepiece  # noqa: E402

from forecourt.llm import alignment as A  # noqa: E402

BYTE_LEVEL, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def coded(text):
    """(ids, end of each token) per tokenizer, by the libraries alone; None if they spell other bytes."""
    full = Tokenizer.from_file(BYTE_LEVEL)
    full.encode_special_tokens = True
    of = A.byte_chars()
    a = full.encode(" " + text, add_special_tokens=False)
    said_a = [bytes(of[c] for c in full.id_to_token(i)) for i in a.ids]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    b = model.encode(text)
    said_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or b"".join(said_a) != (" " + text).encode() or b"".join(said_b) != (" " + text).encode():
        return None
    spans = []
    for said in (said_a, said_b):
        at, out = 0, []
        for s in said:
            out.append((at, at + len(s)))
            at += len(s)
        spans.append(out)
    return a.ids, b, *spans


def brute(rows):
    made, counts = [], Counter()
    for i, text in rows:
        got = coded(text or "")
        if got is None:
            made.append((i, None, [], 0, ""))
            continue
        a, b, at_a, at_b = got
        links = [(x, y) for x, (s, e) in zip(a, at_a) for y, (u, v) in zip(b, at_b) if max(s, u) < min(e, v)]
        counts.update(links)
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        parts, low = [], 0
        for cut in cuts:
            inside = [[str(t) for t, (s, e) in zip(ids, at) if low <= s and e <= cut] for ids, at in ((a, at_a), (b, at_b))]
            parts.append("|".join(map(",".join, inside)))
            low = cut
        made.append((i, (len(a), len(b), len(cuts)), links, len(links), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted(
        ((i, *(sizes or (0, 0, 0)), n, sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha) for i, sizes, links, n, sha in made),
        key=repr,
    )


ROWS = [
    (1, "The quick brown fox, antidisestablishmentarianism!"),
    (2, "The quick brown fox the quick the fox"),
    (3, ""),
    (4, None),
    (5, "naïve Straße — 日本語のテキスト 🙂 x"),
    (6, "a▁b is not the same"),
    (7, " two  spaces\n\n\nand\ttabs "),
    (8, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (9, "\x00\x01 zero"),
    (9, "\x00\x01 zero"),
    (None, "the the The THE tHe"),
    (10, "x" * 700 + "yz" * 300),
    (11, "word " * 400),
]


@pytest.mark.parametrize("block", [1, 60, A.BLOCK])
def test_equals_brute_force(spark, docs, rows, block):
    got, want = rows(A.align(docs(ROWS).repartition(3), BYTE_LEVEL, PIECES, block)), brute(ROWS)
    assert [(g, w) for g, w in zip(got, want) if g != w] == [] and len(got) == len(want)


def test_query_equals_brute_force_on_a_sample_table(spark, docs, rows):
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 700").select("doc_id", "text")
    assert rows(A.align(some, BYTE_LEVEL, PIECES, 5000)) == brute([tuple(r) for r in some.collect()])


def test_both_libraries_agree_where_the_quick_one_is_used():
    with open(BYTE_LEVEL, encoding="utf-8") as file:
        coder = A.ByteLevel(file.read())
    assert coder.quick is not None
    texts = ["".join(map(chr, range(1, 0x530))), " \t\n  x\r\n'll 12 ³ ½  y", "ß" * 999, *(t for _, t in ROWS if t)]
    assert coder.encode(texts) == [e.ids for e in coder.full.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_no_tokens_at_all(spark, docs):
    assert A.align(docs([]), BYTE_LEVEL, PIECES).collect() == []
    assert [tuple(r) for r in A.align(docs([(1, None), (2, "▁")]).coalesce(1), BYTE_LEVEL, PIECES).collect()] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
