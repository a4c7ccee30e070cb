"""Audit of how sources diverge from each other and from their language, over minimal acyclic transducers.

Terms are the matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A language keeps the V terms that
at least ``least`` of its documents (rows) hold.

1. Tasks count in how many documents a term stands; Spark sums the counts and sorts the kept terms by their bytes.
2. `Transducer.build` takes a sorted run of a language's terms and shares equal ends as it goes, so what comes out is
   the minimal acyclic automaton. An arc carries the number of terms that its state passes over by taking it; summed
   along a path that is the term's place among the run's, and with the number of terms before the run its
   lexicographic ordinal. A language of many terms has several runs (`pieces`), written to the shared folder.
3. `recount` streams every text through the transducers and counts ordinals per (lang, source); terms that no path
   accepts are not kept ones. Tasks hold at most ``ROUND_BYTES`` of transducers; if there are more, the texts of
   those languages are streamed again for the next ones.
4. With N the sum of a group's counts, p = 1 + floor(1000000000 * (count + 2) / (N + 2 V)), by long division in
   64-bit numbers, and f = floor((p - q)**2 / (p + q)).
   Part ``pair``: against every other source of the language the sum of f over all kept terms, in runs of ordinals that
   hold about a million numbers however many sources there are.
   Part ``term``: the ``top`` terms with a count and p over the language's q; equal values go by ordinal, and the
   transducers spell the ordinals of what is left.

Defined cases: null text, lang and source are empty strings; a group without kept terms has only its pairs, of value 0
if V is 0; a source that is alone in its language has no pair; repeated rows count again; an empty table gives no
rows; further columns are left alone. Counts below 9 * 10**15 are exact. A text is read whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import UPPER, query, table
from forecourt.session import materialize

LEAST = 10
TOP = 10
SCALE = 1_000_000_000
#: Terms in one transducer, or a 4096th of all if that is more.
PIECE = 1 << 17
#: Bytes of transducers that tasks hold while they stream texts.
ROUND_BYTES = 64 << 20
#: Bytes of text that a task counts at a time, and distinct terms that it holds while it looks for the vocabulary.
BLOCK_BYTES = 32 << 20
HELD = 400_000
#: Numbers that one part of the pair sums holds, and rows that it makes.
CELLS = 1 << 20
WIDEST = 4096

# A term in lower-cased UTF-8: A-Z, a-z and every byte of characters from U+0080 on.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


class Transducer:
    """A minimal acyclic automaton that maps each of a sorted run of terms to its place, and back."""

    def __init__(self, first: np.ndarray, final: np.ndarray, label: np.ndarray, target: np.ndarray, skip: np.ndarray):
        self.first, self.final, self.label, self.target, self.skip = first, final, label, target, skip
        state = np.repeat(np.arange(len(final)), np.diff(first))
        self.key = state << 8 | label  # arcs lie in order of state and label

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        known: dict[tuple, int] = {}
        states: list[tuple] = []
        below: list[int] = []  # the number of terms that end at a state or after it
        path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
        last = None

        def settled(node) -> int:
            state = (node[0][0], tuple(node[1]))
            if state not in known:
                known[state] = len(states)
                states.append(state)
                below.append(state[0] + sum(below[t] for _, t in state[1]))
            return known[state]

        def back_to(depth: int) -> None:
            while len(path) - 1 > depth:
                child = settled(path.pop())
                path[-1][1].append((last[len(path) - 1], child))

        for term in terms:
            if last is not None:
                if term <= last:
                    raise ValueError("terms must be distinct and sorted by their bytes")
                common = 0
                for x, y in zip(term, last):
                    if x != y:
                        break
                    common += 1
                back_to(common)
            path.extend(([False], []) for _ in range(len(term) - len(path) + 1))
            path[-1][0][0] = True
            last = term
        back_to(0)
        settled(path[0])  # the root is the last state
        arcs = [(label, target) for _, out in states for label, target in out]
        skip, at = np.zeros(len(arcs), np.int64), 0
        for final, out in states:
            passed = int(final)
            for _, target in out:
                skip[at] = passed
                passed += below[target]
                at += 1
        first = np.cumsum([0] + [len(out) for _, out in states])
        final = np.array([f for f, _ in states], bool)
        return cls(first, final, np.array([a[0] for a in arcs], np.int64), np.array([a[1] for a in arcs], np.int64), skip)

    def places(self, terms: list[bytes]) -> np.ndarray:
        """The place of each term, -1 where it is not accepted; all terms take their n-th byte at once."""
        size = np.array([len(t) for t in terms], np.int64)
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(terms), np.uint8)
        out = np.full(len(terms), -1)
        lane = np.arange(len(terms))
        state = np.full(len(terms), len(self.final) - 1)
        place = np.zeros(len(terms), np.int64)
        step = 0
        while len(lane):
            done = size[lane] == step
            ends = lane[done & self.final[state]]
            out[ends] = place[ends]
            lane, state = lane[~done], state[~done]
            if not len(lane) or not len(self.key):
                break
            want = state << 8 | data[start[lane] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            goes = self.key[arc] == want
            lane, arc = lane[goes], arc[goes]
            place[lane] += self.skip[arc]
            state = self.target[arc]
            step += 1
        return out

    def term(self, place: int) -> bytes:
        state, out = len(self.final) - 1, bytearray()
        while not (place == 0 and self.final[state]):
            low, high = self.first[state], self.first[state + 1]
            arc = low + int(np.searchsorted(self.skip[low:high], place, "right")) - 1
            place -= int(self.skip[arc])
            out.append(self.label[arc])
            state = self.target[arc]
        return bytes(out)

    def pack(self) -> bytes:
        parts = [self.first.astype("<i4"), self.final.astype("u1"), self.label.astype("u1"), self.target.astype("<i4"), self.skip.astype("<i4")]
        return np.array([len(self.final), len(self.label)], "<i8").tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def unpack(cls, blob: bytes) -> Transducer:
        states, arcs = np.frombuffer(blob, "<i8", 2).tolist()
        at, out = 16, []
        for kind, n in (("<i4", states + 1), ("u1", states), ("u1", arcs), ("<i4", arcs), ("<i4", arcs)):
            out.append(np.frombuffer(blob, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        out[1] = out[1].astype(bool)
        return cls(*out)


# --- vocabulary -----------------------------------------------------------


def clean(docs: DataFrame) -> DataFrame:
    """(lang, source, text): null as empty, the text as bytes."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*text).withColumn("text", F.col("text").cast("binary"))


def kept_terms(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term): the terms that at least ``least`` documents of the language hold, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, count in held.items():
                for batch in pa.table({"lang": pa.nulls(len(count), pa.string()).fill_null(lang), "term": pa.array(list(count), pa.binary()), "n": list(count.values())}).to_batches(max_chunksize=10_000):
                    yield batch
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[lang].update(set(TERM.findall(text.as_py().lower())))
                if sum(map(len, held.values())) >= HELD:
                    yield from rows()
        yield from rows()

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return materialize(counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).drop("n"), "divergence-terms")


def pieces(kept: DataFrame, piece: int = PIECE) -> DataFrame:
    """(lang, piece, first, n, before, body): the transducers of sorted runs of ``kept``, written once.

    ``first`` is the run's first term, ``before`` the number of the language's terms before it.
    """
    total = kept.count()
    piece = max(piece, total >> 12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, terms = None, []

        def built() -> pa.RecordBatch:
            body = Transducer.build(terms).pack()
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([terms[0]], pa.binary()), pa.array([len(terms)]), pa.array([body], pa.binary())], names=["lang", "first", "n", "body"])

        for batch in batches:
            for lang, term in zip(*(c.to_pylist() for c in batch.columns)):
                if terms and (lang != at or len(terms) >= piece):
                    yield built()
                    terms = []
                at = lang
                terms.append(term)
        if terms:
            yield built()

    ranged = kept.select("lang", "term").repartitionByRange(max(1, total // piece), "lang", "term").sortWithinPartitions("lang", "term")
    made = materialize(ranged.mapInArrow(run, "lang string, first binary, n long, body binary"), "divergence-runs")
    order = Window.partitionBy("lang").orderBy("first")  # at most some 4096 rows of all languages, but for one a language and range
    placed = made.select("lang", "first", "n").withColumn("before", F.sum("n").over(order) - F.col("n")).withColumn("piece", F.row_number().over(order))
    return materialize(made.join(placed.drop("n"), ["lang", "first"]), "divergence-pieces")


# --- recounting -----------------------------------------------------------


def recount(texts: DataFrame, made: DataFrame, round_bytes: int = ROUND_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, ordinal, n): how often a group's texts hold each kept term, where they do; written once."""
    spark = texts.sparkSession
    sizes = made.select("lang", "piece", F.octet_length("body").alias("size")).orderBy("lang", "piece").collect()  # a row per transducer
    rounds: list[list] = []
    room = 0
    for row in sizes:
        if row["size"] > room or not rounds:
            rounds.append([])
            room = round_bytes
        rounds[-1].append(row)
        room -= row["size"]
    parts = [_counted(texts, made, held, block_bytes) for held in rounds]
    if not parts:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return materialize(whole.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "divergence-counts")


def _counted(texts: DataFrame, made: DataFrame, held: list, block_bytes: int) -> DataFrame:
    low, high = held[0], held[-1]
    at = F.struct("lang", "piece")
    mine = made.where(at.between(F.struct(F.lit(low["lang"]).alias("lang"), F.lit(low["piece"]).alias("piece")), F.struct(F.lit(high["lang"]).alias("lang"), F.lit(high["piece"]).alias("piece"))))
    by_lang: dict[str, list[tuple[bytes, int, bytes]]] = defaultdict(list)
    for row in mine.orderBy("lang", "piece").toLocalIterator():
        by_lang[row["lang"]].append((bytes(row["first"]), row["before"], bytes(row["body"])))
    shared = texts.sparkSession.sparkContext.broadcast(dict(by_lang))  # at most round_bytes, or one transducer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: [(first, before, Transducer.unpack(body)) for first, before, body in runs] for lang, runs in shared.value.items()}
        block: dict[tuple[str, str], list[bytes]] = defaultdict(list)
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                block[lang, source].append(text)
                size += len(text)
                if size >= block_bytes:
                    yield from _ordinals(block, known)
                    size = 0
        yield from _ordinals(block, known)

    few = texts.where(F.col("lang").isin(list(by_lang)))
    streamed = few.mapInArrow(run, "lang string, source string, ordinals array<long>, ns array<long>")
    one = streamed.select("lang", "source", F.explode(F.arrays_zip("ordinals", "ns")).alias("x"))
    return one.select("lang", "source", F.col("x.ordinals").alias("ordinal"), F.col("x.ns").alias("n"))


def _ordinals(block: dict[tuple[str, str], list[bytes]], known: dict[str, list]) -> Iterator[pa.RecordBatch]:
    for (lang, source), texts in block.items():
        count = Counter(TERM.findall(b" ".join(texts).lower()))
        terms = sorted(count)
        runs = known[lang]
        cuts = [bisect_left(terms, first) for first, _, _ in runs] + [len(terms)]
        for (_, before, transducer), a, b in zip(runs, cuts, cuts[1:]):
            place = transducer.places(terms[a:b])
            hit = np.flatnonzero(place >= 0)
            ns = [count[terms[a + k]] for k in hit.tolist()]
            for at in range(0, len(hit), 10_000):
                part = slice(at, at + 10_000)
                lists = [pa.array([x], pa.list_(pa.int64())) for x in (place[hit[part]] + before, ns[part])]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([source]), *lists], names=["lang", "source", "ordinals", "ns"])
    block.clear()


# --- divergence -----------------------------------------------------------


def share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / whole) by long division, a thousandfold a step."""
    out, rest = F.lit(1).cast("long"), count + 2
    for power in (SCALE // 1000, SCALE // 1_000_000, 1):
        rest = rest * 1000
        out = out + F.call_function("div", rest, whole) * power
        rest = rest % whole
    return out


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(counts: DataFrame, groups: DataFrame, cells: int = CELLS, widest: int = WIDEST) -> DataFrame:
    """(lang, a, b, value), a < b numbers of sources: the sum of f over all kept terms of the language."""
    each = F.least(F.lit(widest), F.greatest(F.lit(1), F.call_function("div", F.lit(cells).cast("long"), F.col("sources")))).cast("long")
    parts = F.ceil(F.col("sources") * F.col("sources") / F.lit(2.0 * cells)).cast("long")
    groups = groups.withColumns({"width": each, "parts": parts})
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    runs = F.greatest(F.lit(1), F.ceil(F.col("v") / F.col("width"))).cast("long")
    right = groups.select("lang", "number", share(F.lit(0).cast("long"), F.col("whole")).alias("none"), "v", "width", "parts", F.explode(F.sequence(F.lit(0).cast("long"), runs - 1)).alias("run"))
    right = right.select("lang", "number", "none", "v", "width", "parts", "run", part)
    left = counts.join(groups.select("lang", "source", "number", "whole", "width", "parts"), ["lang", "source"])
    left = left.select("lang", "number", (F.col("ordinal") % F.col("width")).alias("at"), share(F.col("n"), F.col("whole")).alias("p"), F.call_function("div", F.col("ordinal"), F.col("width")).alias("run"), part)

    def summed(found: pa.Table, sources: pa.Table) -> pa.Table:
        first = sources.slice(0, 1).to_pylist()[0]
        number = np.sort(sources["of_number"].to_numpy())
        wide = max(0, min(first["of_width"], first["of_v"] - first["of_run"] * first["of_width"]))
        p = np.empty((len(number), wide), np.int64)
        p[np.searchsorted(number, sources["of_number"].to_numpy())] = sources["of_none"].to_numpy()[:, None]
        p[np.searchsorted(number, found["number"].to_numpy()), found["at"].to_numpy()] = found["p"].to_numpy()
        a, b, value = [], [], []
        for k in range(first["of_part"], len(number) - 1, first["of_parts"]):
            gap = p[k + 1 :] - p[k]
            value.append((gap * gap // (p[k + 1 :] + p[k])).sum(axis=1))
            a.append(np.full(len(number) - k - 1, number[k]))
            b.append(number[k + 1 :])
        a, b, value = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b, value))
        return pa.table({"lang": pa.nulls(len(a), pa.string()).fill_null(first["of"]), "a": a, "b": b, "value": value})

    # New names for all columns: both sides come from the same groups, and Spark must tell them apart.
    right = right.select(F.col("lang").alias("of"), F.col("run").alias("of_run"), F.col("part").alias("of_part"), *(F.col(c).alias(f"of_{c}") for c in ("number", "none", "v", "width", "parts")))
    both = left.groupBy("lang", "run", "part").cogroup(right.groupBy("of", "of_run", "of_part"))
    return both.applyInArrow(summed, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, piece: int = PIECE, round_bytes: int = ROUND_BYTES, block_bytes: int = BLOCK_BYTES, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts."""
    texts = clean(docs)
    kept = kept_terms(texts, least)
    made = pieces(kept, piece)
    counts = recount(texts, made, round_bytes, block_bytes)
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = texts.select("lang", "source").distinct().join(total, ["lang", "source"], "left").join(v, "lang", "left").fillna(0, ["total", "v"])
    of_lang = Window.partitionBy("lang")
    groups = named.withColumns(
        {
            "number": F.row_number().over(of_lang.orderBy("source")).cast("long"),
            "sources": F.count("*").over(of_lang),
            "whole": F.greatest(F.lit(1).cast("long"), F.col("total") + 2 * F.col("v")),
            "lang_whole": F.sum("total").over(of_lang) + 2 * F.col("v"),
        }
    )
    groups = materialize(groups, "divergence-groups")

    sums = pair_sums(counts, groups, cells)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    own = groups.select("lang", F.col("number").alias("a"), "source")
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    pairs = both.join(own, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    p, q = share(F.col("n"), F.col("whole")), share(F.col("lang_n"), F.col("lang_whole"))
    over = counts.join(groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"]).join(whole, ["lang", "ordinal"])
    over = over.select("lang", "source", "ordinal", p.alias("p"), q.alias("q")).where("p > q").select("lang", "source", "ordinal", _f(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    best = over.withColumn("rank", rank).where(F.col("rank") <= top)
    terms = spelled(best, made).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def spelled(best: DataFrame, made: DataFrame) -> DataFrame:
    """``best`` (lang, source, ordinal, value, rank) with each ordinal's term as ``item``."""
    where = made.select(F.col("lang").alias("of"), "piece", "before", "n")
    inside = (F.col("lang") == F.col("of")) & (F.col("ordinal") >= F.col("before")) & (F.col("ordinal") < F.col("before") + F.col("n"))
    placed = best.join(where, inside).select("lang", "piece", "source", (F.col("ordinal") - F.col("before")).alias("place"), "value", "rank")

    def run(rows: pa.Table, bodies: pa.Table) -> pa.Table:
        out = rows.drop_columns(["place", "piece"])
        if not len(rows):
            return out.append_column("item", pa.array([], pa.string()))
        transducer = Transducer.unpack(bodies["body"][0].as_py())
        return out.append_column("item", pa.array([transducer.term(k).decode() for k in rows["place"].to_pylist()], pa.string()))

    bodies = made.select(F.col("lang").alias("of"), F.col("piece").alias("of_piece"), "body")
    both = placed.groupBy("lang", "piece").cogroup(bodies.groupBy("of", "of_piece"))
    return both.applyInArrow(run, "lang string, source string, value long, rank int, item string")


SQL = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
kept as (select lang, t from (select distinct r, lang, unnest(w) as t from d) group by all having count(*) >= {LEAST}),
g as (select distinct lang, source from d),
c as (select lang, source, t, count(*) as n from (select lang, source, unnest(w) as t from d) semi join kept using (lang, t) group by all),
v as (select lang, count(*) as v from kept group by lang),
s as (select lang, source, sum(n) as n from c group by all),
p as (select g.lang, g.source, t, coalesce(c.n, 0) as n, 1 + (({SCALE}::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v))::bigint as p
  from g join kept using (lang) join v using (lang) left join s using (lang, source) left join c using (lang, source, t)),
q as (select lang, t, 1 + (({SCALE}::hugeint * (sum(n) + 2)) // (sum(sum(n)) over (partition by lang) + 2 * v))::bigint as q from p join v using (lang) group by lang, t, v),
pair as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source),
terms as (select lang, source, 'term' as part, t as item, ((p - q) * (p - q) // (p + q))::bigint as value from p join q using (lang, t) where n > 0 and p > q)
select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (select * from pairs union all select * from terms)
qualify part = 'pair' or rank <= {TOP}
"""


@query("op11_source_divergence", SQL)
def op11(spark, folder):
    return audit(table(spark, folder, "documents"))
