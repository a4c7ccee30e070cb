"""Benchmark decontamination: windows of test words found in training documents, by DataFrame functions only.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. A window is ``size``
consecutive words of an item; an item of fewer words, but at least one, is one window. Windows become a hash set
keyed by a 64-bit hash of their words; every document window is probed, and a hash hit counts only if the words
themselves are equal.

Defined cases: a null or word-free text has no words and no hits; a null item text has no window; items that
repeat an id are one item; rows of documents that repeat both doc_id and text are judged once; a null doc_id is
a value like any other; an empty benchmark leaves every document clean; further columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import UPPER, ascii_lower, query, spare, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
# The same words in a text whose A-Z are not lower-cased yet.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
CASED_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SIZE = 10
# A window row takes about 300 bytes; up to this many are broadcast, more are joined by shuffling.
BROADCAST_WINDOWS = 200_000
# Marks the one extra row that every document sends through the join, so that clean documents come out too.
MARK = 0x6D61726B


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP + "+"), "")


def _grams(w: Column, size: int) -> Column:
    """The hash of every run of ``size`` words."""
    at = F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(w, i, size)))


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Distinct windows as (gram, m, window, items): their hash, length, words, and the ids of the items that hold them."""
    item = benchmark.select(F.col("item_id").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    m = F.least(F.size("w"), F.lit(size))
    cut = item.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.slice("w", i, m))).alias("window"))
    one = cut.groupBy("window").agg(F.collect_set("item").alias("items"))
    return one.select(F.xxhash64("window").alias("gram"), F.size("window").alias("m"), "window", "items")


def verdicts(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per distinct (doc_id, text): doc_id, text_hash, n_words, spans (merged [from, to) word ranges), items.

    The set is broadcast while it has at most ``broadcast_windows`` windows. Beyond that, document windows are
    shuffled to it by hash, and hits are verified against the document's words afterwards.
    """
    known = windows(benchmark, size)
    lengths = {r["m"]: r["n"] for r in known.groupBy("m").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    sizes = sorted(lengths)
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), words(F.col("text")).alias("w"))
    mark = F.array(F.lit(MARK).cast("long"))
    probe = doc.select("doc_id", "text_hash", "w", F.size("w").alias("n_words"), F.concat(*[_grams(F.col("w"), s) for s in sizes], mark).alias("grams"))
    # Positions run through the lengths in order; `before` is where those of a window's length begin.
    before, seen = F.lit(0), F.lit(0)
    for s in sizes:
        before = F.when(F.col("m") == s, seen).otherwise(before)
        seen = seen + F.greatest(F.col("n_words") - (s - 1), F.lit(0))
    marked = known.sparkSession.range(1).select(
        F.lit(MARK).cast("long").alias("gram"), F.lit(0).alias("m"), F.array().cast("array<string>").alias("window"), F.array().cast(known.schema["items"].dataType).alias("items")
    )
    known = known.unionByName(marked)
    at = (F.col("k") - before).alias("at")
    # The outer form: a plain posexplode infers a filter on the array's size, which would cut the words once per window.
    if sum(lengths.values()) <= broadcast_windows:
        row = probe.select("doc_id", "text_hash", "n_words", "w", F.posexplode_outer("grams").alias("k", "gram"))
        same = (F.col("m") == 0) | (F.slice("w", F.col("k") - before + 1, F.col("m")) == F.col("window"))
        hit = row.join(F.broadcast(known), "gram").where(same).select("doc_id", "text_hash", "n_words", at, "m", "items")
    else:
        row = probe.select("doc_id", "text_hash", "n_words", F.posexplode_outer("grams").alias("k", "gram"))
        found = row.where(F.col("gram") != MARK).join(known, "gram").select("doc_id", "text_hash", "n_words", at, "m", "window", "items")
        both = found["doc_id"].eqNullSafe(doc["doc_id"]) & (found["text_hash"] == doc["text_hash"])
        same = F.slice("w", F.col("at") + 1, F.col("m")) == F.col("window")
        real = found.join(doc, both).where(same).select(found["doc_id"], found["text_hash"], "n_words", "at", "m", "items")
        none = F.array().cast(known.schema["items"].dataType).alias("items")
        hit = real.unionByName(doc.select("doc_id", "text_hash", F.size("w").alias("n_words"), F.lit(0).alias("at"), F.lit(0).alias("m"), none))
    real = F.col("m") > 0
    per_doc = hit.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(real, F.struct(F.col("at").alias("a"), (F.col("at") + F.col("m")).alias("b"))))).alias("runs"),
        F.collect_set(F.when(real, F.col("items"))).alias("items"),
    )
    return per_doc.select("doc_id", "text_hash", "n_words", _merged(F.col("runs")).alias("spans"), F.array_distinct(F.flatten("items")).alias("items"))


def _merged(runs: Column) -> Column:
    """Sorted word ranges, those that meet or overlap joined."""

    def add(done, r):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["b"] >= r["a"]), longer).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(runs, F.array().cast("array<struct<a:int,b:int>>"), add)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0), lambda n, s: n + s["b"] - s["a"])


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words in ``spans``, each with the gap after it."""
    lead = F.regexp_extract(text, f"^{CASED_GAP}*", 0)
    word = F.regexp_extract_all(text, F.lit(f"{CASED_WORD}+{CASED_GAP}*"), F.lit(0))
    kept = F.filter(word, lambda w, i: ~F.exists(spans, lambda s: (i >= s["a"]) & (i < s["b"])))
    return F.concat(lead, F.array_join(kept, ""))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, max_share: float = 0.5, length: str | None = None) -> DataFrame:
    """``docs`` without their hit words; a document goes if more than ``max_share`` of its words are hit.

    Clean rows come back as they were, repeated ones included. A changed text's length goes into the column
    ``length``, if one is named.
    """
    spans, n, key = spare(docs, "dc_spans", "dc_n", "dc_hash")
    found = verdicts(docs, benchmark, size).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("dc_id"), F.col("text_hash").alias(key), F.col("spans").alias(spans), F.col("n_words").alias(n))
    keyed = docs.withColumn(key + "_own", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    on = keyed["doc_id"].eqNullSafe(found["dc_id"]) & (keyed[key + "_own"] == found[key])
    met = keyed.join(found, on, "left").where(F.col(spans).isNull() | (n_hit(F.col(spans)) <= F.col(n) * max_share))
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(without_spans(F.col("text"), F.col(spans)))
    met = met.withColumn("text", clean)
    if length:
        met = met.withColumn(length, F.when(F.col(spans).isNull(), F.col(length)).otherwise(F.length("text").cast(docs.schema[length].dataType)))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns])


# The same statement in SQL: windows as text, found by equality at every word position.
SQL = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}+') as w from benchmark),
bw as (select distinct item_id, least(len(w), {SIZE}) as m, array_to_string(w[i:i + least(len(w), {SIZE}) - 1], ' ') as g
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), {SIZE}) + 2)) as i from b where len(w) > 0)),
lens as (select distinct m from bw),
dw as (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as g
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, lens where len(w) >= m)),
hit as (select doc_id, i, dw.m, item_id from dw join bw on dw.g = bw.g and dw.m = bw.m),
pos as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + m)) as p from hit) group by all),
items as (select doc_id, count(*) as n, string_agg(s, ',' order by s) as s from (select distinct doc_id, item_id::varchar as s from hit) group by all)
select doc_id, len(w)::bigint as n_words, coalesce(pos.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
  sha256(coalesce(items.s, '')) as items_sha256, coalesce(pos.n, 0) > 0 as contaminated
from d left join pos using (doc_id) left join items using (doc_id)
"""


@query("op3_decontamination", SQL)
def op3(spark, folder):
    v = verdicts(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return v.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit(F.col("spans")).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
