"""Joins beyond the plain equi join: tags, substrings, ranges, nearest match."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.spread import SALTS, spread_join
from forecourt.session import materialize


def left_lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, salts: int = SALTS) -> DataFrame:
    """Left join of ``df.key`` to ``table.table_key``, dropping the latter.

    A hot key, NULL included, may hold much of ``df``: its rows spread over the
    salts. Spark broadcasts ``table`` while that is under the broadcast threshold.
    """
    named = table.withColumnRenamed(table_key, key)
    return spread_join(df, named, [key], "left", salts=salts, null_safe=False)


def join_unique_names(left: DataFrame, right: DataFrame, on: Column, how: str, drop: Sequence[str] = ()) -> DataFrame:
    """Join two tables into one wide row; a column name that both have is an error."""
    clash = sorted(set(left.columns) & set(right.columns))
    if clash:
        raise ValueError(f"duplicate column names: {clash}")
    return left.join(right, on, how).drop(*drop)


def tagged_self_join(items: DataFrame, base: Column, id_: str, applied_to: str, tag: str, value: str, tags: Mapping[str, str]) -> DataFrame:
    """Left-join, per tag, the items applied to a base item; several of one tag multiply rows.

    ``tags`` maps output column -> tag value.
    """
    out = items.where(base)
    for name, wanted in tags.items():
        side = items.where((F.col(tag) == wanted) & F.col(applied_to).isNotNull())
        side = side.select(F.col(applied_to).alias("_to"), F.col(value).alias(name))
        out = out.join(side, F.col(id_) == F.col("_to"), "left").drop("_to")
    return out


def tagged_totals(items: DataFrame, applied_to: str, tag: str, value: str, tags: Mapping[str, str]) -> DataFrame:
    """One row per item applied to: per tag its sum ``name`` and its row count ``name_n``."""
    wanted = items.where(F.col(tag).isin(*tags.values()) & F.col(applied_to).isNotNull())
    aggs = []
    for name, t in tags.items():
        aggs.append(F.sum(F.when(F.col(tag) == t, F.col(value))).alias(name))
        aggs.append(F.count_if(F.col(tag) == t).alias(f"{name}_n"))
    return wanted.groupBy(F.col(applied_to).alias("_to")).agg(*aggs)


# Characters of the gram by which a needle is looked for; a shorter needle is its own gram.
GRAM = 8
# Characters that a task looks at together.
PIECE = 1 << 20
# Slots of the filter of wanted grams.
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS


def rarest_grams(needles: DataFrame, needle: str, gram: int = GRAM) -> DataFrame:
    """(gram, entries): each distinct, non-empty needle under the gram of it that the fewest needles have.

    Grams are counted first; of equally rare ones the first in the needle is
    taken. An entry is the gram's place in the needle, the needle's length and
    its hash.
    """
    n = needles.select(F.col(needle).alias("needle")).where(F.col(needle) != "").distinct()
    width = F.least(F.length("needle"), F.lit(gram))
    at = F.sequence(F.lit(1), F.length("needle") - width + 1)
    cut = F.transform(at, lambda i: F.struct(i.alias("at"), F.substring(F.col("needle"), i, width).alias("gram")))
    grams = n.select("needle", F.inline(cut))
    counts = grams.groupBy("gram").agg(F.countDistinct("needle").alias("n"))
    first = grams.join(counts, "gram").groupBy("needle").agg(F.min(F.struct("n", "at", "gram")).alias("_g"))
    entry = F.struct((F.col("_g.at") - 1).alias("before"), F.length("needle").alias("len"), F.xxhash64("needle").alias("hash"))
    return first.groupBy(F.col("_g.gram").alias("gram")).agg(F.collect_list(entry).alias("entries"))


def gram_slots(text: str, width: int) -> np.ndarray:
    """The filter slot of every ``width`` characters of ``text``, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    places = max(len(codes) - width + 1, 0)
    hashed = np.zeros(places, np.uint64)
    for j in range(width):
        hashed = hashed * np.uint64(0x100000001B3) + codes[j : j + places]
    return ((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _read(texts: pa.Array) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()]


def gram_filter(grams: DataFrame) -> dict[int, np.ndarray]:
    """By the length of grams, SLOTS booleans that are true where one falls: at most SLOTS numbers a length reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _read(batch.column(0))
            widths = pa.array([len(g) for g in texts], pa.int32())
            slots = pa.array([int(gram_slots(g, len(g))[0]) for g in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([widths, slots], names=["width", "slot"])

    found: dict[int, np.ndarray] = {}
    for row in grams.select("gram").mapInArrow(run, "width int, slot int").distinct().collect():
        found.setdefault(row["width"], np.zeros(SLOTS, bool))[row["slot"]] = True
    return found


def gram_hits(texts: DataFrame, text: str, grams: DataFrame, gram: int = GRAM) -> DataFrame:
    """(_id, _pos, gram): where ``texts`` (with _id) may hold one of the grams.

    A task hashes the places of many texts at once and filters them, so a row
    is made only of a hit (or of a gram that shares its slot with a wanted one).
    """
    wanted = gram_filter(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column(0).to_numpy(zero_copy_only=False), _read(batch.column(1))
            first = 0
            while first < len(held):
                last, size = first, 0
                while last < len(held) and (last == first or size + len(held[last]) <= PIECE):
                    size += len(held[last])
                    last += 1
                yield from found(ids[first:last], held[first:last])
                first = last

    def found(ids: np.ndarray, held: list[str]) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum([len(t) for t in held])
        for piece in range(0, int(ends[-1]), PIECE):
            # A text longer than a piece is alone, and its pieces overlap by a gram.
            part = held[0][piece : piece + PIECE + gram - 1] if len(held) == 1 else "".join(held)
            for width, slots in wanted.items():
                at = np.flatnonzero(slots[gram_slots(part, width)])
                at = at[at < PIECE]
                of = np.searchsorted(ends, at + piece, "right")
                inside = at + piece + width <= ends[of]
                at, of = at[inside], of[inside]
                start = np.concatenate(([0], ends))[of]
                cut = [part[i : i + width] for i in at.tolist()]
                columns = [pa.array(ids[of], pa.int64()), pa.array(at + piece - start + 1, pa.int32()), pa.array(cut, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "_pos", "gram"])

    return texts.where(F.length(text) > 0).select("_id", text).mapInArrow(run, "_id long, _pos int, gram string")


def substring_cuts(texts: DataFrame, text: str, needles: DataFrame, needle: str, gram: int = GRAM, salts: int = SALTS) -> DataFrame:
    """Distinct (text, needle) cuts among which are all needles that occur in the text; '' is cut from every text.

    Every needle is indexed by its rarest gram. Where a text holds that gram,
    the needle's length is cut out around it, and kept if its hash is that of
    the needle. The cuts then meet the needles by plain equality, so no needle
    is tried against all texts. Until a gram is met, a row holds a text's hash,
    a place and the gram; the text joins its hits once, by the hash. Equal
    hashes of two texts only add cuts.
    """
    t = texts.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    index = materialize(rarest_grams(needles, needle, gram), "grams")  # small next to the needles, and read three times
    hashed = t.withColumn("_id", F.xxhash64("text"))
    met = spread_join(gram_hits(hashed, "text", index.select("gram"), gram), index, ["gram"], salts=salts)
    hits = met.groupBy("_id").agg(F.collect_set(F.struct("_pos", "entries")).alias("_hits"))
    each = hashed.join(hits, ["_id"]).select("text", F.inline("_hits")).select("text", "_pos", F.inline("entries"))
    each = each.withColumn("_from", F.col("_pos") - F.col("before"))
    inside = (F.col("_from") >= 1) & (F.col("_from") + F.col("len") - 1 <= F.length("text"))
    cuts = each.where(inside).select("text", "hash", F.substring(F.col("text"), F.col("_from"), F.col("len")).alias("needle"))
    cuts = cuts.where(F.xxhash64("needle") == F.col("hash")).select("text", "needle").distinct()
    return cuts.unionByName(t.select("text", F.lit("").alias("needle")))


def substring_join(left: DataFrame, text: str, right: DataFrame, needle: str, gram: int = GRAM, salts: int = SALTS) -> DataFrame:
    """Inner join where ``left.text`` contains ``right.needle`` (taken literally).

    A text of many rows, and a needle of many texts, spread over the salts.
    """
    cuts = substring_cuts(left, text, right, needle, gram, salts).select(F.col("text").alias("_text"), F.col("needle").alias("_needle"))
    found = spread_join(cuts, right.withColumn("_needle", F.col(needle)), ["_needle"], salts=salts, null_safe=False)
    hits = spread_join(left.withColumn("_text", F.col(text)), found.drop("_needle"), ["_text"], salts=salts, null_safe=False)
    return hits.drop("_text")


def substring_pairs(texts: DataFrame, text: str, needles: DataFrame, needle: str, gram: int = GRAM, salts: int = SALTS) -> DataFrame:
    """Distinct (text, needle) pairs where the needle occurs in the text; '' occurs in every text."""
    cuts = substring_cuts(texts, text, needles, needle, gram, salts)
    known = needles.select(F.col(needle).alias("needle")).distinct()
    return spread_join(cuts, known, ["needle"], "left_semi", salts=salts, null_safe=False)


def not_seen_before(df: DataFrame, history: DataFrame, keys: Sequence[str], ts: str, days: int) -> DataFrame:
    """Rows with no history row of the same keys more than ``days`` before them.

    Such a row exists exactly when the first time of the key is that early, so
    the history shrinks to one row per key before the join.
    """
    first = history.groupBy(*keys).agg(F.min(ts).alias("_first"))
    joined = spread_join(df, first, keys, "left", salts=SALTS, null_safe=False)
    early = F.col("_first") < F.col(ts) - F.make_dt_interval(days=F.lit(days))
    return joined.where(~F.coalesce(early, F.lit(False))).drop("_first")


def drop_ambiguous(df: DataFrame, reference: DataFrame, key: str, value: str) -> DataFrame:
    """``NOT IN`` the keys that have more than one distinct ``value`` in ``reference``."""
    spread = reference.groupBy(key).agg((F.min(value) != F.max(value)).alias("_many"))
    return df.join(spread.where("_many").select(key), [key], "left_anti")


def distinct_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the number of distinct values in the row's group (a correlated count)."""
    counts = df.groupBy(*keys).agg(F.countDistinct(value).alias(out))
    return spread_join(df, counts, keys)


def last_seen_by_label(leads: DataFrame, key: str, labels: str, ts: str, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Latest ``ts`` per key and label set, from one pass over the label arrays."""
    aggs = [
        F.max(F.when(F.arrays_overlap(F.col(labels), F.array(*[F.lit(x) for x in names])), F.col(ts))).alias(out)
        for out, names in wanted.items()
    ]
    return leads.groupBy(key).agg(*aggs)


def at_latest_version(rows: DataFrame, history: DataFrame, version: str, date: str) -> DataFrame:
    """Rows of the version that the history names last; the higher version wins a tie."""
    current = history.agg(F.max_by(version, F.struct(date, version))).scalar()
    return rows.where(F.col(version) == current)


def nearest_match(
    wanted: DataFrame, offers: DataFrame, equal: Sequence[str], measure: str, key: Sequence[str], tolerance: float
) -> DataFrame:
    """Per wanted row, the offer with equal columns and the nearest ``measure`` within ``tolerance``.

    Adds ``match`` (struct of the offer's ``key``) and ``diff``; unmatched rows
    are left out. Of equal distances the least key wins. Both sides are first
    reduced to one row per equal columns and measure. Only those of the same or
    a neighbouring price band meet, and inside a band two sorted passes find the
    next lower and next higher offer, so pairs are never listed, and a pass sees
    the distinct measures of a band, not its rows.
    """
    o = offers.where(F.col(measure) >= 0).groupBy(*equal, F.col(measure).alias("_at")).agg(F.min(F.struct(*key)).alias("_key"))
    o = o.select(*equal, band_of("_at", tolerance).alias("_band"), "_at", F.struct("_at", "_key").alias("_offer"), F.lit(False).alias("_asks"))
    near_bands = F.array(*[band_of("_at", tolerance) + d for d in (-1, 0, 1)])
    w = wanted.where(F.col(measure) >= 0).select(*equal, F.col(measure).alias("_at")).distinct()
    w = w.select(*equal, F.explode(near_bands).alias("_band"), "_at", F.lit(None).cast(o.schema["_offer"].dataType).alias("_offer"), F.lit(True).alias("_asks"))
    both = o.unionByName(w)
    space = Window.partitionBy(*equal, "_band")
    up = space.orderBy(F.col("_at").asc(), F.col("_asks").asc()).rowsBetween(Window.unboundedPreceding, 0)
    down = space.orderBy(F.col("_at").desc(), F.col("_asks").asc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_below", F.last("_offer", True).over(up)).withColumn("_above", F.last("_offer", True).over(down))
    near = seen.where("_asks").select(*equal, "_at", F.explode(F.array("_below", "_above")).alias("_hit"))
    near = near.where(F.col("_hit").isNotNull()).withColumn("_diff", F.abs(F.col("_hit._at") - F.col("_at")))
    span = F.col("_at") * tolerance
    near = near.where(F.col("_hit._at").between(F.col("_at") - span, F.col("_at") + span))
    best = near.groupBy(*equal, F.col("_at").alias(measure)).agg(F.min(F.struct("_diff", "_hit._key")).alias("_best"))
    met = spread_join(wanted, best, [*equal, measure], null_safe=False, salts=SALTS)
    return met.select(*wanted.columns, F.col("_best._key").alias("match"), F.col("_best._diff").alias("diff"))


def band_of(column: str, tolerance: float) -> Column:
    """Logarithmic band, wide enough that ``tolerance`` reaches at most the next band."""
    c = F.col(column)
    width = F.log(F.lit(1 + 1.5 * tolerance))
    return F.when(c > 0, F.floor(F.log(c) / width)).otherwise(F.lit(-1_000_000)).cast("bigint")


def match_tiered(wanted: DataFrame, offers: DataFrame, key: Sequence[str], measure: str = "msrp", body: str = "body_type", tolerance: float = 0.05) -> DataFrame:
    """Lend every wanted group the nearest offered one; lower tiers win.

    Both sides carry ``key`` = (year, make, model, trim, style), ``body`` and
    ``measure``. Tiers with a measure: 1 year, make, model; 2 year, make, body;
    3 previous year, make, model, trim; 5 year, body. Without one: 4 year,
    make, model, trim. Each row is listed once per tier with that tier's equal
    columns, so one nearest match serves all tiers and the least tier is kept,
    which is the same as trying them in turn.
    """
    year, make, model, trim, _ = key
    names = [f"_o_{k}" for k in key]
    lent = [F.col(k).alias(n) for k, n in zip(key, names)]

    def per_tier(df: DataFrame, last_year: Column, *keep: Column) -> DataFrame:
        def row(tier: int, y: Column, *cols: str) -> Column:
            same = [F.col(c) for c in cols] + [F.lit("")] * (3 - len(cols))
            return F.struct(F.lit(tier).alias("tier"), y.alias("_y"), *[c.alias(f"_s{i}") for i, c in enumerate(same)])

        y = F.col(year)
        rows = [row(1, y, make, model), row(2, y, make, body), row(3, last_year, make, model, trim), row(5, y, body)]
        return df.select(*keep, measure, F.explode(F.array(*rows)).alias("_t")).select("*", "_t.*").drop("_t")

    equal = ["tier", "_y", "_s0", "_s1", "_s2"]
    # An offer of the year before meets the wanted year in tier 3.
    sell = per_tier(offers, F.col(year) + 1, *lent)
    buy = per_tier(wanted, F.col(year), *[F.col(k) for k in key])
    near = nearest_match(buy, sell, equal, measure, names, tolerance).select(*key, "tier", "diff", "match")
    plain = [year, make, model, trim]
    first = offers.select(*plain, *lent).groupBy(*plain).agg(F.min(F.struct(*names)).alias("match"))
    bare = wanted.where(F.col(measure).isNull()).select(*key).join(first, plain)
    rows = near.unionByName(bare.select(*key, F.lit(4).alias("tier"), F.lit(0.0).alias("diff"), "match"))
    best = rows.groupBy(*key).agg(F.min(F.struct("tier", "diff", "match")).alias("_b"))
    return best.select(*key, "_b.tier", *[F.col(f"_b.match._o_{k}").alias(f"match_{k}") for k in key])
