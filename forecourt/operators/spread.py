"""Joins, group statistics and ranks that stay spread out when one key is hot.

A window over a group puts the whole group into one task, so per-group values
are computed as partial aggregates and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Join partitions a heavy key is spread over: a caller's parameter. More of them
# spread a key further and repeat its row of the small side as often.
SALTS = 16
# A key is heavy if it holds over this share of the rows; there are at most as
# many as its inverse.
HEAVY = 0.02


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY) -> list[int]:
    """Hashes of the keys that hold over ``share`` of the rows, NULL keys included. Runs a job.

    A frequent-items sketch counts them in one pass over the key columns, merged
    from partial ones; it never misses such a key.
    """
    hashed = F.xxhash64(*keys).alias("h")
    most = int(2 / share)
    sketch = F.call_function("approx_top_k", F.col("h"), F.lit(most), F.lit(max(1024, 8 * most)))
    row = df.select(hashed).agg(sketch.alias("top"), F.count("*").alias("n")).first()
    return sorted(item["item"] for item in row["top"] or () if item["count"] > row["n"] * share)


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by its own estimate and threshold."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) if text != "-1" else -1
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def spread_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 1, null_safe: bool = True
) -> DataFrame:
    """Equi join on same-named ``keys``, keeping the key columns of ``big``.

    NULL keys match each other, as in a window partition; ``null_safe=False``
    lets a NULL key match nothing. The comparison of NULL-safe keys also makes
    Spark shuffle an aggregated ``small`` anew, so that adaptive execution can
    split a hot key of ``big``; a plain one needs salts for that. With ``salts``
    > 1, and a ``small`` that Spark would not broadcast, a job looks for heavy
    keys of ``big`` first: their rows are spread over that many join partitions
    and their rows of ``small`` repeated as often, and all others join plainly.
    The salt is the input partition number, so a re-run task gives the same salt
    to the same row, and copies of one row still spread.
    """
    left = big
    right = small.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    pairs = [(F.col(k), F.col(f"_k_{k}")) for k in keys]
    on = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    extra = [f"_k_{k}" for k in keys]
    heavy = heavy_keys(big, keys) if salts > 1 and not broadcastable(right) else []
    if heavy:
        is_heavy = lambda *cols: F.xxhash64(*cols).isin(heavy)
        left = big.withColumn("_salt", F.when(is_heavy(*keys), F.spark_partition_id() % salts).otherwise(0))
        copies = F.when(is_heavy(*extra), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn("_salt_r", F.explode(copies))
        on.append(F.col("_salt") == F.col("_salt_r"))
        extra += ["_salt", "_salt_r"]
    return left.join(right, on, how).drop(*extra)


def with_group_stats(df: DataFrame, keys: Sequence[str], *aggs: Column, salts: int = 1) -> DataFrame:
    """Add per-group aggregates to every row of the group. ``df`` is read twice."""
    return spread_join(df, df.groupBy(*keys).agg(*aggs), keys, salts=salts)


def recency_ranks(df: DataFrame, keys: Sequence[str], ts: str, rank: str = "rank", size: str | None = None) -> DataFrame:
    """One row per (group, ts): rank by ``ts`` descending, ties equal, NULL ts first; optionally the group size.

    Rows are counted per (group, ts) and minute; the counts are summed over the
    minutes of a group and the instants of a minute. No window sees the rows
    themselves, whatever the size of a group, nor all instants of one.
    """
    before = lambda *by: Window.partitionBy(*keys, *by).rowsBetween(Window.unboundedPreceding, -1)
    newer = lambda n, at, *by: F.coalesce(F.sum(n).over(before(*by).orderBy(F.col(at).desc_nulls_first())), F.lit(0))
    instants = df.groupBy(*keys, ts).agg(F.count("*").alias("_n")).withColumn("_minute", F.date_trunc("minute", ts))
    minutes = instants.groupBy(*keys, "_minute").agg(F.sum("_n").alias("_n"))
    sizes = [F.sum("_n").over(Window.partitionBy(*keys)).alias(size)] if size else []
    minutes = minutes.select(*keys, "_minute", newer("_n", "_minute").alias("_minutes"), *sizes)
    kept = [size] if size else []
    ranked = spread_join(instants, minutes, [*keys, "_minute"])
    place = F.col("_minutes") + newer("_n", ts, "_minute") + 1
    return ranked.select(*keys, ts, place.cast("int").alias(rank), *kept)


def top_recency_ranks(df: DataFrame, keys: Sequence[str], ts: str, top: int, rank: str = "rank", size: str | None = None) -> DataFrame:
    """As `recency_ranks`, for ranks up to ``top``.

    A row among the newest ``top`` has one of the ``top`` newest instants of its
    group. So a group is a state of that many instants with their counts, which
    merges: tasks cut their parts to it before the shuffle (Spark's window group
    limit), and what is left of a group is as small for any size of it.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_first())
    instants = df.groupBy(*keys, ts).agg(F.count("*").alias("_n"))
    state = instants.withColumn("_i", F.row_number().over(newest)).where(F.col("_i") <= top)
    newer = F.coalesce(F.sum("_n").over(newest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = state.withColumn(rank, (newer + 1).cast("int")).where(F.col(rank) <= top).select(*keys, ts, rank)
    return with_sizes(ranks, instants, keys, size) if size else ranks


def with_sizes(ranks: DataFrame, instants: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    return spread_join(ranks, instants.groupBy(*keys).agg(F.sum("_n").alias(size)), keys)


def with_recency_rank(df: DataFrame, keys: Sequence[str], ts: str, rank: str = "rank", size: str | None = None, top: int | None = None) -> DataFrame:
    """Add rank() by recency (and the group size); ``top`` keeps ranks up to it, ties included.

    ``df`` is read twice, for the counts and for the rows.
    """
    ranks = recency_ranks(df, keys, ts, rank, size) if top is None else top_recency_ranks(df, keys, ts, top, rank, size)
    return spread_join(df, ranks, [*keys, ts])


def sent_once_by_recency(
    df: DataFrame, keys: Sequence[str], ts: str, rank: str, size: str, top: int | None = None, heavy: Sequence[int] = ()
) -> tuple[DataFrame, DataFrame | None]:
    """As `with_recency_rank`, with rows sent once: (rows of other groups, those of the groups in ``heavy``, if any).

    Other groups hold a small share of the rows, so a window ranks and counts
    the rows themselves; the result is partitioned by ``keys``. ``heavy`` is what
    `heavy_keys` finds: those groups are ranked by counts.
    """
    group = Window.partitionBy(*keys)
    is_heavy = F.xxhash64(*keys).isin(list(heavy))
    plain = df.where(~is_heavy) if heavy else df
    ranked = plain.withColumn(rank, F.rank().over(group.orderBy(F.col(ts).desc_nulls_first()))).withColumn(size, F.count("*").over(group))
    ranked = ranked if top is None else ranked.where(F.col(rank) <= top)
    return ranked, with_recency_rank(df.where(is_heavy), keys, ts, rank, size, top) if heavy else None
