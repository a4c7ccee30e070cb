"""One row per key: latest, earliest, longest match, top-n by recency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.spread import spread_join, top_recency_ranks, with_group_stats, with_recency_rank


def _pick(df: DataFrame, keys: Sequence[str], order: Column, newest: bool) -> DataFrame:
    choose = F.max_by if newest else F.min_by
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*keys).agg(choose(row, order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Row with the greatest ``ts`` per key, then the greatest tie columns. Partial aggregation, no window."""
    return _pick(df, keys, F.struct(F.col(ts), *ties), newest=True)


def earliest_per_key(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Row with the least ``ts`` per key, then the least tie columns."""
    return _pick(df, keys, F.struct(F.col(ts), *ties), newest=False)


def latest_first_seen(df: DataFrame, keys: Sequence[str], ts: str, position: str) -> DataFrame:
    """Latest row per key of a batch; of equal ``ts`` the one seen first (least ``position``)."""
    newest = df.groupBy(*keys).agg(F.max(F.struct(F.col(ts), (-F.col(position)).alias("p"))).alias("_top"))
    kept = spread_join(df, newest, keys)
    same = F.col(ts).eqNullSafe(F.col(f"_top.{ts}")) & (F.col(position) == -F.col("_top.p"))
    return kept.where(same).drop("_top")


def rank_longest(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows whose ``text`` is the longest of their key; ties are kept."""
    ranked = with_group_stats(df, [key], F.max(F.length(text)).alias("_longest"))
    return ranked.where(F.length(text) == F.col("_longest")).drop("_longest")


def count_over_group(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return with_group_stats(df, keys, F.count("*").alias(out))


def avg_over_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return with_group_stats(df, keys, F.avg(value).alias(out))


def top_recent(df: DataFrame, keys: Sequence[str], ts: str, n: int, rank: str = "rank") -> DataFrame:
    """Rows whose recency rank within the group is at most ``n`` (ties may exceed n)."""
    return with_recency_rank(df, keys, ts, rank, top=n)


def flag_old(df: DataFrame, keys: Sequence[str], ts: str, n: int, out: str = "is_old") -> DataFrame:
    """Flag rows whose recency rank exceeds ``n``: those at none of the instants of the newest ``n``."""
    ranked = spread_join(df, top_recency_ranks(df, keys, ts, n, "_rank"), [*keys, ts], "left")
    return ranked.withColumn(out, F.when(F.col("_rank").isNull(), 1).otherwise(0)).drop("_rank")
