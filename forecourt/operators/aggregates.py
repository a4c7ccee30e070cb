"""Rollups, pivots, weighted sums, regression fits, set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.periods import period_start
from forecourt.functions.scalars import array_first, array_joined
from forecourt.operators.spread import spread_join


def period_keys(keys: Sequence[str], ts: str | None, unit: str | None, out: str = "date") -> list[Column]:
    """Grouping columns: ``keys`` and, unless ``unit`` is None (lifetime), the period of ``ts``."""
    cols = [F.col(k) for k in keys]
    return cols + [period_start(F.col(ts), unit).alias(out)] if unit else cols


def count_by_period(df: DataFrame, keys: Sequence[str], ts: str | None = None, unit: str | None = None, out: str = "n", where: Column | None = None) -> DataFrame:
    """Row count per key [and period], optionally of the rows that pass ``where``."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*period_keys(keys, ts, unit)).agg(F.count("*").alias(out))


def share_by_period(df: DataFrame, keys: Sequence[str], hit: Column, ts: str | None = None, unit: str | None = None, out: str = "share") -> DataFrame:
    """Share of rows that pass ``hit``; rows where it is NULL count in the denominator."""
    return df.groupBy(*period_keys(keys, ts, unit)).agg((F.count_if(hit) / F.count("*").cast("double")).alias(out))


def distinct_by_period(df: DataFrame, keys: Sequence[str], value: str, ts: str | None = None, unit: str | None = None, out: str = "n") -> DataFrame:
    """Exact distinct count per key [and period]; Spark spreads a hot key by ``value`` first."""
    return df.groupBy(*period_keys(keys, ts, unit)).agg(F.countDistinct(value).alias(out))


def first_last_seen(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def count_by_label(df: DataFrame, keys: Sequence[str], labels: str, mixed: bool = False, ts: str | None = None, unit: str | None = None, out: str = "leads") -> DataFrame:
    """Count per key [, period] and label: the first label, or all of them joined with '-'."""
    label = array_joined(F.col(labels)) if mixed else array_first(F.col(labels))
    name = "mixed_lead_type" if mixed else "master_lead_type"
    return df.groupBy(*period_keys(keys, ts, unit), label.alias(name)).agg(F.count("*").alias(out))


def conditional_sums(df: DataFrame, keys: Sequence[str | Column], tag: str, tags: Mapping[str, str], values: Mapping[str, str]) -> DataFrame:
    """One sum per (tag, value): output ``<tag alias>_<value alias>``, 0 where the tag is absent."""
    zero = F.lit(0)
    aggs = [
        F.sum(F.when(F.col(tag) == t, F.col(v)).otherwise(zero)).alias(f"{alias}_{suffix}")
        for suffix, v in values.items()
        for alias, t in tags.items()
    ]
    return df.groupBy(*keys).agg(*aggs)


def weighted_sum(counts: DataFrame, weights: DataFrame, label: str, keys: Sequence[str], n: str, weight: str, out: str, missing_is_zero: bool) -> DataFrame:
    """Sum of ``n`` x ``weight`` per key. A label without weight counts 0, or is ignored (all ignored: NULL)."""
    w = weights.select(F.col(label).alias("_label"), F.col(weight).alias("_w"))
    joined = counts.join(w, F.col(label) == F.col("_label"), "left")
    factor = F.coalesce("_w", F.lit(0.0)) if missing_is_zero else F.col("_w")
    return joined.groupBy(*keys).agg(F.sum(F.col(n) * factor).alias(out))


def keys_with_many(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that have more than one distinct value."""
    return df.groupBy(key).agg(F.min(value).alias("_a"), F.max(value).alias("_b")).where("_a <> _b").select(key)


def mean_threshold(df: DataFrame, groups: Sequence[str], value: str, member: str, cut: float, out: str = "mileage") -> DataFrame:
    """Per group the mean lowered by ``cut`` and cut to an integer, once per distinct member."""
    mean = df.groupBy(*groups).agg((F.avg(value) * (1 - cut)).cast("int").alias(out))
    return spread_join(df.select(*groups, member).distinct(), mean, groups).select(*groups, member, out)


def linear_fit(df: DataFrame, groups: Sequence[str], x: str, y: str) -> DataFrame:
    """Least squares per group; a constant ``x`` has slope 0 and the mean as intercept."""
    return df.groupBy(*groups).agg(*line_of(F.col(x), F.col(y)))


def line_of(x: Column, y: Column) -> list[Column]:
    """Aggregates of a least-squares line: slope, intercept, r2, size. Rows with a NULL don't count."""
    return [
        F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("size"),
    ]


MOMENTS = ("n", "mean_x", "mean_y", "sxx", "syy", "sxy", "minimum", "maximum")


def moments(df: DataFrame, groups: Sequence[str], x: str, y: str) -> DataFrame:
    """What a least-squares line and its squared error follow from, per group: count, means, sums of squares and products
    about the means, least and greatest y. Rows with a NULL don't count; a group of such rows only has no row."""
    a, b = F.col(x), F.col(y)
    both = a.isNotNull() & b.isNotNull()
    found = df.where(both).groupBy(*groups).agg(
        F.regr_count(b, a).alias("n"), F.regr_avgx(b, a).alias("mean_x"), F.regr_avgy(b, a).alias("mean_y"),
        F.regr_sxx(b, a).alias("sxx"), F.regr_syy(b, a).alias("syy"), F.regr_sxy(b, a).alias("sxy"),
        F.min(b).alias("minimum"), F.max(b).alias("maximum"),
    )
    return found


def merge_moments(stored: DataFrame, added: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The moments of all rows behind two tables of them; no row is read again.

    Sums about the two means are moved to the common one, so that nothing large
    is subtracted from something as large.
    """
    old = stored.select(*[F.col(g).alias(f"_{g}") for g in groups], F.struct(*MOMENTS).alias("a"))
    new = added.select(*groups, F.struct(*MOMENTS).alias("b"))
    on = reduce(lambda p, q: p & q, [F.col(f"_{g}").eqNullSafe(F.col(g)) for g in groups])
    met = old.join(new, on, "full_outer")
    key = [F.when(F.col("b").isNull(), F.col(f"_{g}")).otherwise(F.col(g)).alias(g) for g in groups]
    n = F.col("a.n") + F.col("b.n")
    share = F.col("a.n") * F.col("b.n") / n
    gap_x, gap_y = F.col("b.mean_x") - F.col("a.mean_x"), F.col("b.mean_y") - F.col("a.mean_y")
    both = {
        "n": n,
        "mean_x": F.col("a.mean_x") + gap_x * F.col("b.n") / n,
        "mean_y": F.col("a.mean_y") + gap_y * F.col("b.n") / n,
        "sxx": F.col("a.sxx") + F.col("b.sxx") + gap_x * gap_x * share,
        "syy": F.col("a.syy") + F.col("b.syy") + gap_y * gap_y * share,
        "sxy": F.col("a.sxy") + F.col("b.sxy") + gap_x * gap_y * share,
        "minimum": F.least("a.minimum", "b.minimum"),
        "maximum": F.greatest("a.maximum", "b.maximum"),
    }
    one = lambda m: F.when(F.col("b").isNull(), F.col(f"a.{m}")).when(F.col("a").isNull(), F.col(f"b.{m}"))
    return met.select(*key, *[one(m).otherwise(both[m]).alias(m) for m in MOMENTS])


def fit_of_moments(found: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The line, as `linear_fit` gives it, with its mean squared error, mean prediction and the observed range."""
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(0.0)
    r2 = F.when(F.col("sxx") > 0, F.when(F.col("syy") > 0, F.col("sxy") * F.col("sxy") / (F.col("sxx") * F.col("syy"))).otherwise(1.0))
    wide = found.withColumn("slope", slope).withColumn("intercept", F.col("mean_y") - F.col("slope") * F.col("mean_x"))
    return wide.select(
        *groups,
        "slope",
        "intercept",
        r2.alias("r2"),
        F.col("n").alias("size"),
        (F.greatest(F.lit(0.0), F.col("syy") - F.col("slope") * F.col("sxy")) / F.col("n")).alias("mean_squared_error"),
        F.col("mean_y").alias("mean_observed"),
        (F.col("intercept") + F.col("slope") * F.col("mean_x")).alias("mean_predicted"),
        "minimum",
        "maximum",
    )


def fit_errors(df: DataFrame, fits: DataFrame, groups: Sequence[str], x: str, y: str) -> DataFrame:
    """Errors of the fitted line on the rows it was fitted to, with the observed range."""
    rows = spread_join(df, fits.select(*groups, "slope", "intercept"), groups)
    rows = rows.withColumn("_fit", F.col("intercept") + F.col("slope") * F.col(x))
    gap = F.col(y) - F.col("_fit")
    return rows.groupBy(*groups).agg(
        F.avg(gap * gap).alias("mean_squared_error"),
        F.avg(F.abs(gap)).alias("mean_absolute_error"),
        F.avg(y).alias("mean_observed"),
        F.avg("_fit").alias("mean_predicted"),
        F.min(y).alias("minimum"),
        F.max(y).alias("maximum"),
    )


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def union_feeds(feeds: Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    """UNION of feeds. Before a distinct count the de-duplication may be left out."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out.distinct() if distinct else out


def wide_to_long(df: DataFrame, keep: Sequence[str], label: str, rows: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One output row per entry of ``rows`` (label -> output columns), from one scan."""
    entries = [F.struct(F.lit(name).alias(label), *[c.alias(k) for k, c in cols.items()]) for name, cols in rows.items()]
    return df.select(*keep, F.explode(F.array(*entries)).alias("_row")).select(*keep, "_row.*")


def reconcile(expected: DataFrame, found: DataFrame, id_: str) -> DataFrame:
    """Every expected id with ``found`` true or false."""
    hits = found.select(F.col(id_).alias("_hit")).distinct()
    joined = expected.select(id_).distinct().join(hits, F.col(id_) == F.col("_hit"), "left")
    return joined.select(id_, F.col("_hit").isNotNull().alias("found"))


def reconcile_counts(expected: DataFrame, found: DataFrame, id_: str) -> DataFrame:
    """One row: expected ids, occurrences found in the archive, ids missing."""
    flags = reconcile(expected, found, id_)
    hits = found.select(id_).join(expected.select(id_).distinct(), [id_], "left_semi").agg(F.count("*")).scalar()
    return flags.agg(F.count("*").alias("expected"), hits.alias("matches"), F.count_if(~F.col("found")).alias("missing"))
