"""List-price models per vehicle: outliers, fits, acceptance, borrowed models, publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import scalars as S
from forecourt.operators.aggregates import fit_errors, line_of
from forecourt.operators.joins import match_tiered
from forecourt.operators.spread import spread_join, with_group_stats
from forecourt.plans.catalog import VEHICLE, catalog_clean, training_set
from forecourt.session import materialize

# Bounds of an accepted model.
MIN_VEHICLES, MAX_VEHICLES = 15, 100
PRICE_FACTOR, MSRP_FACTOR = 3.0, 1.5
LOSS_MILES, MIN_LOSS, MAX_LOSS = 100000.0, 0.125, 0.75
MATCH_TOLERANCE = 0.05
# Status of a training row.
STATUS = {
    "too few vehicles": 1,
    "outlier": 2,
    "included": 3,
    "bad coefficient": 4,
    "bad intercept": 4,
    "depreciation too fast": 5,
    "depreciation too slow": 6,
}
# Published constants of a model.
TRADE_INTERCEPT, MULTIPLIER, MILEAGE_THRESHOLD = -2500.0, 0.9, 0.0


def price_outlier(mean_price: str = "mean_price", factor: float = PRICE_FACTOR) -> Column:
    return F.col("price") > F.col(mean_price) * factor


def msrp_outlier(factor: float = MSRP_FACTOR) -> Column:
    return (F.col("msrp") > 0) & (F.col("price") > F.col("msrp") * factor)


def price_outliers(rows: DataFrame, groups=VEHICLE, ratio: float | None = None) -> DataFrame:
    """Flag outliers by group mean price and by msrp, and by price per mile if ``ratio`` is given."""
    per_mile = F.try_divide(F.col("price"), F.col("mileage"))
    aggs = [F.avg("price").alias("mean_price")]
    if ratio is not None:
        aggs.append(F.avg(per_mile).alias("mean_per_mile"))
    out = with_group_stats(rows, groups, *aggs)
    off = lambda c: F.coalesce(c, F.lit(False))
    out = out.withColumns({"price_outlier": off(price_outlier()), "msrp_outlier": off(msrp_outlier())})
    if ratio is not None:
        out = out.withColumn("ratio_outlier", off(per_mile > F.col("mean_per_mile") * ratio)).drop("mean_per_mile")
    return out.drop("mean_price")


def _marked(training: DataFrame) -> DataFrame:
    """Training rows of complete groups with their outlier flag."""
    whole = training.dropna(subset=list(VEHICLE))
    flagged = price_outliers(whole)
    return flagged.withColumn("outlier", F.col("price_outlier") | F.col("msrp_outlier")).drop("price_outlier", "msrp_outlier")


def _loss() -> Column:
    """Share of the price lost over the reference mileage; an intercept of 0 loses without bound."""
    loss = F.try_divide(-F.lit(LOSS_MILES) * F.col("slope"), F.col("intercept"))
    return F.coalesce(loss, F.lit(float("inf")))


def _verdict() -> Column:
    """Why a group has no model, or that it is included; tests in order, the first that fails names it."""
    tests = [
        ("too few vehicles", F.col("rows") < MIN_VEHICLES),
        ("too few vehicles", F.coalesce("size", F.lit(0)) < MIN_VEHICLES),
        ("bad coefficient", ~(F.col("slope") < 0)),
        ("bad intercept", F.col("intercept") < 0),
        ("depreciation too slow", _loss() < MIN_LOSS),
        ("depreciation too fast", _loss() > MAX_LOSS),
    ]
    verdict = F.lit(STATUS["included"])
    for name, failed in reversed(tests):
        verdict = F.when(failed, STATUS[name]).otherwise(verdict)
    return verdict


def training_rows(listings: DataFrame, catalog_rows: DataFrame) -> DataFrame:
    """The training set of the models: the newest listings of each vehicle, ties included, written once, as is the catalog."""
    clean = materialize(catalog_clean(catalog_rows), "catalog")
    rows = training_set(listings, clean, MAX_VEHICLES)
    return materialize(rows.select("vin", *VEHICLE, "body_type", "msrp", "mileage", "price"), "training")


def group_fits(training: DataFrame) -> DataFrame:
    """One row per vehicle: row count, mean msrp, body type, fit without outliers, verdict."""
    return _fits(_marked(training))


def _fits(marked: DataFrame) -> DataFrame:
    kept = lambda c: F.when(~F.col("outlier"), F.col(c))
    whole = [F.count("*").alias("rows"), F.avg("msrp").alias("msrp"), F.min("body_type").alias("body_type")]
    return marked.groupBy(*VEHICLE).agg(*whole, *line_of(kept("mileage"), kept("price"))).withColumn("verdict", _verdict())


def training_status(training: DataFrame) -> DataFrame:
    """Training rows with their status code; rows with an incomplete vehicle have none.

    The rows with their outlier flag are written once, for the fits and for the status.
    """
    flagged = materialize(_marked(training), "marked")
    fits = _fits(flagged).select(*VEHICLE, "rows", "verdict")
    marked = spread_join(flagged, fits, VEHICLE)
    # Outliers are only looked for in groups that are large enough.
    status = F.when(F.col("outlier") & (F.col("rows") >= MIN_VEHICLES), STATUS["outlier"]).otherwise(F.col("verdict"))
    done = marked.withColumn("status", status).drop("outlier", "rows", "verdict")
    complete = F.lit(True)
    for c in VEHICLE:
        complete = complete & F.col(c).isNotNull()
    bare = training.where(~complete).withColumn("status", F.lit(None).cast("int"))
    return done.unionByName(bare)


RECORD = (
    "intercept", "coefficient", "r2", "mean_squared_error", "mean_absolute_error", "size", "body_type", "msrp",
    "mean_observed_list_price", "mean_predicted_list_price", "minimum_list_price", "maximum_list_price",
)


def price_models(training: DataFrame, session_id: Column | None = None) -> DataFrame:
    """One model per vehicle that has or can borrow one; ``session_id`` names the run in every row.

    ``tier`` is 0 for an own model; a borrowed one carries its tier, the
    lender's figures, and the lender's key in ``match_*``. Pass a written
    ``training`` table: it is read several times. The fits and own models, one
    row per vehicle, are written once for the steps that share them.
    """
    marked = materialize(_marked(training), "marked")
    fits = materialize(_fits(marked), "fits")
    good = fits.where(F.col("verdict") == STATUS["included"])
    kept = marked.where(~F.col("outlier"))
    errors = fit_errors(kept, good, VEHICLE, "mileage", "price").select(
        *VEHICLE,
        "mean_squared_error",
        "mean_absolute_error",
        F.col("mean_observed").alias("mean_observed_list_price"),
        F.col("mean_predicted").alias("mean_predicted_list_price"),
        F.col("minimum").alias("minimum_list_price"),
        F.col("maximum").alias("maximum_list_price"),
    )
    own = spread_join(good.withColumnRenamed("slope", "coefficient"), errors, VEHICLE).select(*VEHICLE, *RECORD)
    own = materialize(own, "models")
    wanted = fits.where(F.col("verdict") != STATUS["included"]).select(*VEHICLE, "body_type", "msrp")
    lent = match_tiered(wanted, own.select(*VEHICLE, "body_type", "msrp"), VEHICLE, tolerance=MATCH_TOLERANCE)
    record = own.select(*[F.col(c).alias(f"match_{c}") for c in VEHICLE], *RECORD)
    borrowed = spread_join(lent, record, [f"match_{c}" for c in VEHICLE])
    own = own.withColumn("tier", F.lit(0)).withColumns({f"match_{c}": F.lit(None).cast(own.schema[c].dataType) for c in VEHICLE})
    models = own.unionByName(borrowed.select(*own.columns))
    return models if session_id is None else models.withColumn("session_id", session_id)


def models_view(models: DataFrame, as_of: Column, as_shipped: bool = False) -> DataFrame:
    """Published models; ``models`` has a ``session_id``.

    A borrowed model is published under the borrowing vehicle; ``as_shipped``
    publishes it under the lender's name, as the original view does.
    """
    named = {c: F.coalesce(F.col(f"match_{c}"), F.col(c)) if as_shipped else F.col(c) for c in VEHICLE}
    return models.select(
        "session_id",
        F.lit(0).alias("vehicle_id"),
        F.col("intercept").alias("list_price_intercept"),
        F.to_json(F.struct(F.col("coefficient").alias("mileage"))).alias("list_price_coefficients"),
        F.lit(TRADE_INTERCEPT).alias("trade_value_intercept"),
        F.to_json(F.struct(S.age_factor(named["year"], as_of).alias("estimated_list_price"))).alias("trade_value_coefficients"),
        *[c.alias(n) for n, c in named.items()],
        F.col("size").cast("int").alias("vehicles"),
        "body_type",
        "msrp",
        F.lit(MULTIPLIER).alias("multiplier"),
        "minimum_list_price",
        "maximum_list_price",
        F.lit(MILEAGE_THRESHOLD).alias("minimum_mileage_threshold"),
    )


def latest_models(models: DataFrame, sessions: DataFrame, as_of: Column, as_shipped: bool = False) -> DataFrame:
    """Published models of the newest validated session."""
    current = sessions.where("validated").agg(F.max("id")).scalar()
    return models_view(models.where(F.col("session_id") == current), as_of, as_shipped)
