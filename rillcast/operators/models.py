"""Forecasters fitted and applied as set-based jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.config import Clip
from rillcast.functions.vectors import (
    absolute,
    clipped,
    deltas,
    largest_step,
    let,
    newest,
    persistence,
)
from rillcast.sources.staged import per_key

GROUP = ("site_id", "season_name")


def departure():
    """How far the newest lag lies from the mean of its history."""
    total = F.aggregate("lags", F.lit(0.0), lambda s, x: s + x)
    return newest() - total / F.size("lags")


def fit_linear(train: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Per group and horizon: delta = intercept + slope · departure, least squares.

    All groups and horizons are fitted by one aggregate; a group of any size is
    combined on the map side. A constant departure gives slope 0.
    """
    # The departure is computed before the explode, once per sample.
    per_sample = train.select(*keys, departure().alias("x"), deltas().alias("d"))
    long = per_sample.select(*keys, "x", F.posexplode("d").alias("pos", "y")).withColumn(
        "horizon", F.col("pos") + 1
    )
    fitted = long.groupBy(*keys, "horizon").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "x").alias("_slope"),
        F.regr_intercept("y", "x").alias("_intercept"),
        F.avg("y").alias("_mean"),
    )
    return fitted.select(
        *keys,
        "horizon",
        "n",
        F.coalesce("_slope", F.lit(0.0)).alias("slope"),
        F.when(F.col("_slope").isNull(), F.col("_mean")).otherwise(F.col("_intercept")).alias("intercept"),
    )


def linear_registry(fitted: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """One row per model with coefficient arrays in horizon order."""
    return (
        fitted.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("horizon", "slope", "intercept"))).alias("m"))
        .select(*keys, F.col("m.slope").alias("slopes"), F.col("m.intercept").alias("intercepts"))
    )


def with_forecasts(df: DataFrame, predicted_deltas, clip: Clip, horizons: int) -> DataFrame:
    """Absolute forecasts from predicted deltas: unclipped, clipped and persistence."""
    base = newest()
    return (
        df.withColumn("y_pred_unclipped", absolute(predicted_deltas, base))
        .withColumn("y_pred", clipped(F.col("y_pred_unclipped"), base, largest_step(), clip))
        .withColumn("y_persistence", persistence(horizons))
        .withColumnRenamed("targets", "y_true")
    )


def score_linear(
    df: DataFrame, registry: DataFrame, horizons: int, clip: Clip = Clip(), keys: Sequence[str] = GROUP
) -> DataFrame:
    """Forecasts of every sample that has a model."""
    predicted = let(
        departure(), lambda x: F.zip_with("slopes", "intercepts", lambda s, i: i + s * x)
    )
    return with_forecasts(df.join(per_key(registry), list(keys)), predicted, clip, horizons).drop(
        "slopes", "intercepts"
    )


def score_with(
    df: DataFrame, predict: Callable, features: str, horizons: int, clip: Clip = Clip()
) -> DataFrame:
    """Hook for any model: ``predict`` maps a 2-d numpy array of features to one of deltas.

    Runs on Arrow batches of ordinary partitions; no group is gathered.
    """
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = np.array(batch[features].tolist(), dtype="float64")
            if len(x):
                batch["_deltas"] = list(np.asarray(predict(x), dtype="float64"))
                yield batch

    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
    ) + ", _deltas array<double>"
    scored = df.mapInPandas(run, schema)
    return with_forecasts(scored, F.col("_deltas"), clip, horizons).drop("_deltas")


def pooled_rows(df: DataFrame, horizons: Sequence[int], features: str = "features") -> DataFrame:
    """One row per sample and horizon; site and horizon are features behind the others."""
    wide = F.concat(F.col(features), F.array(F.col("site_id").cast("double"), F.col("horizon").cast("double")))
    return df.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons]))).withColumn(
        "_vector", array_to_vector(wide)
    )


def fit_boosted(
    train: DataFrame,
    horizons: Sequence[int],
    trees: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    subsample: float = 0.8,
    seed: int = 42,
    label: str = "scaled_deltas",
    features: str = "features",
):
    """Boosted trees for all sites and horizons: one distributed fit, however many there are.

    Trees split on site and horizon like on any feature, so the plan doesn't
    grow with either and a site with few samples still gets forecasts.
    """
    rows = pooled_rows(train, horizons, features).select("_vector", F.element_at(label, F.col("horizon")).alias("label"))
    learner = GBTRegressor(
        featuresCol="_vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate,
        subsamplingRate=subsample, seed=seed,
    )
    return learner.fit(rows)


def score_boosted(
    df: DataFrame, model, horizons: Sequence[int], clip: Clip = Clip(), keys: Sequence[str] = ("site_id", "forecast_start_time")
) -> DataFrame:
    """Forecasts of every sample, in horizon order; ``keys`` name a sample.

    The clip limits each step by the one before, so it needs horizons without
    a gap; others are refused unless it is off.
    """
    if clip.enabled and list(horizons) != list(range(1, len(horizons) + 1)):
        raise ValueError("clipping needs the horizons 1, 2, ... without a gap")
    long = model.transform(pooled_rows(df, horizons).select(*keys, "horizon", "_vector"))
    # At most one row per horizon and sample.
    scored = long.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("horizon", "prediction"))).alias("_p"))
    joined = df.join(scored, list(keys))
    back = F.transform("_p", lambda p: p["prediction"] * F.col("delta_scale") + F.col("delta_mean"))
    wanted = F.array(*[F.element_at("targets", h) for h in sorted(horizons)])
    return with_forecasts(joined.withColumn("targets", wanted), back, clip, len(horizons)).drop("_p")
