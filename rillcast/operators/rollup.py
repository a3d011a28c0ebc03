"""Summaries that merge: facts by series and day, forecast errors by cell. Reports roll up from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.operators.evaluate import skill

DAY_KEYS = ("site_id", "variable_id", "day_utc")


def series_days(facts: DataFrame, daily: bool = True) -> DataFrame:
    """Per series (and day): n, n_values, total, low, high, first and last time. Facts without a time have a null day."""
    day = F.date_trunc("day", "datetime_utc").cast("timestamp_ntz").alias("day_utc")
    return facts.groupBy("site_id", "variable_id", *([day] if daily else [])).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"), F.sum("value").alias("total"),
        F.min("value").alias("low"), F.max("value").alias("high"), F.min("datetime_utc").alias("first"), F.max("datetime_utc").alias("last"),
    )


def merged_days(days: DataFrame, keys: Sequence[str] = DAY_KEYS) -> DataFrame:
    """Summaries of the same cells, or of the days of a series, made one."""
    return days.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"),
    )


def overview_of(days: DataFrame) -> DataFrame:
    """The overview of all facts from their summaries."""
    return days.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.min("first").alias("min_datetime_utc"), F.max("last").alias("max_datetime_utc"),
        F.coalesce(F.sum(F.col("n") - F.col("n_values")), F.lit(0)).alias("null_values"), F.min("low").alias("min_value"), F.max("high").alias("max_value"),
        (F.sum("total") / F.nullif(F.sum("n_values"), F.lit(0))).alias("avg_value"),
    )


CUBE_KEYS = ("site_id", "season", "horizon_bin")
# Overall, by season, by season and horizon, and over all sites.
CUBE_LEVELS = ((), ("site_id", "season"), ("site_id", "season", "horizon_bin"), ("season", "horizon_bin"))
MOMENTS = ("n", "squares", "absolutes", "base_squares", "base_absolutes")


def level_name() -> Column:
    """Which keys a cell of the cube is told apart by."""
    marks = [F.when(F.grouping(k) == 0, F.lit(k)) for k in CUBE_KEYS]
    return F.concat_ws(",", *marks)


def error_cube(long: DataFrame, levels: Sequence[Sequence[str]] = CUBE_LEVELS, pred: str = "y_pred") -> DataFrame:
    """level, the keys (null where they aren't told apart) and sums of errors, for all levels in one aggregate.

    The sums merge: cubes of several runs add up to the cube of all their rows.
    """
    miss, base = F.col("y_true") - F.col(pred), F.col("y_true") - F.col("y_persistence")
    cells = long.select(*CUBE_KEYS, miss.alias("miss"), base.alias("base"))
    grouped = cells.groupingSets([[F.col(k) for k in level] for level in levels], *CUBE_KEYS)
    return grouped.agg(
        level_name().alias("level"), F.count(F.lit(1)).alias("n"), F.sum(F.col("miss") * F.col("miss")).alias("squares"), F.sum(F.abs("miss")).alias("absolutes"),
        F.sum(F.col("base") * F.col("base")).alias("base_squares"), F.sum(F.abs("base")).alias("base_absolutes"),
    )


def added_cubes(cubes: DataFrame) -> DataFrame:
    """Cubes of several runs, one under the other, as one."""
    return cubes.groupBy("level", *CUBE_KEYS).agg(*[F.sum(m).alias(m) for m in MOMENTS])


def cube_metrics(cube: DataFrame) -> DataFrame:
    """Error measures of every cell."""
    n = F.col("n")
    out = cube.select(
        "level", *CUBE_KEYS, "n", F.sqrt(F.col("squares") / n).alias("rmse"), (F.col("absolutes") / n).alias("mae"),
        F.sqrt(F.col("base_squares") / n).alias("persistence_rmse"), (F.col("base_absolutes") / n).alias("persistence_mae"),
    )
    return out.withColumns({
        "rmse_skill_vs_persistence": skill(F.col("rmse"), F.col("persistence_rmse")),
        "mae_skill_vs_persistence": skill(F.col("mae"), F.col("persistence_mae")),
    })
