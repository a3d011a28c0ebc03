"""Long predictions and error measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.config import Grid
from rillcast.functions.timeaxis import (
    HORIZON_BINS,
    SEASONS,
    horizon_bin,
    horizon_bin_order,
    season_name,
    season_order,
    shift,
)

VALUES = ("y_true", "y_pred", "y_pred_unclipped", "y_persistence")
# Column order of the combined metric files.
COMBINED_COLUMNS = (
    "target_variable",
    "site_id",
    "season",
    "horizon_bin",
    "n",
    "rmse",
    "mae",
    "rmse_skill_vs_persistence",
    "mae_skill_vs_persistence",
)


def expand(
    predictions: DataFrame,
    grid: Grid = Grid(),
    season_by: str = "target",
    extra: Sequence[str] = (),
    strict: bool = True,
    horizons: Sequence[int] | None = None,
) -> DataFrame:
    """One row per sample and horizon; ``horizons`` names the steps where they aren't 1, 2, ...

    ``season_by`` "target" names the season of the target time, "start" keeps
    the season of the model (``season_name``).
    """
    if season_by not in ("target", "start"):
        raise ValueError("season_by must be 'target' or 'start'")
    long = predictions.select(
        *extra,
        "site_id",
        "forecast_start_time",
        *(["season_name"] if season_by == "start" else []),
        F.posexplode(F.arrays_zip(*VALUES)).alias("_pos", "_v"),
    ).withColumns(
        {
            "horizon": F.col("_pos") + 1 if horizons is None else F.get(F.array(*[F.lit(h) for h in horizons]), "_pos"),
        }
    ).withColumn("target_timestamp", shift("forecast_start_time", F.col("horizon") - 1, grid))
    season = season_name(F.month("target_timestamp")) if season_by == "target" else F.col("season_name")
    return long.select(
        *extra,
        "site_id",
        "forecast_start_time",
        "horizon",
        horizon_bin("horizon", strict).alias("horizon_bin"),
        "target_timestamp",
        season.alias("season"),
        "_v.*",
    )


def by_target_season(long: DataFrame) -> DataFrame:
    """Re-derive the season from the target time, to compare models grouped differently."""
    return long.withColumn("season", season_name(F.month("target_timestamp")))


def skill(error: Column, baseline: Column) -> Column:
    """1 - error/baseline; null for a baseline without error."""
    return F.when(baseline > 0, 1 - error / baseline)


def _errors(pred: str = "y_pred") -> list[Column]:
    y, p, b = F.col("y_true"), F.col(pred), F.col("y_persistence")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.pow(y - p, F.lit(2)))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(y - b, F.lit(2)))).alias("persistence_rmse"),
        F.avg(F.abs(y - b)).alias("persistence_mae"),
    ]


def metrics(long: DataFrame, keys: Sequence[str] = (), pred: str = "y_pred") -> DataFrame:
    """Error measures over any keys; without keys one overall row."""
    grouped = long.groupBy(*keys).agg(*_errors(pred)) if keys else long.agg(*_errors(pred))
    return grouped.withColumns(
        {
            "rmse_skill_vs_persistence": skill(F.col("rmse"), F.col("persistence_rmse")),
            "mae_skill_vs_persistence": skill(F.col("mae"), F.col("persistence_mae")),
        }
    )


def in_logical_order(df: DataFrame) -> DataFrame:
    """Order by target, site, season and horizon bin, where present."""
    order = [c for c in ("target_variable", "site_id") if c in df.columns]
    if "season" in df.columns:
        order.append(season_order("season"))
    if "horizon_bin" in df.columns:
        order.append(horizon_bin_order("horizon_bin"))
    return df.orderBy(*order)


def season_metrics(long: DataFrame) -> DataFrame:
    return metrics(long, ("site_id", "season")).drop("n")


def horizon_metrics(long: DataFrame) -> DataFrame:
    return metrics(long, ("site_id", "season", "horizon_bin"))


def generic_metrics(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As the season-model files: no persistence columns."""
    return metrics(long, keys).drop("persistence_rmse", "persistence_mae")


def combine(parts: Mapping[str, DataFrame], columns: Sequence[str] = COMBINED_COLUMNS) -> DataFrame:
    """Metrics of several target variables, in the fixed column order."""
    out = None
    for name, part in parts.items():
        tagged = part.withColumn("target_variable", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out.select(*[c for c in columns if c in out.columns])


def stack_models(parts: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    out = None
    for name, part in parts.items():
        tagged = part.select(*columns).withColumn("model", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out.withColumn("season_label", F.initcap("season")) if "season" in columns else out


def compare_models(
    model: DataFrame,
    baseline: DataFrame,
    names: tuple[str, str] = ("model", "baseline"),
    keys: Sequence[str] = ("site_id", "season"),
    measures: Sequence[str] = ("rmse", "mae"),
) -> DataFrame:
    """Side-by-side errors and the improvement over the baseline in percent."""
    a, b = names
    left = model.select(*keys, *[F.col(m).alias(f"{m}_{a}") for m in measures])
    right = baseline.select(*keys, *[F.col(m).alias(f"{m}_{b}") for m in measures])
    return left.join(right, list(keys)).withColumns(
        {
            f"{m}_improvement_pct": 100 * (F.col(f"{m}_{b}") - F.col(f"{m}_{a}")) / F.col(f"{m}_{b}")
            for m in measures
        }
    )


def pivot_seasons(df: DataFrame, rows: str, value: str) -> DataFrame:
    """One column per season in the fixed order."""
    return df.groupBy(rows).pivot("season", list(SEASONS)).agg(F.first(value))


def pivot_bins(df: DataFrame, value: str, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Horizon bins down, seasons across; bins without data stay as empty rows."""
    cell = F.struct(F.concat_ws("/", "horizon_bin", "season"), F.col(value))
    # At most bins x seasons cells per key.
    held = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(cell)).alias("m"))
    labels = F.array(*[F.lit(b) for _, _, b in HORIZON_BINS])
    return held.withColumn("horizon_bin", F.explode(labels)).select(
        *keys,
        "horizon_bin",
        *[F.col("m")[F.concat_ws("/", "horizon_bin", F.lit(s))].alias(s) for s in SEASONS],
    )


def value_range(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Shared colour-scale ends."""
    aggs = [F.min(value).alias("vmin"), F.max(value).alias("vmax")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def run_summary(scored: DataFrame, split: DataFrame, keys: Sequence[str] = ("site_id",), grid: Grid = Grid()) -> DataFrame:
    """Per model: rows of both parts, split bounds and errors."""
    rows = split.groupBy(*keys).agg(
        F.count_if(F.col("part") == "train").alias("train_rows"),
        F.count_if(F.col("part") == "validation").alias("validation_rows"),
        F.min("validation_start").alias("validation_start"),
        F.max("validation_end").alias("validation_end"),
    )
    errors = metrics(
        expand(scored, grid, "start" if "season_name" in keys else "target", strict=False)
        .withColumnRenamed("season", "season_name"),
        keys,
    ).drop("n")
    return rows.join(errors, list(keys))
