"""Observations to regular tables and training samples, all sites in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.config import MATCH_TERMS, Grid, SampleSpec, Target
from rillcast.functions.timeaxis import tick_time
from rillcast.operators.profile import find_variables
from rillcast.operators.regular import calendar_columns, regular_blocks
from rillcast.operators.scan import literal_rows
from rillcast.operators.samples import reach_back, sample_blocks, trailing_mean


def target_by_terms(
    target: Target, variables: DataFrame, terms: Mapping[str, Sequence[str]] = MATCH_TERMS, most: int = 1000
) -> Target:
    """The target with each feature's codes chosen by terms in variable codes and names; several codes feed one series.

    ``variables`` is the variable table (variable_code, name). A feature whose
    terms match nothing, or more than ``most`` codes, stops the job.
    """
    features = []
    for feature in target.features:
        found = find_variables(variables, terms[feature.name]).select("variable_code").distinct().limit(most + 1).collect()
        if not 0 < len(found) <= most:
            raise ValueError(f"{len(found)} variables match {list(terms[feature.name])}, expected 1 to {most}")
        features.append(replace(feature, variable_codes=tuple(sorted(r.variable_code for r in found))))
    return replace(target, features=tuple(features))


def has_context(target: Target) -> bool:
    return bool(target.rolling)


def regular_table(
    obs: DataFrame, target: Target, grid: Grid = Grid(), spec: SampleSpec = SampleSpec()
) -> DataFrame:
    """The full regular table: filled features, flags, rolling means, calendar."""
    before = spec.context_window - 1 if target.rolling else 0
    rows = regular_blocks(obs, target, grid, before=before)
    rows = rows.withColumns(
        {
            name: trailing_mean(F.col(source), spec.context_window, spec.rolling_min)
            for name, source in target.rolling.items()
        }
    )
    main = target.main.name
    table = rows.where("core").select(
        tick_time("tick", grid).alias("datetime"),
        F.col("site_id"),
        *[f.name for f in target.features],
        f"{main}_observed",
        *[f"{f.name}_missing_raw" for f in target.features],
        *target.rolling,
    )
    return calendar_columns(table, "datetime")


def training_samples(
    obs: DataFrame, target: Target, grid: Grid = Grid(), spec: SampleSpec = SampleSpec()
) -> DataFrame:
    """Samples of every target site straight from observations."""
    context = has_context(target)
    rows = regular_blocks(
        obs, target, grid, before=reach_back(spec, context), after=spec.horizons - 1
    )
    missing = [f"{f.name}_missing_raw" for f in target.features]
    return sample_blocks(rows, target.main.name, missing, grid, spec, context)


def require_samples(samples: DataFrame, target: Target) -> DataFrame:
    """Fail when a target site has no sample at all (one small aggregate)."""
    wanted = literal_rows(samples.sparkSession, "site_id int", [(i,) for i in target.site_ids])
    lost = sorted(r.site_id for r in wanted.join(samples.select("site_id").distinct(), "site_id", "left_anti").collect())
    if lost:
        raise ValueError(f"no {target.name} samples for sites {lost}")
    return samples
