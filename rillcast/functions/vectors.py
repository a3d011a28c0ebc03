"""Expressions on lag, target and forecast arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillcast.config import Clip, Grid
from rillcast.functions.timeaxis import season_code, shift

# Names and order of the per-step time features.
CYCLIC = (
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
    "day_of_year_frac",
)
SEASON_FLAGS = ("season_winter", "season_spring", "season_summer", "season_fall")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    Used inside a lambda a column expression would be computed once per
    element, because the optimizer writes it out where it is used.
    """
    return F.transform(F.array(value), body)[0]


def finite(x: Column) -> Column:
    """Null, NaN and infinite values become 0."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


def newest(lags: str = "lags") -> Column:
    return F.element_at(F.col(lags), -1)


def deltas(targets: str = "targets", base: Column | None = None) -> Column:
    b = newest() if base is None else base
    return let(b, lambda known: F.transform(F.col(targets), lambda y: y - known))


def absolute(delta: Column, base: Column) -> Column:
    return let(base, lambda known: F.transform(delta, lambda d: d + known))


def persistence(horizons: int, base: Column | None = None) -> Column:
    return F.array_repeat(newest() if base is None else base, horizons)


def largest_step(lags: str = "lags", strict: bool = True) -> Column:
    """Largest absolute change between neighbours.

    ``strict`` (training): a missing lag makes it 0. Otherwise (live) missing
    pairs are left out.
    """
    a = F.col(lags)
    n = F.size(a)
    change = F.zip_with(F.slice(a, 2, n - 1), F.slice(a, 1, n - 1), lambda x, y: F.abs(x - y))
    top = F.when(n > 1, F.array_max(change))
    if strict:
        top = F.when(~F.exists(a, lambda x: x.isNull() | F.isnan(x)), top)
    return finite(top)


def clipped(preds: Column, base: Column, step_limit: Column, clip: Clip) -> Column:
    """Limit each forecast step to the clipped step before it, plus or minus what is allowed."""
    if not clip.enabled:
        return preds

    def step(acc, p):
        prev = acc["prev"]
        room = F.greatest(F.lit(clip.floor), F.lit(clip.pct) * F.abs(prev), acc["limit"])
        value = F.least(F.greatest(p, prev - room), prev + room)
        return F.struct(
            value.alias("prev"),
            acc["limit"].alias("limit"),
            F.concat(acc["out"], F.array(value)).alias("out"),
        )

    start = F.struct(
        base.cast("double").alias("prev"),
        (F.lit(clip.multiplier) * step_limit).alias("limit"),
        F.array().cast("array<double>").alias("out"),
    )
    return F.aggregate(preds, start, step, lambda acc: acc["out"])


def time_features(ts: Column, season_flags: bool = True) -> list[Column]:
    """Cyclic features of one timestamp, in the fixed order."""

    def wave(x, period):
        angle = x * F.lit(2.0 * math.pi / period)
        return [F.sin(angle), F.cos(angle)]

    out = [
        *wave(F.hour(ts).cast("double"), 24.0),
        *wave(F.weekday(ts).cast("double"), 7.0),
        *wave((F.month(ts) - 1).cast("double"), 12.0),
        F.dayofyear(ts) / F.lit(366.0),
    ]
    if season_flags:
        code = season_code(F.month(ts))
        out += [(code == i).cast("double") for i in range(4)]
    return out


def time_feature_steps(
    lags: int, grid: Grid, end: str = "history_end_time", season_flags: bool = True
) -> Column:
    """Per lag step, oldest first, the time features at that step."""
    return F.transform(
        F.sequence(F.lit(lags), F.lit(1), F.lit(-1)),
        lambda k: F.array(*time_features(shift(end, F.lit(1) - k, grid), season_flags)),
    )

