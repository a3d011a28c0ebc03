"""Irregular observations to a regular, gap-filled table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.config import Feature, Grid, Target
from rillcast.functions.timeaxis import calendar, floor_div, micros, tick_of, tick_time
from rillcast.operators.scan import literal_rows, next_point, sized

OBS_KEYS = ("site_id", "variable_code")

# Fixed value: how many ticks a bounded fill reaches from either side of a gap.
REACH = 3


def series(obs: DataFrame, site_id: int, variable_ids: Sequence[int]) -> DataFrame:
    """One site's observations of several variables; both filters reach the scan."""
    return obs.where((F.col("site_id") == site_id) & F.col("variable_id").isin(list(variable_ids)))


def between(obs: DataFrame, after, until, time: str = "datetime_utc") -> DataFrame:
    """Half-open time range ``(after, until]``."""
    return obs.where((F.col(time) > F.lit(after)) & (F.col(time) <= F.lit(until)))


def blank_negative(value: Column, allowed: Column | bool) -> Column:
    """Negative values of variables that cannot be negative become missing."""
    ok = F.lit(allowed) if isinstance(allowed, bool) else allowed
    return F.when((value < 0) & ~ok, F.lit(None)).otherwise(value)


def present(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def negative_counts(obs: DataFrame, signed_codes: Sequence[str]) -> DataFrame:
    """How many values each series loses to the negative rule."""
    lost = (F.col("value") < 0) & ~F.col("variable_code").isin(list(signed_codes))
    return obs.groupBy(*OBS_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(lost).alias("n_negative")
    )


def bucket_last(
    obs: DataFrame,
    grid: Grid = Grid(),
    keys: Sequence[str] = OBS_KEYS,
    time: str = "datetime_utc",
    value: str = "value",
) -> DataFrame:
    """Last present value in each tick: ``keys, tick, value``.

    Missing values are dropped first, so a tick ending in a missing value uses
    the one before. Ties: larger variable_id, then larger datastream_id.
    """
    ties = [c for c in TIE_DIGITS if c in obs.columns and c not in keys]
    return (
        obs.where(present(F.col(value)))
        .groupBy(*keys, tick_of(time, grid).alias("tick"))
        .agg(F.max_by(F.col(value), packed_order(time, grid, ties)).alias("value"))
    )


# Digits that a tie column may need, counted from half its range up, so negative numbers keep their order.
TIE_DIGITS = {"variable_id": 10, "datastream_id": 16}


def packed_order(time: str, grid: Grid, ties: Sequence[str]) -> Column:
    """Place in the tick and tie columns as one fixed-width number, so the aggregate hashes instead of sorting.

    A number out of its range stops the job; a missing one comes first.
    """
    size = grid.step * 1_000_000
    place = F.pmod(micros(time) - F.lit(1 if grid.label == "end" else 0), F.lit(size))
    if not ties:
        return place
    if len(str(size)) + sum(TIE_DIGITS[c] for c in ties) > 38:
        raise ValueError("the step is too long for ties in one number")
    number = place.cast("decimal(38,0)")
    for c in ties:
        half = 10 ** TIE_DIGITS[c] // 2
        value = F.coalesce(F.col(c).cast("long"), F.lit(1 - half))
        fits = F.when(F.abs(value) < half, value + F.lit(half)).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} is out of range: "), value.cast("string"))).cast("long")
        )
        number = number * F.lit(10 ** TIE_DIGITS[c]).cast("decimal(17,0)") + fits.cast("decimal(17,0)")
        number = number.cast("decimal(38,0)")
    return number


def bounds(points: DataFrame, keys: Sequence[str] = OBS_KEYS) -> DataFrame:
    return points.groupBy(*keys).agg(F.min("tick").alias("lo"), F.max("tick").alias("hi"))


def overlap(series_bounds: DataFrame, by: str, expected: int) -> DataFrame:
    """Common range of the ``expected`` series of each ``by``; none when one is absent or they do not meet."""
    return (
        series_bounds.groupBy(by)
        .agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") == expected) & (F.col("lo") <= F.col("hi")))
        .drop("_n")
    )


def stretches(
    points: DataFrame, ranges: DataFrame | None, keys: Sequence[str], block: int | None
) -> DataFrame:
    """Cut each series' range into stretches that start at a point.

    A stretch is a point and the missing ticks behind it, with the next point
    attached; a leading stretch without a point covers missing ticks at the
    start. Columns: keys, lo, hi, prev_tick, prev_value, next_tick, next_value,
    first, last. Everything about a gap is known here, before any tick is
    written out. Without ``ranges`` a series spans its own first to last point.
    """
    if ranges is None:
        linked = next_point(points.select(*keys, "tick", "value"), keys, block, span=True)
    else:
        inside = points.join(ranges, list(keys)).where(
            F.col("tick").between(F.col("lo"), F.col("hi"))
        )
        opening = ranges.select(
            *keys,
            "lo",
            "hi",
            (F.col("lo") - 1).alias("tick"),
            F.lit(None).cast("double").alias("value"),
        )
        linked = next_point(inside.select(*opening.columns).unionByName(opening), keys, block)
    return as_stretches(linked, keys)


def as_stretches(linked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points with their next point (and range) to stretches; empty ones are left out."""
    is_point = F.col("value").isNotNull()
    return linked.select(
        *keys,
        "lo",
        "hi",
        F.when(is_point, F.col("tick")).alias("prev_tick"),
        F.col("value").alias("prev_value"),
        "next_tick",
        "next_value",
        F.greatest("tick", "lo").alias("first"),
        F.coalesce(F.col("next_tick") - 1, F.col("hi")).alias("last"),
    ).where(F.col("first") <= F.col("last"))


def into_blocks(runs: DataFrame, block: int, before: int = 0, after: int = 0) -> DataFrame:
    """Copy each stretch to the blocks (with their halo) it reaches, cut to them."""
    b = F.col("block")
    return (
        runs.withColumn(
            "block",
            F.explode(
                F.sequence(
                    floor_div(F.col("first") - F.lit(after), block),
                    floor_div(F.col("last") + F.lit(before), block),
                )
            ),
        )
        .withColumn("first", F.greatest(F.col("first"), b * F.lit(block) - F.lit(before)))
        .withColumn("last", F.least(F.col("last"), (b + 1) * F.lit(block) - F.lit(1) + F.lit(after)))
    )


def ticks(runs: DataFrame) -> DataFrame:
    return runs.withColumn("tick", F.explode(F.sequence("first", "last"))).drop("first", "last")


def observed_at() -> Column:
    return F.when(F.col("tick") == F.col("prev_tick"), F.col("prev_value"))


def filled(fill: str, reach: int = REACH) -> Column:
    """The value at ``tick`` under a fill rule, from the stretch's own columns."""
    p0, v0, p1, v1 = (F.col(c) for c in ("prev_tick", "prev_value", "next_tick", "next_value"))
    t = F.col("tick")
    slope = (v1 - v0) / (p1 - p0)
    steps = t - p0
    if fill == "time":
        return F.coalesce(v0 + slope * steps, v0, v1)
    if fill == "carry":
        return F.coalesce(v0, v1)
    if fill == "none":
        return observed_at()
    if fill != "bounded":
        raise ValueError(f"unsupported fill {fill!r}")
    near = F.lit(reach)
    line = F.coalesce(v0 + slope * F.least(steps, near), v0)
    return F.when(steps <= 2 * reach, line).when(p1 - t <= near, v1)


def gap_runs(points: DataFrame, grid: Grid, keys: Sequence[str] = OBS_KEYS) -> DataFrame:
    """Every run of missing ticks inside a series and its length. No tick is written out."""
    return (
        next_point(points, keys, grid.block)
        .where(F.col("next_tick") - F.col("tick") > 1)
        .select(
            *keys,
            tick_time(F.col("tick") + 1, grid).alias("gap_start"),
            tick_time(F.col("next_tick") - 1, grid).alias("gap_end"),
            (F.col("next_tick") - F.col("tick") - 1).alias("length"),
        )
    )


def fill_series(
    points: DataFrame,
    grid: Grid,
    fill: str,
    keys: Sequence[str] = OBS_KEYS,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Dense series per key with the observed and the filled value."""
    runs = stretches(points, ranges, keys, grid.block)
    return ticks(into_blocks(runs, grid.block)).select(
        *keys,
        "tick",
        tick_time("tick", grid).alias("datetime"),
        observed_at().alias("observed"),
        filled(fill).alias("value"),
    )


def feature_map(spark: SparkSession, target: Target) -> DataFrame:
    """Which series feeds which feature of which target site (from the settings)."""
    rows = [
        (site, f.name, f.site_id if f.site_id is not None else site, code)
        for site in target.site_ids
        for f in target.features
        for code in f.variable_codes
    ]
    table = literal_rows(
        spark, "target_site int, feature string, site_id int, variable_code string", rows
    )
    return sized(table, len(rows))


def wanted(obs: DataFrame, target: Target) -> DataFrame:
    """The observations a target reads, negatives blanked where they cannot occur."""
    codes = sorted({c for f in target.features for c in f.variable_codes})
    signed = sorted({c for f in target.features if f.allow_negative for c in f.variable_codes})
    sites = {f.site_id for f in target.features if f.site_id is not None}
    if any(f.site_id is None for f in target.features):
        sites |= set(target.site_ids)
    out = obs.where(F.col("variable_code").isin(codes))
    if target.site_ids:
        out = out.where(F.col("site_id").isin(sorted(sites)))
    allowed = F.col("variable_code").isin(signed) if signed else F.lit(False)
    return out.withColumn("value", blank_negative(F.col("value"), allowed)).where(
        present(F.col("value"))
    )


def feature_stretches(obs: DataFrame, target: Target, grid: Grid) -> DataFrame:
    """Stretches of every feature of every target site over their common range."""
    clean = wanted(obs, target)
    if len(target.features) == 1 and target.main.site_id is None:
        # Own series only: any number of sites, no mapping and no range join.
        points = bucket_last(
            clean.withColumnRenamed("site_id", "target_site"), grid, keys=("target_site",)
        )
        return stretches(points, None, ("target_site",), grid.block).withColumn(
            "feature", F.lit(target.main.name)
        )
    if not target.site_ids:
        raise ValueError("a target with support series needs its site ids")
    keys = ("target_site", "feature")
    mapping = feature_map(obs.sparkSession, target)
    by_series = ["site_id", "variable_code"]
    # Ticks rise with time, so the ends of a series need no bucketing.
    ends = (
        clean.groupBy(*by_series)
        .agg(F.min("datetime_utc").alias("a"), F.max("datetime_utc").alias("b"))
        .join(mapping, by_series)
        .groupBy(*keys)
        .agg(
            tick_of(F.min("a"), grid).alias("lo"),
            tick_of(F.max("b"), grid).alias("hi"),
        )
    )
    names = F.array(*[F.lit(f.name) for f in target.features])
    common = overlap(ends, "target_site", len(target.features)).withColumn(
        "feature", F.explode(names)
    )
    if any(len(f.variable_codes) > 1 for f in target.features):
        # Several codes feed one feature and compete for its ticks.
        points = bucket_last(clean.join(mapping, by_series), grid, keys=keys)
    else:
        points = bucket_last(clean, grid).join(mapping, by_series)
    n = len(target.site_ids) * len(target.features)
    return stretches(points.select(*keys, "tick", "value"), sized(common, n), keys, grid.block)


def regular_blocks(
    obs: DataFrame, target: Target, grid: Grid, before: int = 0, after: int = 0
) -> DataFrame:
    """Wide regular rows of all target sites, hash-partitioned by (site, block).

    Columns: site_id, block, tick, core, lo, hi, one filled column per feature,
    ``<feature>_observed``, ``<feature>_missing_raw``. Only stretches (points
    with their gap) are shuffled; ticks are written out after the shuffle, and
    the later frames by (site, block) need no other one.
    """
    runs = feature_stretches(obs, target, grid)
    cells = ticks(
        into_blocks(runs, grid.block, before, after).repartition("target_site", "block")
    )
    if len(target.features) == 1:
        f = target.main
        wide = cells.select(
            "target_site", "block", "tick", "lo", "hi",
            filled(f.fill).alias(f.name), observed_at().alias(f"{f.name}_observed"),
        )
    else:
        value = F.lit(None).cast("double")
        for f in target.features:
            value = F.when(F.col("feature") == f.name, filled(f.fill)).otherwise(value)
        cells = cells.select("target_site", "block", "feature", "tick", "lo", "hi",
                             value.alias("v"), observed_at().alias("o"))
        aggs = []
        for f in target.features:
            mine = F.col("feature") == f.name
            aggs += [
                F.max(F.when(mine, F.col("v"))).alias(f.name),
                F.max(F.when(mine, F.col("o"))).alias(f"{f.name}_observed"),
            ]
        wide = cells.groupBy("target_site", "block", "tick").agg(
            F.min("lo").alias("lo"), F.min("hi").alias("hi"), *aggs
        )
    return wide.withColumnRenamed("target_site", "site_id").withColumns(
        {
            "core": floor_div(F.col("tick"), grid.block) == F.col("block"),
            **{
                f"{f.name}_missing_raw": F.col(f"{f.name}_observed").isNull()
                for f in target.features
            },
        }
    )


def calendar_columns(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns(calendar(time))
