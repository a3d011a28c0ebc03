"""Supervised samples: lags, targets, context and the rules that reject a sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillcast.config import Grid, SampleSpec, Target
from rillcast.functions.timeaxis import (
    calendar,
    floor_div,
    step_months_supported,
    tick_of,
    tick_time,
)
from rillcast.operators.scan import halo, ranked
from rillcast.sources.staged import per_key

BLOCK_KEYS = ("site_id", "block")


def block_window(keys: Sequence[str] = BLOCK_KEYS):
    return Window.partitionBy(*keys).orderBy("tick")


def trailing_mean(value: Column, window: int, least: int, keys: Sequence[str] = BLOCK_KEYS) -> Column:
    """Mean of the last ``window`` rows; null when fewer than ``least`` are present."""
    w = block_window(keys).rowsBetween(1 - window, 0)
    return F.when(F.count(value).over(w) >= least, F.avg(value).over(w))


def _run_months(dense: frozenset[int]) -> list[int]:
    """For each month, how many months back the run of equally dense months began."""
    back = []
    for m in range(1, 13):
        n = 0
        while n < 12 and ((m - 2 - n) % 12 + 1 in dense) == (m in dense):
            n += 1
        back.append(n)
    return back


def stride_columns(tick: Column, lo: Column, grid: Grid, spec: SampleSpec) -> tuple[Column, Column]:
    """Stride at a tick, and whether the stepping from ``lo + lags`` lands on it.

    Stepping one tick at a time through dense months and ``stride`` ticks
    through the others does not depend on which samples are kept, so landing is
    a function of the tick and the start alone: a sparse run is entered at its
    first tick, a dense run at the first tick the sparse steps before it reach.
    """
    if not step_months_supported(grid, spec.stride):
        raise ValueError("a stride longer than a month is not supported")
    month = F.month(tick_time(tick, grid))
    dense = month.isin(sorted(spec.dense_months)) if spec.dense_months else F.lit(False)
    stride = F.when(dense, F.lit(1)).otherwise(F.lit(spec.stride)).cast("int")
    start = lo + F.lit(spec.lags)
    back = _run_months(spec.dense_months)
    if min(back) >= 12:  # all months alike: one run
        step = 1 if spec.dense_months else spec.stride
        return stride, (F.pmod(tick - start, F.lit(step)) == 0) & (tick >= start)

    months_back = F.element_at(F.array(*[F.lit(b) for b in back]), month)
    first_month = F.add_months(F.trunc(tick_time(tick, grid).cast("date"), "month"), -months_back)
    run = _first_tick(first_month, grid)
    run_start = F.greatest(start, run)
    # The run before a dense run: sparse, found from the last month it covers.
    last_sparse = F.add_months(first_month, -1)
    sparse_back = F.element_at(F.array(*[F.lit(b) for b in back]), F.month(last_sparse))
    before = F.greatest(start, _first_tick(F.add_months(last_sparse, -sparse_back), grid))
    ahead = F.pmod(before - run_start, F.lit(spec.stride))
    entry = F.when(run > start, run_start + ahead).otherwise(start)
    lands = F.when(dense, tick >= entry).otherwise(
        F.pmod(tick - run_start, F.lit(spec.stride)) == 0
    )
    return stride, lands & (tick >= start)


def _first_tick(date: Column, grid: Grid) -> Column:
    """First tick at or after midnight of a date."""
    return tick_of(date.cast("timestamp_ntz"), Grid(grid.step, "end", grid.block))


def stride_positions(ranges: DataFrame, keys: Sequence[str], grid: Grid, spec: SampleSpec) -> DataFrame:
    """Every visited forecast start of each series, from its range alone, a block of ticks at a time."""
    stride, lands = stride_columns(F.col("tick"), F.col("lo"), grid, spec)
    block = F.col("_block")
    blocks = ranges.withColumn(
        "_block", F.explode(F.sequence(floor_div(F.col("lo"), grid.block), floor_div(F.col("hi"), grid.block)))
    )
    ends = F.greatest(F.col("lo"), block * grid.block), F.least(F.col("hi"), (block + 1) * grid.block - 1)
    return (
        blocks.withColumn("tick", F.explode(F.sequence(*ends)))
        .drop("_block")
        .withColumns({"stride": stride, "lands": lands})
        .where(F.col("lands") & (F.col("tick") <= F.col("hi") - F.lit(spec.horizons - 1)))
        .drop("lands")
    )


def sample_blocks(
    rows: DataFrame,
    main: str,
    missing: Sequence[str],
    grid: Grid,
    spec: SampleSpec,
    context: bool,
    keys: Sequence[str] = BLOCK_KEYS,
    unbroken: bool = True,
) -> DataFrame:
    """Samples of regular rows that carry their halo (``lags`` back, ``horizons - 1`` ahead).

    One sort by (site, block, tick) serves every frame. Rejections use running
    maxima ("last bad tick so far", read ahead by the horizon), so their cost
    per row does not depend on the window length. Lags and targets are cut out
    of one array per block, for kept samples only.
    """
    L, H = spec.lags, spec.horizons
    w = block_window(keys)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    t = F.col("tick")

    # Last tick with a value, per raw series; a block without one counts from its start.
    seen = [
        F.coalesce(F.max(F.when(~F.col(m), t)).over(so_far), F.first(t).over(so_far) - 1)
        for m in missing
    ]
    oldest = F.least(*seen) if len(seen) > 1 else seen[0]
    observed = F.col(f"{main}_observed")
    first = {
        "_long_gap": t - oldest >= spec.max_gap,
        "_position": F.row_number().over(w),
        "_unobserved": F.max(F.when(observed.isNull(), t)).over(so_far),
        "_from": F.lag("tick", L).over(w),
        "_until": F.lead("tick", H - 1).over(w) if H > 1 else t,
    }
    if context:
        n = spec.context_window
        first |= {
            "snow_depth_latest": F.lag("snow_depth").over(w),
            "air_temp_avg_last_24h": F.avg("air_temp").over(w.rowsBetween(-n, -1)),
            "_precip": trailing_mean(F.col("precipitation"), n, spec.rolling_min, keys),
        }
    flagged = rows.withColumns(first)
    second = {
        "_last_gap": F.max(F.when(F.col("_long_gap"), t)).over(so_far),
        **({"precip_avg_last_24h": F.lag("_precip").over(w)} if context else {}),
    }
    flagged = flagged.withColumns(second)
    ahead = {
        "_gap_ahead": F.lead("_last_gap", H - 1).over(w) if H > 1 else F.col("_last_gap"),
        "_unobserved_ahead": F.lead("_unobserved", H - 1).over(w) if H > 1 else F.col("_unobserved"),
    }
    _, lands = stride_columns(t, F.col("lo"), grid, spec)
    kept = (
        F.col("core")
        & (t >= F.col("lo") + F.lit(L))
        & (t <= F.col("hi") - F.lit(H - 1))
        & lands
        & (F.coalesce(F.col("_gap_ahead"), F.lit(-(2**62))) < t - F.lit(L) + F.lit(spec.max_gap - 1))
        & (F.coalesce(F.col("_unobserved_ahead"), F.lit(-(2**62))) < t)
        & (F.col("_until") - F.col("_from") == L + H - 1)
    )
    if context:
        kept = kept & F.col("precip_avg_last_24h").isNotNull()
    names = ["snow_depth_latest", "air_temp_avg_last_24h", "precip_avg_last_24h"] if context else []
    # One array per block (block ticks and halo), then slices of it per kept sample.
    cells = F.array_sort(
        F.collect_list(F.struct(F.col("_position"), F.col(main).alias("v"), observed.alias("o")))
    )
    blocks = (
        flagged.withColumns(ahead)
        .groupBy(*keys)
        .agg(
            cells["v"].alias("_filled"),
            cells["o"].alias("_observed"),
            F.collect_list(F.when(kept, F.struct("tick", "_position", *names))).alias("_kept"),
        )
    )
    at = F.col("_sample._position")
    samples = blocks.select(*keys, "_filled", "_observed", F.explode("_kept").alias("_sample")).select(
        *[k for k in keys if k != "block"],
        F.col("_sample.tick").alias("tick"),
        *[F.col(f"_sample.{n}").alias(n) for n in names],
        F.slice("_filled", at - F.lit(L), L).alias("lags"),
        F.slice("_observed", at, H).alias("targets"),
    )
    stride, _ = stride_columns(t, F.lit(0), grid, spec)
    return samples.withColumn("forecast_start_time", tick_time(t, grid)).select(
        *[k for k in keys if k != "block"],
        tick_time(t - 1, grid).alias("history_end_time"),
        "forecast_start_time",
        tick_time(t + F.lit(H - 1), grid).alias("forecast_end_time"),
        *names,
        *[c.alias(n) for n, c in calendar("forecast_start_time").items()],
        stride.alias("sample_stride_hours"),
        "lags",
        "targets",
    )


def reach_back(spec: SampleSpec, context: bool) -> int:
    return max(spec.lags, spec.context_window if context else 0)


def samples_of_table(
    table: DataFrame, target: Target, grid: Grid, spec: SampleSpec, context: bool
) -> DataFrame:
    """Samples of an hourly table a user already has (``datetime``, value and flag columns).

    The table may have holes; windows that cross one are rejected.
    """
    main = target.main.name
    missing = [f"{f.name}_missing_raw" for f in target.features]
    exact = Grid(grid.step, "end", grid.block)
    rows = table.withColumn("tick", tick_of("datetime", exact))
    ranges = per_key(rows.groupBy("site_id").agg(F.min("tick").alias("lo"), F.max("tick").alias("hi")))
    back, ahead = reach_back(spec, context), spec.horizons - 1
    haloed = halo(rows.join(ranges, "site_id"), "tick", grid.block, back, ahead)
    return sample_blocks(haloed, main, missing, grid, spec, context)


def lag_table(rows: DataFrame, columns: Sequence[str], target: str, grid: Grid, lags: int) -> DataFrame:
    """Next-step layout: ``lags`` past values of many columns and one target.

    Kept when the whole history lies in the grid and the target was observed.
    Missing values keep their place. All columns of a block form one array, cut
    for kept rows only.
    """
    w = block_window()
    kept = (
        F.col("core")
        & (F.col("tick") >= F.col("lo") + F.lit(lags))
        & (F.col("_position") > F.lit(lags))
        & F.col(f"{target}_observed").isNotNull()
    )
    cells = F.array_sort(F.collect_list(F.struct("_position", *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])))
    ends = F.struct("tick", "_position", F.col(f"{target}_observed").alias("target"))
    blocks = (
        rows.withColumn("_position", F.row_number().over(w))
        .groupBy(*BLOCK_KEYS)
        .agg(cells.alias("_cells"), F.collect_list(F.when(kept, ends)).alias("_kept"))
    )
    arrays = [F.col("_cells")[f"_{i}"].alias(f"_{i}") for i in range(len(columns))]
    ready = blocks.select("site_id", *arrays, F.explode("_kept").alias("_end"))
    first = F.col("_end._position") - F.lit(lags)
    return ready.select(
        "site_id",
        tick_time("_end.tick", grid).alias("prediction_time"),
        F.col("_end.target").alias("target"),
        *[F.slice(f"_{i}", first, lags).alias(f"{c}_lags") for i, c in enumerate(columns)],
    )


def ratio_split(
    df: DataFrame, keys: Sequence[str], time: str, grid: Grid, ratio: float = 0.8
) -> DataFrame:
    """Chronological split: the first ``floor(ratio * n)`` rows per key train."""
    numbered = ranked(
        df, keys, [time], floor_div(tick_of(time, grid), grid.block), name="position"
    )
    cut = F.floor(F.col("position_total") * F.lit(ratio))
    return numbered.withColumn(
        "part", F.when(F.col("position") <= cut, F.lit("train")).otherwise(F.lit("test"))
    )


def to_columns(samples: DataFrame, prefix: str, lags: int, horizons: int) -> DataFrame:
    """Named columns at the file boundary: oldest lag first, then the targets."""
    plain = [c for c in samples.columns if c not in ("lags", "targets")]
    return samples.select(
        *plain,
        *[F.col("lags")[lags - k].alias(f"{prefix}_t-{k}") for k in range(lags, 0, -1)],
        *[F.col("targets")[h - 1].alias(f"target_{prefix}_t+{h}") for h in range(1, horizons + 1)],
    )


def from_columns(wide: DataFrame, prefix: str, lags: int, horizons: int) -> DataFrame:
    """Inverse of :func:`to_columns`."""
    lag_names = [f"{prefix}_t-{k}" for k in range(lags, 0, -1)]
    target_names = [f"target_{prefix}_t+{h}" for h in range(1, horizons + 1)]
    gone = set(lag_names) | set(target_names)
    return wide.select(
        *[F.col(f"`{c}`") for c in wide.columns if c not in gone],
        F.array(*[F.col(f"`{c}`") for c in lag_names]).alias("lags"),
        F.array(*[F.col(f"`{c}`") for c in target_names]).alias("targets"),
    )
