"""Ticks, calendar parts, seasons and horizon labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillcast.config import HOUR, Grid

# Season names by code (DJF, MAM, JJA, SON) and the horizon labels.
SEASONS = ("winter", "spring", "summer", "fall")
HORIZON_BINS = ((1, 6, "0-6"), (7, 12, "6-12"), (13, 18, "12-18"), (19, 24, "18-24"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def floor_div(n: Column, d: int) -> Column:
    """Integer division rounding down, exact for negative numbers too."""
    return F.call_function("div", n - F.pmod(n, F.lit(d)), F.lit(d))


def tick_of(ts: Column | str, grid: Grid) -> Column:
    """Tick of a timestamp; values exactly on the grid keep their own tick."""
    size = grid.step * 1_000_000
    m = micros(ts)
    rest = F.pmod(m, F.lit(size))
    down = F.call_function("div", m - rest, F.lit(size))
    if grid.label == "start":
        return down
    return down + F.when(rest > 0, F.lit(1)).otherwise(F.lit(0))


def tick_time(tick: Column | str, grid: Grid) -> Column:
    return F.timestamp_seconds(_col(tick) * F.lit(grid.step)).cast("timestamp_ntz")


def shift(ts: Column | str, steps: Column | int, grid: Grid) -> Column:
    """The timestamp moved by a number of steps."""
    steps = F.lit(steps) if isinstance(steps, int) else steps
    return F.timestamp_micros(micros(ts) + steps.cast("long") * F.lit(grid.step * 1_000_000)).cast("timestamp_ntz")


def on_grid(ts: Column | str, grid: Grid = Grid()) -> Column:
    return F.pmod(micros(ts), F.lit(grid.step * 1_000_000)) == 0


def next_exact(ts: Column | str, grid: Grid = Grid()) -> Column:
    """First grid time strictly after the timestamp."""
    size = grid.step * 1_000_000
    m = micros(ts)
    return F.timestamp_micros(m - F.pmod(m, F.lit(size)) + F.lit(size)).cast("timestamp_ntz")


def season_code(month: Column | str) -> Column:
    return F.floor(F.pmod(_col(month), F.lit(12)) / 3).cast("int")


def season_name_of_code(code: Column | str) -> Column:
    """Name of a season code; null for codes outside 0-3."""
    c = _col(code)
    out = F.lit(None).cast("string")
    for i, name in enumerate(SEASONS):
        out = F.when(c == i, F.lit(name)).otherwise(out)
    return out


def season_name(month: Column | str) -> Column:
    return season_name_of_code(season_code(month))


def season_order(name: Column | str) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEASONS]), _col(name))


def calendar(ts: Column | str) -> dict[str, Column]:
    """year, month, day, hour, day_of_week (Monday 0), day_of_year, season."""
    t = _col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "day_of_week": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "season": season_code(F.month(t)),
    }


def horizon_bin(h: Column | str, strict: bool = True) -> Column:
    """Label of a forecast step. Outside the table: an error, or the number as text."""
    h = _col(h)
    other = (
        F.raise_error(F.concat(F.lit("unsupported horizon "), h.cast("string"))).cast("string")
        if strict
        else h.cast("string")
    )
    out = other
    for lo, hi, label in reversed(HORIZON_BINS):
        out = F.when(h.between(lo, hi), F.lit(label)).otherwise(out)
    return out


def horizon_bin_order(label: Column | str) -> Column:
    return F.array_position(F.array(*[F.lit(b) for _, _, b in HORIZON_BINS]), _col(label))


def step_months_supported(grid: Grid, stride: int) -> bool:
    """A month must be at least one stride long for the closed-form stride rule."""
    return stride * grid.step <= 28 * 24 * HOUR
