import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rillcast.config import AIR_TEMPERATURE, DAY, DISCHARGE, Feature, Grid, SampleSpec, Target
from rillcast.functions.timeaxis import tick_of, tick_time
from rillcast.operators.samples import (
    from_columns,
    lag_table,
    ratio_split,
    samples_of_table,
    stride_positions,
    to_columns,
)
from rillcast.plans.training import regular_table, require_samples, training_samples

ONE = Target("discharge", (1,), (Feature("discharge", ("Discharge",)),))


def loop_model(values, lags, horizons, gap, stride, dense, start):
    """Plain loop over one series; ``values`` maps hour offset to value."""
    lo, hi = min(values), max(values)
    n = hi - lo + 1
    out, idx = [], lags
    while idx <= n - horizons:
        t = start + dt.timedelta(hours=lo + idx)
        step = 1 if t.month in dense else stride
        window = [values.get(lo + i) for i in range(idx - lags, idx + horizons)]
        run = worst = 0
        for v in window:
            run = run + 1 if v is None else 0
            worst = max(worst, run)
        if worst < gap and all(v is not None for v in window[lags:]):
            out.append(t)
        idx += step
    return out


@pytest.mark.parametrize("seed,stride,first", [(0, 6, dt.datetime(2024, 2, 27)), (1, 1, dt.datetime(2024, 6, 29)), (2, 5, dt.datetime(2024, 2, 10))])
def test_random_series_match_a_loop(spark, obs, seed, stride, first):
    rng = random.Random(seed)
    values, h = {}, 0
    while h < 900:
        values[h] = rng.uniform(1, 9)
        h += rng.choice([1] * 60 + [4, 9, 10, 11, 12])
    spec = SampleSpec(lags=24, horizons=5, stride=stride)
    want = loop_model(values, 24, 5, 10, stride, spec.dense_months, first)
    for block in (4096, 50):
        s = training_samples(obs(values, start=first), ONE, Grid(block=block), spec)
        rows = s.orderBy("forecast_start_time").collect()
        assert [r.forecast_start_time for r in rows] == want
        assert all(len(r.lags) == 24 and len(r.targets) == 5 for r in rows)


@pytest.mark.parametrize("months", [{3, 4, 5, 6}, {12, 1}, set(), set(range(1, 13)), {2}, {11}])
def test_stride_positions_match_stepping(spark, months):
    grid = Grid(step=DAY)
    spec = SampleSpec(lags=10, horizons=3, stride=6, dense_months=frozenset(months))
    first = dt.datetime(2001, 1, 17)
    n = 1500
    want, idx = [], 10
    while idx <= n - 3:
        t = first + dt.timedelta(days=idx)
        want.append(t)
        idx += 1 if t.month in months else 6
    ranges = spark.createDataFrame([(1, first)], "site_id int, t timestamp_ntz").select(
        "site_id", tick_of("t", grid).alias("lo"), (tick_of("t", grid) + n - 1).alias("hi")
    )
    got = stride_positions(ranges, ["site_id"], grid, spec).select(tick_time("tick", grid).alias("t"))
    assert [r.t for r in got.orderBy("t").collect()] == want


def test_strides_longer_than_a_month_are_refused(spark, obs):
    with pytest.raises(ValueError):
        training_samples(obs({0: 1.0, 1: 2.0}), ONE, Grid(), SampleSpec(stride=700))


def test_gap_straddling_the_window_start_does_not_count(spark, obs):
    # Hours 10-19 are missing: ten in a row. From start hour 20 + lags - 9 on, only nine lie in the window.
    values = {h: 1.0 for h in range(80) if not 10 <= h <= 19}
    spec = SampleSpec(lags=24, horizons=2, stride=1)
    first = training_samples(obs(values), ONE, Grid(), spec).agg(F.min("forecast_start_time")).first()[0]
    assert first == dt.datetime(2024, 1, 1) + dt.timedelta(hours=11 + 24)


def test_lags_are_filled_and_targets_observed(spark, obs, hours):
    values = {h: float(h) for h in range(60) if h != 20}
    s = training_samples(obs(values), ONE, Grid(), SampleSpec(lags=24, horizons=2, stride=1))
    row = s.where(F.col("forecast_start_time") == hours(30)).first()
    assert row.lags == [float(h) for h in range(6, 30)] and row.targets == [30.0, 31.0]
    assert row.history_end_time == hours(29) and row.forecast_end_time == hours(31)


def test_column_names_and_counts_at_the_file_boundary(spark, obs):
    full = {h: 1.0 for h in range(400)}
    o = obs(full, 3).unionByName(obs(full, 2, "AirTemp")).unionByName(obs(full, 2, "Precip")).unionByName(
        obs(full, 1, "SnowDepth")
    )
    target = Target("discharge", (3,), DISCHARGE.features, DISCHARGE.rolling)
    wide = to_columns(training_samples(o, target), "discharge", 168, 24)
    assert len(wide.columns) == 207
    assert wide.columns[15] == "discharge_t-168" and wide.columns[-1] == "target_discharge_t+24"
    air = Target("air_temperature", (2,), AIR_TEMPERATURE.features)
    assert len(to_columns(training_samples(o, air), "air_temp", 168, 24).columns) == 204
    back = from_columns(wide, "discharge", 168, 24)
    assert back.first().lags == [1.0] * 168


def test_missing_rolling_mean_rejects(spark, obs):
    full = {h: 1.0 for h in range(120)}
    rain = {h: 1.0 for h in range(120) if not 40 <= h <= 52 or h % 2}
    o = obs(full, 3).unionByName(obs(full, 2, "AirTemp")).unionByName(obs(rain, 2, "Precip")).unionByName(
        obs(full, 1, "SnowDepth")
    )
    target = Target("discharge", (3,), DISCHARGE.features, DISCHARGE.rolling)
    spec = SampleSpec(lags=24, horizons=2, stride=1, rolling_min=24)
    whole = training_samples(o, target, Grid(), spec).count()
    assert 0 < whole <= 120 - 24 - 2 + 1


def test_a_table_the_user_has_gives_the_same_samples(spark, obs):
    rng = random.Random(3)
    values = {h: rng.uniform(1, 9) for h in range(300) if rng.random() > 0.1 or h in (0, 299)}
    spec = SampleSpec(lags=24, horizons=3, stride=2)
    direct = training_samples(obs(values), ONE, Grid(), spec)
    table = regular_table(obs(values), ONE)
    again = samples_of_table(table, ONE, Grid(block=40), spec, context=False)
    key = lambda df: [(r.forecast_start_time, r.lags, r.targets) for r in df.orderBy("forecast_start_time").collect()]
    assert key(direct) == key(again)


def test_a_table_with_a_hole_rejects_windows_across_it(spark, obs, hours):
    table = regular_table(obs({h: float(h) for h in range(100)}), ONE).where(F.col("datetime") != hours(50))
    s = samples_of_table(table, ONE, Grid(), SampleSpec(lags=5, horizons=2, stride=1), context=False)
    starts = {r.forecast_start_time for r in s.collect()}
    assert hours(48) in starts and hours(49) not in starts and hours(55) not in starts and hours(56) in starts


def test_empty_sites_are_reported(spark, obs):
    s = training_samples(obs({0: 1.0, 1: 2.0}), ONE)
    with pytest.raises(ValueError, match="no discharge samples"):
        require_samples(s, ONE)


def test_ratio_split_takes_the_floor(spark, hours):
    df = spark.createDataFrame([(1, hours(h)) for h in range(11)], "site_id int, t timestamp_ntz")
    got = ratio_split(df, ["site_id"], "t", Grid(block=3)).orderBy("t").collect()
    assert [r.part for r in got] == ["train"] * 8 + ["test"] * 3


def test_lag_table_keeps_missing_values_in_place(spark):
    rows = spark.createDataFrame(
        [(1, 0, t, 0, True, float(t), None if t in (2, 5) else float(10 * t), float(t)) for t in range(8)],
        "site_id int, block long, tick long, lo long, core boolean, a double, b double, a_observed double",
    )
    got = {r.target: (r.a_lags, r.b_lags) for r in lag_table(rows, ["a", "b"], "a", Grid(), 4).collect()}
    assert sorted(got) == [4.0, 5.0, 6.0, 7.0]
    assert got[6.0] == ([2.0, 3.0, 4.0, 5.0], [None, 30.0, 40.0, None])
