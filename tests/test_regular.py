import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillcast.config import DISCHARGE, Feature, Grid, Target
from rillcast.functions.timeaxis import calendar, horizon_bin, next_exact, tick_of, tick_time
from rillcast.operators.regular import (
    blank_negative,
    bucket_last,
    fill_series,
    gap_runs,
    series,
)
from rillcast.operators.scan import dense_ids, ranked
from rillcast.plans.training import regular_table

HOUR = Grid()


def dense(df):
    return [r.value for r in df.orderBy("tick").collect()]


def points(spark, values):
    rows = [(1, "X", h, float(v)) for h, v in values.items()]
    return spark.createDataFrame(rows, "site_id int, variable_code string, tick long, value double")


def test_bounded_fill_of_a_long_gap(spark):
    out = dense(fill_series(points(spark, {0: 10, 13: 36}), HOUR, "bounded"))
    assert out == [10, 12, 14, 16, 16, 16, 16, None, None, None, 36, 36, 36, 36]


def test_bounded_fill_of_a_gap_of_eight(spark):
    out = dense(fill_series(points(spark, {0: 5, 9: 14}), HOUR, "bounded"))
    assert out == [5, 6, 7, 8, 8, 8, 8, 14, 14, 14]


def test_fill_at_the_edges(spark):
    ranges = spark.createDataFrame([(1, "X", 0, 16)], "site_id int, variable_code string, lo long, hi long")
    p = points(spark, {5: 10, 8: 36})
    bounded = dense(fill_series(p, HOUR, "bounded", ranges=ranges))
    assert bounded[:5] == [None, None, 10, 10, 10]
    assert bounded[9:] == [36] * 6 + [None, None]
    time = dense(fill_series(p, HOUR, "time", ranges=ranges))
    assert time[:5] == [10] * 5 and time[9:] == [36] * 8
    carry = dense(fill_series(p, HOUR, "carry", ranges=ranges))
    assert carry[:5] == [10] * 5 and carry[6:8] == [10, 10] and carry[9:] == [36] * 8


def test_range_without_any_point_gives_missing_rows(spark):
    ranges = spark.createDataFrame([(1, "X", 0, 3)], "site_id int, variable_code string, lo long, hi long")
    out = fill_series(points(spark, {50: 1.0}), HOUR, "time", ranges=ranges)
    assert dense(out) == [None] * 4


def test_unknown_fill_is_an_error(spark):
    with pytest.raises(ValueError):
        fill_series(points(spark, {0: 1}), HOUR, "spline")
    with pytest.raises(ValueError):
        Feature("x", ("X",), fill="spline")
    with pytest.raises(ValueError):
        Grid(label="middle")


@pytest.mark.parametrize("seed", range(4))
def test_random_series_match_pandas_for_any_block(spark, seed):
    rng = random.Random(seed)
    n = 400
    present = sorted(rng.sample(range(n), 90))
    values = {h: rng.uniform(0, 100) for h in present}
    s = pd.Series(np.nan, index=pd.date_range("1970-01-01", periods=n, freq="h"))
    for h, v in values.items():
        s.iloc[h] = v
    s = s.iloc[present[0] : present[-1] + 1]
    want = {
        "time": s.interpolate(method="time").ffill().bfill(),
        "carry": s.ffill().bfill(),
        "bounded": s.interpolate(method="time", limit=3).ffill(limit=3).bfill(limit=3),
    }
    for block in (4096, 7):
        for fill, expected in want.items():
            got = dense(fill_series(points(spark, values), Grid(block=block), fill))
            np.testing.assert_allclose(
                np.array(got, dtype=float), expected.to_numpy(), rtol=1e-9, equal_nan=True
            )


def test_buckets_keep_exact_hours_and_round_the_rest_up(spark, obs, hours):
    o = obs({0.0: 1.0, 0.25: 2.0, 1.0: 3.0, 1.5: None, 1.75: 4.0, 2.0: None})
    got = {r.datetime: r.value for r in bucket_last(o).select(tick_time("tick", HOUR).alias("datetime"), "value").collect()}
    assert got == {hours(0): 1.0, hours(1): 3.0, hours(2): 4.0}


def test_bucket_start_rounds_down(spark, obs, hours):
    o = obs({0.0: 1.0, 0.25: 2.0, 1.0: 3.0})
    grid = Grid(label="start")
    got = {r.t: r.value for r in bucket_last(o, grid).select(tick_time("tick", grid).alias("t"), "value").collect()}
    assert got == {hours(0): 2.0, hours(1): 3.0}


def test_ties_take_the_larger_variable_then_id(spark, hours):
    rows = [(1, hours(1), 1, "X", 2, 5.0), (9, hours(1), 1, "X", 1, 6.0), (2, hours(1), 1, "X", 2, 7.0)]
    o = spark.createDataFrame(
        rows, "datastream_id long, datetime_utc timestamp_ntz, site_id int, variable_code string, variable_id int, value double"
    )
    assert bucket_last(o).first().value == 7.0


def test_nan_counts_as_missing(spark, obs):
    assert bucket_last(obs({0: float("nan"), 1: 2.0})).count() == 1


def test_negative_rule(spark, obs):
    o = obs({0: -1.0, 1: 0.0})
    v = blank_negative(F.col("value"), False)
    assert [r[0] for r in o.orderBy("datetime_utc").select(v).collect()] == [None, 0.0]
    assert o.where(blank_negative(F.col("value"), True).isNotNull()).count() == 2


def test_ticks_before_the_epoch(spark):
    ts = dt.datetime(1969, 12, 31, 22, 30)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    assert df.select(tick_of("t", HOUR)).first()[0] == -1
    assert df.select(next_exact("t")).first()[0] == dt.datetime(1969, 12, 31, 23)


def test_next_exact_is_strictly_later(spark, hours):
    df = spark.createDataFrame([(hours(3.75),), (hours(4),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(next_exact("t")).collect()] == [hours(4), hours(5)]


def test_gap_runs_across_blocks(spark):
    p = points(spark, {0: 1, 1: 1, 12: 1, 23: 1})
    for block in (4, 4096):
        got = sorted(r.length for r in gap_runs(p, Grid(block=block)).collect())
        assert got == [10, 10]


def test_calendar_counts_monday_as_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 12, 31),)], "t timestamp_ntz")
    rows = df.withColumns(calendar("t")).orderBy("t").collect()
    assert rows[0].day_of_week == 0 and rows[1].day_of_year == 366
    assert [r.season for r in rows] == [0, 0]


def test_horizon_bins(spark):
    df = spark.range(1, 26)
    got = [r[0] for r in df.orderBy("id").select(horizon_bin("id", strict=False)).collect()]
    assert got == ["0-6"] * 6 + ["6-12"] * 6 + ["12-18"] * 6 + ["18-24"] * 6 + ["25"]
    with pytest.raises(Exception, match="unsupported horizon"):
        df.select(horizon_bin("id")).collect()


def test_regular_table_spans_the_common_range(spark, obs, hours):
    o = (
        obs({h: float(h) for h in range(0, 60)}, 3, "Discharge")
        .unionByName(obs({h: float(h) for h in range(5, 70)}, 4, "Discharge"))
        .unionByName(obs({h: -1.0 for h in range(2, 50)}, 2, "AirTemp", 2))
        .unionByName(obs({h: 1.0 for h in range(0, 49)}, 2, "Precip", 3))
        .unionByName(obs({0: 3.0, 48: 4.0}, 1, "SnowDepth", 4))
    )
    t = regular_table(o, DISCHARGE)
    span = {r.site_id: (r.lo, r.hi) for r in t.groupBy("site_id").agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi")).collect()}
    assert span == {3: (hours(2), hours(48)), 4: (hours(5), hours(48))}
    row = t.where((F.col("site_id") == 3) & (F.col("datetime") == hours(10))).first()
    # The first snow value lies before the common range, so only the later one fills it.
    assert row.air_temp == -1.0 and row.snow_depth == 4.0 and row.snow_depth_missing_raw
    early = t.where((F.col("site_id") == 3) & (F.col("datetime") == hours(18))).first()
    assert early.precip_avg_last_24h is None
    late = t.where((F.col("site_id") == 3) & (F.col("datetime") == hours(19))).first()
    assert late.precip_avg_last_24h == 1.0


def test_a_target_without_support_needs_no_site_list(spark, obs):
    o = obs({0: 1.0, 3: 4.0}, 7).unionByName(obs({0: 1.0, 2: 3.0}, 8))
    t = regular_table(o, Target("d", (), (Feature("discharge", ("Discharge",)),)))
    assert {r.site_id: r["count"] for r in t.groupBy("site_id").count().collect()} == {7: 4, 8: 3}


def test_series_filter_reaches_the_scan(spark, obs, tmp_path):
    path = str(tmp_path / "obs")
    obs({0: 1.0, 1: 2.0}).write.parquet(path)
    df = series(spark.read.parquet(path), 1, [1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site_id,1)" in plan and df.count() == 2


def test_ranked_and_dense_ids_match_a_plain_order(spark):
    df = spark.range(0, 500).withColumn("k", F.col("id") % 3)
    got = ranked(df, ["k"], ["id"], F.call_function("div", F.col("id"), F.lit(40)))
    bad = got.where((F.col("rank") != F.call_function("div", F.col("id"), F.lit(3)) + 1))
    assert bad.count() == 0
    assert {r.rank_total for r in got.select("rank_total").distinct().collect()} == {166, 167}
    ids = [r.n for r in dense_ids(df.select("id"), ["id"], "n", 10).collect()]
    assert sorted(ids) == list(range(11, 511))


def test_buckets_hash_before_the_shuffle(spark, obs):
    """Raw rows aren't sorted to find the last one of a tick."""
    plan = bucket_last(obs({0: 1.0, 0.5: 2.0}))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_ties_in_a_bucket(spark):
    at = dt.datetime(2024, 1, 1, 0, 30)
    schema = "datastream_id long, datetime_utc timestamp_ntz, site_id int, variable_code string, variable_id int, value double"
    rows = [(5, at, 1, "X", -3, 1.0), (9, at, 1, "X", 2, 2.0), (4, at, 1, "X", 7, 3.0), (8, at, 1, "X", 7, 4.0), (None, at, 1, "X", None, 5.0)]
    for label in ("start", "end"):
        frame = spark.createDataFrame(rows, schema)
        assert [r.value for r in bucket_last(frame, Grid(label=label)).collect()] == [4.0]
    with pytest.raises(Exception, match="out of range"):
        bucket_last(spark.createDataFrame([(10**17, at, 1, "X", 1, 1.0)], schema)).collect()
