import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rillcast.config import Clip, Grid
from rillcast.functions.vectors import clipped, finite, largest_step, newest, persistence
from rillcast.operators import evaluate as ev
from rillcast.operators import models, prep


@pytest.fixture()
def samples(spark, hours):
    def build(rows):
        """rows: (site, start offset, lags, targets)"""
        data = [
            (s, hours(h - 1), hours(h), hours(h + len(t) - 1), lags, t)
            for s, h, lags, t in rows
        ]
        return spark.createDataFrame(
            data,
            "site_id int, history_end_time timestamp_ntz, forecast_start_time timestamp_ntz, "
            "forecast_end_time timestamp_ntz, lags array<double>, targets array<double>",
        )

    return build


def test_missing_version_wins_then_file_time_then_path(spark, hours):
    rows = [
        (1, hours(0), 2.0, 5.0, "a", "old"),
        (1, hours(0), None, 1.0, "a", "null version"),
        (2, hours(0), 1.0, 5.0, "a", "x"),
        (2, hours(0), 1.0, 6.0, "a", "newer file"),
        (3, hours(0), 1.0, 5.0, "a", "x"),
        (3, hours(0), 1.0, 5.0, "b", "later path"),
    ]
    df = spark.createDataFrame(
        rows, "site_id int, forecast_start_time timestamp_ntz, version double, source_mtime double, source_path string, tag string"
    )
    got = {r.site_id: r.tag for r in prep.newest_wins(df).collect()}
    assert got == {1: "null version", 2: "newer file", 3: "later path"}


def test_only_the_first_version_column_with_values_ranks(spark, hours):
    df = spark.createDataFrame(
        [(1, hours(0), None, 1.0, 9.0), (1, hours(0), None, 2.0, 1.0)],
        "site_id int, forecast_start_time timestamp_ntz, source_version double, dataset_version double, version double",
    )
    assert prep.ranking_columns(df) == ["dataset_version"]
    assert prep.newest_wins(df).first().dataset_version == 2.0


def test_without_ranking_columns_copies_stay(spark, hours):
    df = spark.createDataFrame([(1, hours(0)), (1, hours(0))], "site_id int, forecast_start_time timestamp_ntz")
    assert prep.newest_wins(df).count() == 2


def test_bad_times_are_counted(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "x", "2024-01-01"), (None, "2024-01-01 01:00:00", "2024-01-01")],
        "history_end_time string, forecast_start_time string, forecast_end_time string",
    )
    with pytest.raises(ValueError, match="'history_end_time': 1, 'forecast_start_time': 1"):
        prep.parse_times(df)
    with pytest.raises(ValueError, match="missing time columns"):
        prep.parse_times(df.drop("forecast_end_time"))


def test_season_name_falls_back_for_all_rows(spark, hours):
    df = spark.createDataFrame([(2, hours(0)), (1, hours(0))], "season int, forecast_start_time timestamp_ntz")
    assert {r.season_name for r in prep.with_season_name(df).collect()} == {"summer", "spring"}
    odd = df.withColumn("season", F.when(F.col("season") == 2, 9).otherwise(F.col("season")))
    assert {r.season_name for r in prep.with_season_name(odd).collect()} == {"winter"}


def test_split_clamps_the_leap_day_and_drops_straddlers(spark):
    def row(end):
        return (1, end - dt.timedelta(hours=1), end)

    ends = [dt.datetime(2024, 2, 29), dt.datetime(2023, 2, 28), dt.datetime(2023, 2, 28, 1), dt.datetime(2023, 2, 28, 2)]
    df = spark.createDataFrame(
        [row(e) for e in ends], "site_id int, forecast_start_time timestamp_ntz, forecast_end_time timestamp_ntz"
    )
    out = prep.trailing_year_split(df).orderBy("forecast_end_time").collect()
    assert out[0].validation_start == dt.datetime(2023, 2, 28, 1)
    # The sample ending exactly at the border starts before it: in neither part.
    assert [(r.forecast_end_time.hour, r.part) for r in out] == [(0, "train"), (2, "validation"), (0, "validation")]


def test_straddlers_are_horizons_minus_one(spark, samples):
    rows = [(1, h, [0.0], [0.0] * 24) for h in range(0, 366 * 24 + 500)]
    s = samples(rows)
    assert s.count() - prep.trailing_year_split(s).count() == 23


def test_an_empty_part_is_an_error(spark, samples):
    split = prep.trailing_year_split(samples([(1, 0, [0.0], [0.0])]))
    with pytest.raises(ValueError, match="empty train or validation"):
        prep.require_both_parts(split)


@pytest.mark.parametrize("seed", range(3))
def test_exact_medians(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([rng.gauss(0, 1e6), 1.0, None, float(rng.randint(0, 3))])) for k in (1, 2) for _ in range(301 + seed)]
    rows += [(3, 7.0)] * 10
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.median for r in prep.exact_medians(df, ["k"], ["v"], accuracy=100, bins=16).collect()}
    for k in (1, 2, 3):
        assert got[k] == pytest.approx(statistics.median(v for i, v in rows if i == k and v is not None))


def test_imputation_uses_training_rows_only_and_zero_without_any(spark):
    df = spark.createDataFrame(
        [(1, "train", "2"), (1, "train", "4"), (1, "validation", "100"), (1, "validation", "x"), (2, "train", None)],
        "site_id int, part string, depth string",
    )
    got = prep.impute_static(df, ["depth"]).orderBy("site_id", "part", "depth").collect()
    assert [r.depth for r in got] == [2.0, 4.0, 3.0, 100.0, 0.0]


def test_scaling_with_constant_columns(spark, samples):
    s = samples([(1, 0, [5.0, 5.0], [5.0]), (1, 1, [5.0, 5.0], [7.0])]).withColumn("depth", F.lit(3.0))
    scalers = prep.fit_scalers(s, ["depth"])
    got = {r.block: (r["mean"], r.deviation) for r in scalers.collect()}
    assert got == {"lag": (5.0, 0.0), "delta": (1.0, 1.0), "depth": (3.0, 0.0)}
    out = prep.scale(s.drop("depth"), scalers, ["depth"]).orderBy("forecast_start_time").collect()
    assert out[0].scaled_lags == [0.0, 0.0] and out[0].scaled_deltas == [-1.0]
    assert out[0].scaled_statics == [-3.0]  # unknown column: 0 before scaling, scale 1


def test_finite(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(finite(F.col("x"))).collect()] == [0.0, 0.0, 0.0, 0.0, 2.0]


def test_clip_follows_the_clipped_value(spark, samples):
    s = samples([(1, 0, [99.0, 100.0], [200.0, 200.0, 0.0])])
    out = s.select(clipped(F.col("targets"), newest(), largest_step(), Clip())).first()[0]
    assert out == pytest.approx([105.0, 110.25, 104.7375])
    off = s.select(clipped(F.col("targets"), newest(), largest_step(), Clip(enabled=False))).first()[0]
    assert off == [200.0, 200.0, 0.0]


def test_largest_step_with_a_missing_lag(spark, samples):
    s = samples([(1, 0, [1.0, None, 4.0, 9.0], [0.0])])
    assert s.select(largest_step()).first()[0] == 0.0
    assert s.select(largest_step(strict=False)).first()[0] == 5.0


def test_time_features_cover_every_lag(spark, samples):
    s = prep.with_time_features(samples([(1, 0, [0.0] * 3, [0.0])]), 3, season_flags=False)
    steps = s.first().time_steps
    assert len(steps) == 3 and all(len(x) == 7 for x in steps)
    # 23:00 on 31 December 2023, a Sunday, is the newest step.
    assert steps[-1][6] == pytest.approx(365 / 366)


def test_linear_fit_recovers_a_line_and_handles_a_constant(spark, samples):
    rows = [(1, h, [0.0, float(h)], [float(h) + 2.0 + 0.5 * (h / 2)]) for h in range(10)]
    rows += [(2, h, [1.0, 1.0], [1.0 + h]) for h in range(3)]
    s = samples(rows).withColumn("season_name", F.lit("winter"))
    got = {r.site_id: (r.slope, r.intercept) for r in models.fit_linear(s).collect()}
    assert got[1] == pytest.approx((0.5, 2.0)) and got[2] == pytest.approx((0.0, 1.0))


def _long(spark, hours, rows):
    return spark.createDataFrame(
        [(s, hours(h), k, y, p, p, b) for s, h, k, y, p, b in rows],
        "site_id int, forecast_start_time timestamp_ntz, horizon int, y_true double, y_pred double, "
        "y_pred_unclipped double, y_persistence double",
    )


def test_metrics_and_skill(spark, hours):
    long = _long(spark, hours, [(1, 0, 1, 1.0, 2.0, 3.0), (1, 0, 2, 1.0, 1.0, 1.0), (2, 0, 1, 1.0, 5.0, 1.0)])
    m = {r.site_id: r for r in ev.metrics(long, ("site_id",)).collect()}
    assert m[1].rmse == pytest.approx(0.5**0.5) and m[1].mae == 0.5
    assert m[1].rmse_skill_vs_persistence == pytest.approx(0.5)
    assert m[2].rmse_skill_vs_persistence is None and m[2].mae_skill_vs_persistence is None


def test_season_by_target_time_or_by_start(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 2, 29, 23), "winter", [1.0, 1.0], [1.0, 1.0], [1.0, 1.0], [1.0, 1.0])],
        "site_id int, forecast_start_time timestamp_ntz, season_name string, y_true array<double>, "
        "y_pred array<double>, y_pred_unclipped array<double>, y_persistence array<double>",
    )
    by_target = [r.season for r in ev.expand(df).orderBy("horizon").collect()]
    by_start = ev.expand(df, season_by="start")
    assert by_target == ["winter", "spring"]
    assert [r.season for r in by_start.collect()] == ["winter", "winter"]
    assert [r.season for r in ev.by_target_season(by_start).orderBy("horizon").collect()] == by_target


def test_pivot_keeps_empty_bins_and_order(spark):
    df = spark.createDataFrame([(1, "fall", "6-12", 2.0)], "site_id int, season string, horizon_bin string, rmse double")
    out = ev.pivot_bins(df, "rmse")
    assert out.columns == ["site_id", "horizon_bin", "winter", "spring", "summer", "fall"]
    rows = {r.horizon_bin: r.fall for r in out.collect()}
    assert rows == {"0-6": None, "6-12": 2.0, "12-18": None, "18-24": None}


def test_persistence_repeats_the_newest_lag(spark, samples):
    s = samples([(1, 0, [1.0, 2.0], [0.0, 0.0, 0.0])])
    assert s.select(persistence(3)).first()[0] == [2.0, 2.0, 2.0]


def test_grid_days_shift_target_times(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 2, 28), [1.0] * 3, [1.0] * 3, [1.0] * 3, [1.0] * 3)],
        "site_id int, forecast_start_time timestamp_ntz, y_true array<double>, y_pred array<double>, "
        "y_pred_unclipped array<double>, y_persistence array<double>",
    )
    got = [r.target_timestamp.day for r in ev.expand(df, Grid(step=86400)).orderBy("horizon").collect()]
    assert got == [28, 29, 1]
