import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from rillcast.config import Clip, Grid
from rillcast.operators import live
from rillcast.sources import snapshots as snap
from rillcast.sources import tables as tb
from rillcast.streaming import live as stream

HORIZONS = 3
MODELS = [
    ("discharge", 3, "winter", "m/d3w"),
    ("air_temperature", 2, "winter", "m/a2w"),
]


@pytest.fixture()
def registry(spark):
    return spark.createDataFrame(MODELS, "target_variable string, site_id int, season string, model_path string").select(
        "*",
        F.array_repeat(F.lit(0.0), HORIZONS).alias("slopes"),
        F.array(*[F.lit(float(h)) for h in range(1, HORIZONS + 1)]).alias("intercepts"),
    )


@pytest.fixture()
def full(obs):
    """Hourly history of every series up to hour 200."""
    span = range(0, 201)
    return (
        obs({h: 10.0 + (h % 5) for h in span}, 3, "Discharge", 1, 1)
        .unionByName(obs({h: -2.0 for h in span}, 2, "AirTemp", 2, 1001))
        .unionByName(obs({h: 0.5 for h in span}, 2, "Precip", 3, 2001))
        .unionByName(obs({h: 3.0 for h in range(0, 150)}, 1, "SnowDepth", 4, 3001))
    )


def gate_of(df, facts, registry):
    return {r.datastream_id: r.reason for r in live.gate(df, facts, registry).collect()}


def test_every_reason(spark, obs, full, registry, hours):
    extra = (
        obs({200.25: 1.0}, 3, "Discharge", 1, 5000)
        .unionByName(obs({201: 1.0}, 2, "Precip", 3, 5001))
        .unionByName(obs({150: 1.0}, 2, "AirTemp", 2, 5002))
        .unionByName(obs({300: 1.0}, 9, "Discharge", 1, 5003))
        .unionByName(obs({210: None}, 3, "Discharge", 1, 5004))
        .unionByName(obs({202: 1.0}, 2, "AirTemp", 2, 5005))
    )
    facts = full.unionByName(extra)
    assert gate_of(extra, facts, registry) == {
        5000: "not_exact_hour",
        5001: "no_target",
        5002: "not_newer",
        5003: "no_model",
        5004: "accepted",  # a row without a value still fires
        5005: "accepted",
    }


def test_equal_times_fail_for_both(spark, obs, full, registry):
    twins = obs({210: 1.0}, 3, "Discharge", 1, 5000).unionByName(obs({210: 2.0}, 3, "Discharge", 1, 5001))
    assert set(gate_of(twins, full.unionByName(twins), registry).values()) == {"not_newer"}


def test_a_lone_row_of_a_series_is_accepted(spark, obs, registry):
    one = obs({5: 1.0}, 3, "Discharge", 1, 1)
    assert gate_of(one, one, registry) == {1: "accepted"}


def accepted(spark, obs_rows, registry, site=3):
    e = live.with_target(live.forecast_season(obs_rows.select(*live.EVENT_COLUMNS)))
    return live.route(e, registry)


def test_features_and_forecast(spark, obs, full, registry, hours):
    event = full.where((F.col("site_id") == 3) & (F.col("datetime_utc") == F.lit(hours(200))))
    f = live.event_features(accepted(spark, event, registry), full, 168).first()
    assert f.failure is None and len(f.lags) == 168 and f.lags[-1] == 10.0
    assert f.snow_depth_latest == 3.0 and f.air_temp_avg_last_24h == -2.0 and f.precip_avg_last_24h == 0.5
    feats = live.event_features(accepted(spark, event, registry), full, 168)
    rows = live.forecast_rows(
        feats, registry, HORIZONS, Clip(multiplier=0.0, floor=0.0), json_columns=["site_id", "history_end_time", "lags"]
    ).orderBy("horizon").collect()
    # Deltas 1, 2, 3 on base 10, each step limited to five percent of the one before.
    assert [round(r.prediction, 6) for r in rows] == [10.5, 11.025, 11.57625]
    assert rows[0].target_timestamp == hours(201) and rows[0].horizon_bin == "0-6"
    doc = json.loads(rows[0].feature_row_json)
    assert doc["history_end_time"] == "2024-01-09 08:00:00" and len(doc["lags"]) == 168


def test_events_of_one_series_and_hour_ask_for_one_window(spark, obs, full, registry, hours):
    event = full.where((F.col("site_id") == 3) & (F.col("datetime_utc") == F.lit(hours(200))))
    air = full.where((F.col("variable_code") == "AirTemp") & (F.col("datetime_utc") == F.lit(hours(200))))
    ids = F.explode(F.sequence(F.lit(9000).cast("long"), F.lit(9039).cast("long")))
    many = event.withColumn("datastream_id", ids)
    events = accepted(spark, many.unionByName(air), registry).where("model_path IS NOT NULL")
    assert live.requests(events, 168).count() == 2 + 3
    rows = {r.datastream_id: r for r in live.event_features(events, full, 168).collect()}
    alone = live.event_features(accepted(spark, event, registry), full, 168).first()
    assert set(rows) == {*range(9000, 9040), air.first().datastream_id}
    assert all(rows[i].asDict() | {"datastream_id": 0} == alone.asDict() | {"datastream_id": 0} for i in range(9000, 9040))
    assert rows[air.first().datastream_id].lags == [-2.0] * 168


def test_an_id_given_twice_keeps_its_windows_apart(spark, obs, full, registry, hours):
    event = full.where((F.col("site_id") == 3) & F.col("datetime_utc").isin(hours(190), hours(200)))
    rows = live.event_features(accepted(spark, event.withColumn("datastream_id", F.lit(7).cast("long")), registry), full, 168).collect()
    assert {(r.datetime_utc, len(r.lags), r.failure) for r in rows} == {(hours(190), 168, None), (hours(200), 168, None)}


@pytest.mark.parametrize(
    "gone,failure",
    [
        ((3, 100, 109), "long_gap"),
        ((3, 100, 108), None),
        ((3, 0, 300), "no_history"),
        ((1, 0, 300), "no_snow_depth_latest"),
        ((2, 0, 300), "no_air_temp_avg_last_24h"),
    ],
)
def test_failures(spark, obs, full, registry, hours, gone, failure):
    site, lo, hi = gone
    event = full.where((F.col("site_id") == 3) & (F.col("datetime_utc") == F.lit(hours(200))))
    hidden = (F.col("site_id") == site) & F.col("datetime_utc").between(F.lit(hours(lo)), F.lit(hours(hi)))
    f = live.event_features(accepted(spark, event, registry), full.where(~hidden), 168).first()
    assert f.failure == failure


def test_rain_needs_eighteen_hours(spark, obs, full, registry, hours):
    event = full.where((F.col("site_id") == 3) & (F.col("datetime_utc") == F.lit(hours(200))))
    # From hour 177 to 200: a gap of 14 keeps 6 + 3 filled, 10 seen: 19 values; one of 16 keeps 17.
    for first, ok in ((180, True), (178, False)):
        hidden = (F.col("variable_code") == "Precip") & F.col("datetime_utc").between(
            F.lit(hours(first)), F.lit(hours(193))
        )
        f = live.event_features(accepted(spark, event, registry), full.where(~hidden), 168).first()
        assert (f.precip_avg_last_24h is not None) == ok


def test_live_fill_sees_only_its_own_window(spark, obs, full, registry, hours):
    # Hours 33-36 open the window of hour 200; the value at hour 32 must not be used.
    event = full.where((F.col("site_id") == 3) & (F.col("datetime_utc") == F.lit(hours(200))))
    hidden = (F.col("site_id") == 3) & F.col("datetime_utc").between(F.lit(hours(33)), F.lit(hours(36)))
    f = live.event_features(accepted(spark, event, registry), full.where(~hidden), 168).first()
    assert f.lags[:4] == [10.0 + 37 % 5] * 4


def test_payload_round_trip(spark, obs):
    e = obs({1: 2.5, 1.25: 3.0, 2: None}).select(*live.EVENT_COLUMNS)
    back = live.from_payload(live.to_payload(e))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, e.where("datastream_id <> 2").collect()))


def predictions(spark, rows):
    return spark.createDataFrame(
        [("season_specific", "discharge", 3, dt.datetime(2024, 1, 1), "winter", h, v, i) for h, v, i in rows],
        "model_family string, target_variable string, site_id int, history_end_time timestamp_ntz, "
        "season_key string, horizon int, prediction double, source_datastream_id long",
    )


def test_upsert_is_idempotent_and_last_write_wins(spark):
    old = predictions(spark, [(1, 1.0, 9), (2, 2.0, 9)])
    new = predictions(spark, [(2, 5.0, 3), (3, 6.0, 3)])
    once = live.upsert(old, new)
    twice = live.upsert(once, new)
    want = [(1, 1.0), (2, 5.0), (3, 6.0)]
    for df in (once, twice):
        assert sorted((r.horizon, r.prediction) for r in df.collect()) == want


def test_stored_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "p")
    tb.append_batch(predictions(spark, [(1, 1.0, 1), (2, 2.0, 1)]), path, 0)
    tb.append_batch(predictions(spark, [(1, 7.0, 2)]), path, 1)
    tb.append_batch(predictions(spark, [(1, 8.0, 2)]), path, 1)
    got = sorted((r.horizon, r.prediction) for r in tb.current_predictions(spark, path).collect())
    assert got == [(1, 8.0), (2, 2.0)]


def test_completeness_names_missing_ids(spark):
    ids = spark.createDataFrame([(1,), (2,)], "source_datastream_id long")
    rows = predictions(spark, [(h, 0.0, 1) for h in range(1, 25)])
    got = {r.source_datastream_id: (r.n, r.incomplete) for r in live.completeness(ids, rows).collect()}
    assert got == {1: (24, False), 2: (0, True)}


def test_csv_copy_has_the_fixed_columns(spark, tmp_path, full, registry, hours):
    event = full.where((F.col("site_id") == 2) & (F.col("variable_code") == "AirTemp") & (F.col("datetime_utc") == F.lit(hours(200))))
    feats = live.event_features(accepted(spark, event, registry), full, 168)
    rows = live.forecast_rows(feats, registry, HORIZONS)
    tb.append_predictions_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert back.columns == list(live.CSV_COLUMNS) and back.count() == HORIZONS


def test_new_events_and_replay(spark, full):
    variables = full.select("variable_id", "variable_code").distinct()
    facts = full.drop("variable_code")
    got = live.new_events(facts, variables, 190, 20).collect()
    assert [r.datastream_id for r in got] == [*range(191, 202), *range(1001, 1010)]
    assert live.events_by_id(facts, variables, [5, 1005]).count() == 2


def test_stream_matches_arrival_order(spark, obs, registry, tmp_path, full, hours):
    base = str(tmp_path / uuid.uuid4().hex)
    late = obs({150: 1.0}, 3, "Discharge", 1, 5000).unionByName(obs({201: 11.0}, 3, "Discharge", 1, 5001)).unionByName(
        obs({201: 12.0}, 3, "Discharge", 1, 5002)
    ).unionByName(obs({201.5: 12.0}, 3, "Discharge", 1, 5003)).unionByName(obs({201: -4.0}, 2, "AirTemp", 2, 5004))
    columns = list(live.EVENT_COLUMNS)
    full.select(*columns).coalesce(1).write.parquet(f"{base}/events")
    arriving = stream.read_events(spark, f"{base}/events", 1)
    handler = stream.Forecaster(f"{base}/events", registry, f"{base}/out", horizons=HORIZONS, csv=f"{base}/csv")

    def run():
        stream.start(arriving, handler, f"{base}/checkpoint", once=True).awaitTermination()

    run()
    first = snap.stored_predictions(spark, f"{base}/out/predictions").select("source_datastream_id").distinct().collect()
    # In the first file hours 0-200 arrive in order: all with enough history are forecast.
    assert {r[0] for r in first} >= {201, 1201}
    late.select(*columns).coalesce(1).write.mode("append").parquet(f"{base}/events")
    run()
    reasons = {
        r.datastream_id: r.reason
        for r in spark.read.parquet(f"{base}/out/judged").where("datastream_id >= 5000").collect()
    }
    assert reasons == {5000: "not_newer", 5001: "accepted", 5002: "not_newer", 5003: "not_exact_hour", 5004: "accepted"}
    rows = snap.stored_predictions(spark, f"{base}/out/predictions").where("source_datastream_id >= 5000")
    assert {r["source_datastream_id"]: r["count"] for r in rows.groupBy("source_datastream_id").count().collect()} == {
        5001: HORIZONS, 5004: HORIZONS,
    }
    rejects = spark.read.parquet(f"{base}/out/rejects").where("datastream_id = 5003").collect()
    assert [r.reason for r in rejects] == ["not_exact_hour"]
    run()  # nothing new: nothing changes
    assert snap.stored_predictions(spark, f"{base}/out/predictions").where("source_datastream_id >= 5000").count() == 2 * HORIZONS


def judged(spark, guard, rows, batch_id):
    """datastream_id to verdict of one batch of (id, time, site)."""
    full = [(i, s, 1, "X", t, 0.0) for i, t, s in rows]
    known = guard.before(spark, batch_id)
    found = guard.judge(spark.createDataFrame(full, stream.EVENT_SCHEMA), known)
    got = [(r.datastream_id, r.is_newest) for r in found.collect()]
    guard.advance(found, known, batch_id)
    return sorted(got)


def plain_verdicts(rows, latest):
    """The same, one row after another."""
    out = []
    for i, t, s in sorted(rows, key=lambda r: (r[0], r[1] or dt.datetime.min)):
        out.append((i, t is not None and (latest.get(s) is None or t > latest[s])))
        if t is not None and (latest.get(s) is None or t > latest[s]):
            latest[s] = t
    return sorted(out)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_guard_judges_in_order_of_arrival(spark, tmp_path, block):
    rng = random.Random(block)
    guard = stream.NewestGuard(str(tmp_path / "latest"), block=block)
    latest, first = {}, 0
    for batch_id in range(4):
        # One hot series, one without a site, late rows and rows without a time.
        rows = [
            (first + k, None if rng.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=first + k - rng.choice([0, 0, 0, 3, 40])), rng.choice([1, 1, 1, 1, 2, None]))
            for k in range(60)
        ]
        assert judged(spark, guard, rows, batch_id) == plain_verdicts(rows, dict(latest))
        # A replay is judged as the first time.
        assert judged(spark, guard, rows, batch_id) == plain_verdicts(rows, latest)
        first += 60
    assert tb.batches(spark, str(tmp_path / "latest")) == [2, 3]


def test_guard_starts_from_history_and_rejects_missing_times(spark, tmp_path):
    t, hour = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    history = spark.createDataFrame([(1, 1, t + 2 * hour), (1, 1, None), (2, 1, None)], "site_id int, variable_id int, datetime_utc timestamp_ntz")
    guard = stream.NewestGuard(str(tmp_path / "latest"), history)
    rows = [(1, t + hour, 1), (2, None, 1), (3, t + 3 * hour, 1), (4, None, 1), (5, t, 2)]
    want = [(1, False), (2, False), (3, True), (4, False), (5, True)]
    assert judged(spark, guard, rows, 0) == want
    # Started anew with a history that has grown: the batch is judged as before.
    grown = spark.createDataFrame([(1, 1, t + 9 * hour)], "site_id int, variable_id int, datetime_utc timestamp_ntz")
    assert judged(spark, stream.NewestGuard(str(tmp_path / "latest"), grown), rows, 0) == want


def test_scan_of_a_batch_reaches_over_the_longest_window(spark, obs):
    table = obs({h: 1.0 for h in range(400)}, 1, "SnowDepth", 3, 1)
    event = obs({399: 1.0}, 3, "Discharge", 1, 9000).withColumn("target_variable", F.lit("discharge"))
    near = stream.observations_near(table, event, 24, Grid())
    assert near.count() == 168
    assert stream.observations_near(table, event.limit(0), 24, Grid()) is None


def test_a_late_series_leaves_the_history_of_others_unread(spark, obs, tmp_path):
    path = str(tmp_path / "observations")
    hours = [*range(200), *range(9000, 9200)]
    table = obs({h: float(h) for h in hours}, 3, "Discharge", 1, 1).unionByName(obs({h: 1.0 for h in hours}, 4, "Discharge", 1, 20000))
    stream.write_observations(table, path)
    events = obs({199: 0.0}, 3, "Discharge", 1, 90000).unionByName(obs({9199: 0.0}, 4, "Discharge", 1, 90001))
    events = events.withColumn("target_variable", F.lit("discharge"))
    stored = spark.read.parquet(path)
    near = stream.observations_near(stored, events, 24, Grid(), {})
    got = {(r.site_id, r.span) for r in near.select("site_id", "span").distinct().collect()}
    spans = lambda site: sorted({r.span for r in stored.where(F.col("site_id") == site).collect()})
    assert len(spans(3)) >= 2 and got == {(3, spans(3)[0]), (4, spans(4)[-1])}
    # Files of the other spans could not be read at all.
    for site, span in ((3, spans(3)[-1]), (4, spans(4)[0])):
        for file in (tmp_path / "observations").glob(f"batch_id=*/bucket=*/span={span}/*.parquet"):
            if site == spark.read.parquet(f"file://{file}").first().site_id:
                file.write_bytes(b"not a table")
    near = stream.observations_near(spark.read.schema(stored.schema).parquet(path), events, 24, Grid(), {})
    assert near.where("datetime_utc IS NOT NULL").count() == 400
    many = stream.observations_near(stored, events.limit(0), 24, Grid())
    assert many is None


PREDICTIONS = (
    "source_datastream_id long, model_family string, target_variable string, site_id int, season_key string, "
    "history_end_time timestamp_ntz, horizon int, prediction double"
)


def some_predictions():
    day = dt.datetime(2024, 5, 1)
    return [(i, "f", "discharge", 3, "spring", day + dt.timedelta(days=i % 3), 1 + i // 3, float(i)) for i in range(12)]


def test_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "predictions")
    assert snap.upsert_predictions(spark.createDataFrame(some_predictions(), PREDICTIONS), path) == 0
    before = {r.day.day: r.write for r in snap.snapshot_days(spark, path, 0).collect()}
    day = dt.datetime(2024, 5, 2)
    changed = [(99, "f", "discharge", 3, "spring", day, 2, -1.0), (98, "f", "discharge", 3, "spring", day, 2, -2.0)]
    assert snap.upsert_predictions(spark.createDataFrame(changed, PREDICTIONS), path) == 1
    after = {r.day.day: r.write for r in snap.snapshot_days(spark, path, 1).collect()}
    assert after[1] == before[1] and after[3] == before[3] and after[2] != before[2]
    now = {(r.history_end_time.day, r.horizon): r.prediction for r in snap.stored_predictions(spark, path).collect()}
    assert len(now) == 12 and now[2, 2] == -1.0
    # The snapshot before is still whole, a replay changes nothing, one day is read alone.
    assert {r.prediction for r in snap.stored_predictions(spark, path, snapshot=0).collect()} == {float(i) for i in range(12)}
    assert snap.upsert_predictions(spark.createDataFrame(some_predictions(), PREDICTIONS), path, 1) == 1
    assert snap.stored_predictions(spark, path).where("prediction < 0").count() == 1
    assert {r.history_end_time.day for r in snap.stored_predictions(spark, path, day.date(), day.date()).collect()} == {2}
    assert len(snap.drop_unused(spark, path, keep=1)) == 0 and snap.snapshots(spark, path) == [1]
    snap.upsert_predictions(spark.createDataFrame(some_predictions(), PREDICTIONS), path)
    assert len(snap.drop_unused(spark, path, keep=1)) == 2 and snap.stored_predictions(spark, path).count() == 12
    assert snap.stored_predictions(spark, path, dt.date(2030, 1, 1)).columns == snap.stored_predictions(spark, path).columns
    assert snap.stored_predictions(spark, path, dt.date(2030, 1, 1)).count() == 0
    with pytest.raises(FileNotFoundError):
        snap.stored_predictions(spark, path, snapshot=0)
    with pytest.raises(FileNotFoundError):
        snap.stored_predictions(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("at", ["data", "commit"])
def test_a_killed_write_leaves_the_old_snapshot(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "predictions")
    rows = some_predictions()
    snap.upsert_predictions(spark.createDataFrame(rows, PREDICTIONS), path, 0)
    raised = [(*r[:-1], r[-1] + 100) for r in rows]
    if at == "commit":
        def killed(*_):
            raise KeyboardInterrupt

        monkeypatch.setattr(snap, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            snap.upsert_predictions(spark.createDataFrame(raised, PREDICTIONS), path, 1)
    else:
        # Half of the days' files are there, no snapshot names them.
        some = spark.createDataFrame(raised[:5], PREDICTIONS).withColumn("day", F.to_date("history_end_time"))
        some.write.partitionBy("day").parquet(f"{path}/data/write=halfway")
    assert sorted(r.prediction for r in snap.stored_predictions(spark, path).collect()) == [float(i) for i in range(12)]
    monkeypatch.undo()
    snap.upsert_predictions(spark.createDataFrame(raised, PREDICTIONS), path, 1)
    assert sorted(r.prediction for r in snap.stored_predictions(spark, path).collect()) == [float(i) + 100 for i in range(12)]
    assert len(snap.drop_unused(spark, path)) == 1
