import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rillcast.config import Feature, Grid, SampleSpec, Target
from rillcast.operators import normalize as nz
from rillcast.operators import profile as pf
from rillcast.plans.training import training_samples
from rillcast.sources import sensor_csv as sc
from rillcast.sources import tables as tb
from rillcast.sources.staged import job, stage

CSV = """# Export of one sensor
# Workspace:
# Name: North network
# Owner: N/A
# Site Information:
# SamplingFeatureCode: LR_1
# Name: River: upper
# Description: None
# Mystery:
# SiteType: Stream
# Location Information:
# Latitude: 41.7
# Longitude: west
# Datastream Information:
# NoDataValue: -9999
# Observed Property Information:
# VariableCode: Discharge
# Name: Flow
# Method Information:
# Name: Probe
# Unit Information:
# Name: cubic feet per second
# Colour: blue
ResultTime,Result,ResultQualifiers
2024-01-01 00:00:00,12.5,
2024-01-01T00:15:00,,PF
not-a-time,3.0,

 ,4.0,
2024-01-01 00:30:00,abc,"A,B"
2024-01-01 00:45:00,-9999, X
# County: late header
2024-01-01T01:00:00Z,1e1,
"""


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "b.csv").write_text(CSV)
    swapped = CSV.replace("ResultTime,Result,ResultQualifiers", "Result,ResultTime").split("\nResult,")[0]
    (tmp_path / "a.csv").write_text(
        swapped.replace("LR_1", "LR_2") + "\nResult,ResultTime\n5.5,2024-02-01 00:00:00\n"
    )
    return str(tmp_path)


def test_metadata_of_a_file(spark, folder):
    rows = {r.file.rsplit("/", 1)[1]: r for r in sc.metadata(sc.header_entries(sc.lines(spark, folder))).collect()}
    r = rows["b.csv"]
    assert r.workspace_name == "North network" and r.owner_name is None
    assert r.site_code == "LR_1" and r.site_name == "River: upper" and r.site_description is None
    # "Mystery" is no known section: the site section goes on.
    assert r.site_type == "Stream"
    assert r.latitude == 41.7 and r.longitude is None and r.no_data_value == -9999.0
    assert r.variable_name == "Flow" and r.method_name == "Probe" and r.unit_name == "cubic feet per second"
    # A comment after the data still belongs to the header, in the last section named before it.
    assert r.county is None


def test_observations_of_all_files(spark, folder):
    staged = sc.staging_rows(spark, folder)
    rows = staged.where("source_file = 'b.csv'").orderBy("datetime_utc").collect()
    t = dt.datetime(2024, 1, 1)
    assert [(r.datetime_utc, r.value, r.qualifier_code) for r in rows] == [
        (t, 12.5, None),
        (t + dt.timedelta(minutes=15), None, "PF"),
        (t + dt.timedelta(minutes=30), None, "A,B"),
        (t + dt.timedelta(minutes=45), -9999.0, "X"),
        (t + dt.timedelta(minutes=60), 10.0, None),
    ]
    other = staged.where("source_file = 'a.csv'").collect()
    assert [(r.value, r.datetime_utc, r.qualifier_code, r.site_code) for r in other] == [
        (5.5, dt.datetime(2024, 2, 1), None, "LR_2")
    ]
    counts = [(r.source_file, r.row_count) for r in sc.rows_per_file(staged).collect()]
    assert counts == [("a.csv", 1), ("b.csv", 5), (None, 6)]


def test_no_data_value_is_applied_on_request(spark, folder):
    staged = sc.staging_rows(spark, folder, apply_no_data=True)
    assert staged.where("value = -9999").count() == 0 and staged.where("source_file = 'b.csv'").count() == 5


def test_header_order_survives_split_files(spark, tmp_path):
    big = CSV + "\n".join(f"2025-01-01 00:00:00,{i}," for i in range(20000)) + "\n# Unit Information:\n# Name: late unit\n"
    (tmp_path / "big.csv").write_text(big)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        text = sc.lines(spark, str(tmp_path))
        assert text.rdd.getNumPartitions() > 1
        row = sc.staging_rows(spark, str(tmp_path)).select("unit_name").distinct().collect()
        assert [r.unit_name for r in row] == ["late unit"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_numbers_and_times(spark):
    df = spark.createDataFrame(
        [("1.5", "2024-01-01"), ("nan", "2024"), ("3d", "2024-01-01 1:00:00"), ("0x10", "2024-13-01 00:00:00"), (" -2e3 ", "2024-01-01T02:00:00+02:00")],
        "n string, t string",
    )
    rows = df.select(sc.number(F.col("n")).alias("n"), sc.timestamp(F.col("t")).alias("t")).collect()
    assert rows[0].n == 1.5 and str(rows[1].n) == "nan" and rows[2].n is None and rows[3].n is None and rows[4].n == -2000.0
    assert [r.t for r in rows] == [dt.datetime(2024, 1, 1), None, None, None, dt.datetime(2024, 1, 1)]


def test_from_files_to_a_star_schema(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("st") / "staging")
    tb.append_staging(sc.staging_rows(spark, folder).withColumn("staging_id", F.monotonically_increasing_id()), path)
    staging = spark.read.parquet(path)
    assert "loaded_at" in staging.columns
    t = nz.normalize(staging)
    counts = {r.table_name: r.row_count for r in nz.table_counts(t).collect()}
    assert counts == {
        "owner": 0, "site": 2, "unit": 1, "method": 1, "processing_level": 0, "qualifier": 3, "variable": 1, "datastream": 6,
    }
    facts = t["datastream"]
    assert facts.where("owner_id IS NOT NULL").count() == 0
    assert pf.orphans(facts, "site_id", t["site"], "site_id").count() == 0
    assert pf.duplicate_keys(facts, ["datastream_id"]).count() == 0
    with pytest.raises(ValueError, match="no variable matches"):
        pf.require_variables(t["variable"], ["snow"])
    assert pf.require_variables(t["variable"], ["DISCH"]).count() == 1
    tb.write_facts(facts, path + "-facts")
    back = tb.scan(spark, path + "-facts", ["datastream_id", "site_id"], "site_id = 1")
    assert back.count() == facts.where("site_id = 1").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(site_id" in plan


def _samples(spark, obs):
    target = Target("discharge", (1, 2), (Feature("discharge", ("Discharge",)),))
    o = obs({h: float(h) for h in range(60)}, 1).unionByName(obs({h: 1.0 for h in range(50)}, 2))
    return target, training_samples(o, target, Grid(), SampleSpec(lags=24, horizons=3, stride=1))


def test_training_files_round_trip(spark, obs, tmp_path):
    target, samples = _samples(spark, obs)
    path = str(tmp_path / "training")
    tb.write_training(samples, target, path, 24, 3)
    loaded = tb.load_training(spark, path)
    audit = {r.site_id: (r.row_count, r.column_count) for r in tb.audit(loaded).collect()}
    assert audit == {1: (34, 39), 2: (24, 39)}
    assert loaded.where("source_mtime > 1.6e9 and source_path like '%parquet'").count() == 58
    again = tb.load_samples(spark, path, "discharge", 24, 3)
    key = lambda df: sorted((r.site_id, r.forecast_start_time, r.lags, r.targets) for r in df.collect())
    assert key(again) == key(samples)


def test_empty_training_set_and_missing_files_fail(spark, obs, tmp_path):
    target, samples = _samples(spark, obs)
    kept = str(tmp_path / "none")
    tb.write_training(samples, target, kept, 24, 3)
    n = spark.read.parquet(kept).count()
    with pytest.raises(ValueError, match="no discharge samples"):
        tb.write_training(samples.limit(0), target, kept, 24, 3)
    assert spark.read.parquet(kept).count() == n > 0
    with pytest.raises(FileNotFoundError):
        tb.load_training(spark, str(tmp_path / "nothing/*.parquet"))
    with pytest.raises(FileNotFoundError):
        tb.registry(spark, str(tmp_path / "models/*/metadata.json"))


def test_registry_reads_model_documents(spark, tmp_path):
    for site, season in ((3, "winter"), (3, "spring")):
        d = tmp_path / f"site_{site}" / season
        d.mkdir(parents=True)
        (d / "metadata.json").write_text(
            json.dumps({"target_variable": "discharge", "site_id": site, "season": season, "lag_cols": ["discharge_t-1"],
                        "variation_clip_pct": 0.05, "slopes": [0.1], "unknown": 1}, indent=2)
        )
    reg = tb.registry(spark, str(tmp_path / "site_*/*/metadata.json"))
    rows = {r.season: r for r in reg.collect()}
    assert set(rows) == {"winter", "spring"} and rows["winter"].slopes == [0.1]
    assert rows["winter"].model_path.endswith("winter/metadata.json") and rows["winter"].intercepts is None


def test_metrics_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(3, "winter", 1.0, 2.0, 3.0, 4.0, 0.5, None)], tb.METRIC_SCHEMA)
    tb.write_csv(df, str(tmp_path / "m"))
    assert tb.read_metrics(spark, str(tmp_path / "m")).collect() == df.collect()
    tb.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().season == "winter"


def test_state_keeps_the_newest_value(spark, tmp_path):
    path = str(tmp_path / "state")
    assert tb.load_state(spark, path, "last_id") is None
    tb.save_state(spark, path, "last_id", "5")
    tb.save_state(spark, path, "last_id", "9")
    assert tb.load_state(spark, path, "last_id") == "9"


def test_second_load_adds_only_new_members(spark):
    units = spark.createDataFrame([("a", "x", None, None), ("b", "y", None, None)], "name string, symbol string, definition string, unit_type string")
    first = nz.with_keys(units.limit(1), nz.UNIT)
    once = nz.insert_new(first, units, nz.UNIT)
    twice = nz.insert_new(once, units, nz.UNIT)
    assert once.count() == 2 and sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sorted(r.unit_id for r in twice.collect()) == [1, 2]


def test_a_job_removes_what_it_staged(spark, tmp_path):
    with job(spark, str(tmp_path)) as folder:
        with job(spark, folder):
            inner = stage(spark.range(3))
            assert inner.count() == 3
        outer = stage(spark.range(5))
        assert outer.count() == 5 and len(list(tmp_path.glob("job-*/stage-*"))) == 1
    assert list(tmp_path.iterdir()) == []
    assert stage(spark.range(2)).count() == 2
