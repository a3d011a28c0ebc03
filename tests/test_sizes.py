"""Work of registered queries that has to be dealt out by size, not into a fixed number of tasks."""

import os

import pytest

from checks import load, merge_queries, table_queries
from rillcast.operators import profile as pf

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")


@pytest.fixture()
def small_pieces(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, str(64 << 10))
    yield
    spark.conf.unset(name)


def test_star_is_staged_in_pieces_of_bounded_size(spark, tmp_path, monkeypatch, small_pieces):
    load()
    for t in ("orders", "customer", "nation", "region", "part"):
        os.symlink(f"{SF}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    files, plain = [], table_queries.stage

    def stage(df):
        out = plain(df)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(table_queries, "stage", stage)
    tables = table_queries.star(spark, str(tmp_path))
    assert files[0] > 2 * spark.sparkContext.defaultParallelism
    assert tables["datastream"].count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_stored_days_are_merged_once_by_what_a_report_needs(spark):
    load()
    facts = spark.sql("""SELECT id AS datastream_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 90 AS INT)) AS datetime_utc,
      CAST(id % 7 AS DOUBLE) AS value, CAST(id % 2 AS INT) AS site_id, 1 AS variable_id FROM range(900)""")
    days = merge_queries.stored_days(spark, facts)
    site = spark.sql("SELECT * FROM VALUES (0, 'A', 'a'), (1, 'B', 'b') AS t(site_id, site_code, name)")
    variable = spark.sql("SELECT 1 AS variable_id, 'x' AS variable_code, 'X' AS name, 1 AS unit_id")
    unit = spark.sql("SELECT 1 AS unit_id, 'u' AS symbol")
    for report in (lambda f: pf.summary(f, site, variable, unit), lambda f: pf.availability(f, site, variable), lambda f: pf.daily_summary(f, site, variable, None)):
        assert report(days).collect() == report(facts).collect()
    plan = pf.summary(days, site, variable, unit)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(site_id" in plan and "day_utc" not in plan


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    spark.range(200).selectExpr("concat('line ', id) AS value", "concat('f', id) AS file").write.partitionBy("file").text(f"{tmp_path}/lines")
    spark.sparkContext.setJobGroup("listing", "listing")
    spark.read.text(f"{tmp_path}/lines")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= 64
