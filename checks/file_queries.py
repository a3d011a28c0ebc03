"""Checks: tables written to storage and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import (
    DAILY_SAMPLES,
    DAILY_SPEC,
    DAILY_TARGET,
    FITTED,
    PREDICTED,
    STAGING,
    daily_samples,
    daily_scored,
    daily_split,
    metric_sql,
    staging,
    DAILY,
)
from checks.live_queries import FORECAST, forecasts
from checks.model_queries import MEASURES, _measure_sql, _rounded
from checks.registry import check, r, rsql
from checks.table_queries import FACT, RECORDS, STAR, data_lines, site_headers, star
from rillcast.operators import evaluate as ev
from rillcast.operators import live, models, prep
from rillcast.session import checkpoint_dir
from rillcast.sources import sensor_csv as sc
from rillcast.sources.snapshots import stored_predictions, upsert_predictions
from rillcast.sources import tables as tb
from rillcast.sources.staged import stage


def folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@check("staging_append", f"WITH {STAGING} SELECT staging_id, site_code, variable_code, datetime_utc, value FROM staging")
def _(spark, sf_dir):
    path = folder(spark, "staging")
    rows = staging(spark, sf_dir)
    # Two loads that together hold every row, whatever the line status.
    first = F.coalesce(F.col("processing_level_code") == "F", F.lit(False))
    for part in (first, ~first):
        tb.append_staging(rows.where(part), path)
    return tb.scan(spark, path, ["staging_id", "site_code", "variable_code", "datetime_utc", "value"])


@check("staging_by_site", f"""WITH {STAGING} SELECT site_code, variable_code, count(*) AS n, sum(value) AS total FROM staging
  WHERE site_code IN ('NATION_3', 'NATION_7') GROUP BY ALL""")
def _(spark, sf_dir):
    path = folder(spark, "staging")
    tb.append_staging(staging(spark, sf_dir), path)
    some = tb.scan(spark, path, ["site_code", "variable_code", "value"], "site_code IN ('NATION_3', 'NATION_7')")
    return some.groupBy("site_code", "variable_code").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@check("facts_by_site", f"{STAR}, fact AS ({FACT}) SELECT site_id, variable_id, count(*) AS n, sum(value) AS total FROM fact "
       "WHERE site_id IN (1, 2) GROUP BY ALL")
def _(spark, sf_dir):
    path = folder(spark, "facts")
    tb.write_facts(star(spark, sf_dir)["datastream"], path)
    facts = tb.scan(spark, path, ["site_id", "variable_id", "value"], "site_id IN (1, 2)")
    return facts.groupBy("site_id", "variable_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


# Training files of two runs: the later file replaces the samples both hold.
@check("training_reload", f"""WITH {DAILY_SAMPLES} SELECT site_id, forecast_start_time, {rsql("lags[28]", "newest_lag")},
  {rsql("targets[7]", "last_target")} FROM samples""")
def _(spark, sf_dir):
    samples = stage(daily_samples(spark, sf_dir))
    path = folder(spark, "training")
    old = samples.withColumn("targets", F.transform("targets", lambda y: y - 1))
    for mode, part in (("overwrite", old), ("append", samples)):
        tb.write_training(part, DAILY_TARGET, path, DAILY_SPEC.lags, DAILY_SPEC.horizons, mode)
    loaded = tb.load_samples(spark, path, "discharge", DAILY_SPEC.lags, DAILY_SPEC.horizons)
    return prep.newest_wins(prep.parse_times(loaded)).select(
        "site_id", "forecast_start_time", r(F.element_at("lags", -1)).alias("newest_lag"),
        r(F.element_at("targets", -1)).alias("last_target"),
    )


@check("metrics_csv", f"WITH {PREDICTED} SELECT site_id, season, {_measure_sql()} FROM {metric_sql('site_id, season')}")
def _(spark, sf_dir):
    path = folder(spark, "metrics")
    tb.write_csv(ev.season_metrics(ev.expand(daily_scored(spark, sf_dir), DAILY)), path)
    return _rounded(tb.read_metrics(spark, path), MEASURES)


@check("registry_json", f"""WITH {FITTED} SELECT 'discharge' AS target_variable, site_id, season_name AS season, CAST(horizon AS INTEGER) AS horizon,
  {rsql("slope", "slope")}, {rsql("intercept", "intercept")} FROM fitted""")
def _(spark, sf_dir):
    split = stage(prep.usable_subsets(daily_split(spark, sf_dir)))
    fitted = models.linear_registry(models.fit_linear(split.where("part = 'train'")))
    path = folder(spark, "models")
    documents = fitted.select(
        F.lit("discharge").alias("target_variable"), "site_id", F.col("season_name").alias("season"), "slopes", "intercepts"
    )
    tb.write_json(documents, path)
    known = tb.registry(spark, path, one_per_file=False)
    pairs = F.posexplode(F.arrays_zip("slopes", "intercepts")).alias("i", "m")
    return known.select("target_variable", "site_id", "season", pairs).select(
        "target_variable", "site_id", "season", (F.col("i") + 1).alias("horizon"),
        r("m.slopes").alias("slope"), r("m.intercepts").alias("intercept"),
    )


@check("predictions_csv", f"""WITH {FORECAST} SELECT source_datastream_id, target_variable, site_id, season, history_end_time,
  forecast_start_time, horizon, horizon_bin, target_timestamp, {rsql("prediction", "prediction")}, model_path FROM pred""")
def _(spark, sf_dir):
    path = folder(spark, "csv")
    rows = stage(forecasts(spark, sf_dir))
    # Two appends, as two stream batches would do: odd and even source ids.
    for odd in (0, 1):
        tb.append_predictions_csv(rows.where(F.pmod("source_datastream_id", F.lit(2)) == odd), path)
    schema = rows.select(*live.CSV_COLUMNS).schema
    return spark.read.option("header", "true").schema(schema).csv(path).withColumn("prediction", r("prediction"))


@check("prediction_store", f"""WITH {FORECAST} SELECT source_datastream_id, target_variable, horizon,
  {rsql("prediction * CASE WHEN site_id = 3 THEN 1.0123456789 ELSE 1 END", "prediction")} FROM pred
QUALIFY row_number() OVER (PARTITION BY target_variable, site_id, history_end_time, season_key, horizon ORDER BY source_datastream_id DESC) = 1""")
def _(spark, sf_dir):
    path = folder(spark, "predictions")
    rows = stage(forecasts(spark, sf_dir))
    raised = rows.withColumn("prediction", F.col("prediction") * 1.0123456789)
    tb.append_batch(rows, path, 0)
    # A failed attempt at batch 1 is replaced by its replay.
    tb.append_batch(rows.where("site_id = 2"), path, 1)
    tb.append_batch(raised.where("site_id = 3"), path, 1)
    return tb.current_predictions(spark, path).select(
        "source_datastream_id", "target_variable", "horizon", r("prediction").alias("prediction")
    )


# The same predictions written twice into a table by day, those of site 2 raised the second time.
@check("upsert_by_day", f"""WITH {FORECAST} SELECT source_datastream_id, target_variable, site_id, horizon, history_end_time,
  {rsql("prediction * CASE WHEN site_id = 2 THEN 1.0123456789 ELSE 1 END", "prediction")} FROM pred
QUALIFY row_number() OVER (PARTITION BY target_variable, site_id, history_end_time, season_key, horizon ORDER BY source_datastream_id DESC) = 1""")
def _(spark, sf_dir):
    path = folder(spark, "predictions")
    rows = stage(forecasts(spark, sf_dir))
    upsert_predictions(rows, path)
    upsert_predictions(rows.where("site_id = 2").withColumn("prediction", F.col("prediction") * 1.0123456789), path)
    return stored_predictions(spark, path).select(
        "source_datastream_id", "target_variable", "site_id", "horizon", "history_end_time", r("prediction").alias("prediction")
    )


# Sensor lines written as text files and read again, header and data of a site in one file.
@check("csv_staging", f"""SELECT concat('Site ', s_name) AS site_name, s_acctbal AS latitude, qualifier_code, datetime_utc, value
FROM ({RECORDS}) d JOIN supplier ON d.file = concat('supplier_', s_suppkey, '.csv')""")
def _(spark, sf_dir):
    path = folder(spark, "sensor")
    lines = data_lines(spark, sf_dir).unionByName(site_headers(spark, sf_dir))
    in_order = lines.repartition("file").sortWithinPartitions("file", "position").select("file", F.col("line").alias("value"))
    in_order.write.partitionBy("file").text(path)
    return sc.staging_rows(spark, path).select("site_name", "latitude", "qualifier_code", "datetime_utc", "value")
