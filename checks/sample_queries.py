"""Checks: supervised samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import (
    AIR_TARGET,
    CALENDAR,
    DAILY,
    DAILY_SAMPLES,
    DAILY_SPEC,
    DAILY_DENSE,
    HOURLY,
    daily,
    daily_samples,
    observations,
    samples_sql,
)
from checks.registry import SQL, check, r, rsql
from checks.series_queries import AIR_DENSE, WIDE
from rillcast.config import DISCHARGE, SampleSpec
from rillcast.functions.timeaxis import tick_time
from rillcast.operators.regular import bounds, bucket_last, regular_blocks
from rillcast.operators.samples import lag_table, ratio_split, samples_of_table, stride_positions
from rillcast.session import checkpoint_dir
from rillcast.sources.staged import stage
from rillcast.sources.tables import audit, load_samples, load_training, write_training
from rillcast.plans.training import regular_table, target_by_terms, training_samples

MULTI = f"""{WIDE},
multi AS (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY datetime) - 1 AS idx, discharge AS value,
         avg(air_temp) OVER (PARTITION BY site_id ORDER BY datetime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS air_avg,
         lag(snow_depth) OVER (PARTITION BY site_id ORDER BY datetime) AS snow_latest,
         lag(precip_avg_last_24h) OVER (PARTITION BY site_id ORDER BY datetime) AS precip_avg
  FROM wide),
{samples_sql(168, 24, "1 HOUR", "multi", main="discharge_o",
             flags="discharge_o IS NULL OR air_temp_o IS NULL OR snow_depth_o IS NULL OR precipitation_o IS NULL",
             extra="AND s.precip_avg IS NOT NULL")}"""
# A run counts per raw series, so the flags are checked one by one.
_RUN = MULTI[MULTI.index("runs AS ("):MULTI.index("starts AS (")]
_RUNS = "runs AS (\n" + "\n  UNION ALL\n".join(
    f"""  SELECT site_id, idx, idx - coalesce(max(CASE WHEN {c}_o IS NOT NULL THEN idx END) OVER (
    PARTITION BY site_id ORDER BY idx ROWS UNBOUNDED PRECEDING), -1) AS run FROM sized"""
    for c in ("discharge", "air_temp", "snow_depth", "precipitation")
) + "),\n"
MULTI = MULTI.replace(_RUN, _RUNS)
SINGLE = f"{AIR_DENSE},\n{samples_sql(168, 24, '1 HOUR', 'filled')}"

META = """site_id, forecast_start_time - INTERVAL 1 {u} AS history_end_time, forecast_start_time,
  forecast_start_time + INTERVAL {h} {u} AS forecast_end_time, {cal},
  CAST(CASE WHEN month(forecast_start_time) IN (3,4,5,6) THEN 1 ELSE 6 END AS INTEGER) AS sample_stride_hours"""


def _digest(df):
    """Arrays as sums, sums weighted by place, and ends, so a sample stays one row."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    return df.withColumns(
        {
            "lag_sum": r(total("lags"), 4),
            "lag_places": r(total(F.transform("lags", lambda x, i: x * (i + 1))), 3),
            "target_places": r(total(F.transform("targets", lambda x, i: x * (i + 1))), 3),
            "lag_oldest": r(F.element_at("lags", 1)),
            "lag_newest": r(F.element_at("lags", -1)),
            "n_lags": F.size("lags"),
            "target_sum": r(total("targets"), 4),
            "target_first": r(F.element_at("targets", 1)),
            "target_last": r(F.element_at("targets", -1)),
            "n_targets": F.size("targets"),
        }
    ).drop("lags", "targets")


DIGEST = f"""{rsql("list_sum([lags[i] * i FOR i IN range(1, len(lags) + 1)])", "lag_places", 3)},
  {rsql("list_sum([targets[i] * i FOR i IN range(1, len(targets) + 1)])", "target_places", 3)}, {rsql("list_sum(lags)", "lag_sum", 4)}, {rsql("lags[1]", "lag_oldest")}, {rsql("lags[-1]", "lag_newest")},
  CAST(len(lags) AS INTEGER) AS n_lags, {rsql("list_sum(targets)", "target_sum", 4)}, {rsql("targets[1]", "target_first")},
  {rsql("targets[-1]", "target_last")}, CAST(len(targets) AS INTEGER) AS n_targets"""


@check("samples_multi", f"""WITH {MULTI} SELECT {META.format(u="HOUR", h=23, cal=CALENDAR.format(t="forecast_start_time"))},
  {rsql("snow_latest", "snow_depth_latest")}, {rsql("air_avg", "air_temp_avg_last_24h")},
  {rsql("precip_avg", "precip_avg_last_24h")}, {DIGEST}
  FROM lagged JOIN (SELECT site_id, idx, snow_latest, air_avg, precip_avg FROM multi) USING (site_id, idx)""")
def _(spark, sf_dir):
    rows = _digest(training_samples(observations(spark, sf_dir), DISCHARGE))
    names = ("snow_depth_latest", "air_temp_avg_last_24h", "precip_avg_last_24h")
    return rows.withColumns({c: r(c) for c in names})


# Codes as other networks write them; the terms choose them, and two codes of discharge feed one series.
CODES = {"AirTemp": ("Air Temperature", "Air Temperature"), "Discharge": ("StreamFlow", "River discharge"),
         "Precip": ("Precipitation", "Precipitation"), "SnowDepth": ("Snow Depth", "Snow Depth")}


@check("samples_by_terms", f"""WITH {MULTI} SELECT {META.format(u="HOUR", h=23, cal=CALENDAR.format(t="forecast_start_time"))},
  {rsql("snow_latest", "snow_depth_latest")}, {rsql("air_avg", "air_temp_avg_last_24h")},
  {rsql("precip_avg", "precip_avg_last_24h")}, {DIGEST}
  FROM lagged JOIN (SELECT site_id, idx, snow_latest, air_avg, precip_avg FROM multi) USING (site_id, idx)""")
def _(spark, sf_dir):
    obs = observations(spark, sf_dir)
    code = F.col("variable_code")
    for old, (even, odd) in CODES.items():
        code = F.when(F.col("variable_code") == old, F.when(F.col("datastream_id") % 2 == 0, F.lit(even)).otherwise(F.lit(odd))).otherwise(code)
    obs = obs.withColumn("variable_code", code)
    variables = obs.select("variable_code", F.lit("").alias("name")).distinct()
    rows = _digest(training_samples(obs, target_by_terms(DISCHARGE, variables)))
    names = ("snow_depth_latest", "air_temp_avg_last_24h", "precip_avg_last_24h")
    return rows.withColumns({c: r(c) for c in names})


# The whole discharge build to files, one folder per site: 15 descriptive columns, 168 lags and 24 targets.
@check("training_files", f"""WITH {MULTI} SELECT site_id, count(*) AS row_count, CAST(15 + 168 + 24 AS INTEGER) AS column_count FROM lagged
  JOIN (SELECT site_id, idx FROM multi) USING (site_id, idx) GROUP BY site_id""")
def _(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"
    spec = SampleSpec()
    write_training(training_samples(observations(spark, sf_dir), DISCHARGE), DISCHARGE, path, spec.lags, spec.horizons)
    return audit(load_training(spark, path))


# The same files, value by value: what is read back is what was built.
@check("training_files_values", SQL["samples_multi"])
def _(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"
    spec = SampleSpec()
    built = stage(training_samples(observations(spark, sf_dir), DISCHARGE))
    write_training(built, DISCHARGE, path, spec.lags, spec.horizons)
    rows = _digest(load_samples(spark, path, "discharge", spec.lags, spec.horizons).select(*built.columns))
    names = ("snow_depth_latest", "air_temp_avg_last_24h", "precip_avg_last_24h")
    return rows.withColumns({c: r(c) for c in names})


# The regular table a user already has gives the same samples as the observations behind it.
@check("samples_of_table", f"""WITH {SINGLE} SELECT {META.format(u="HOUR", h=23, cal=CALENDAR.format(t="forecast_start_time"))}, {DIGEST} FROM lagged""")
def _(spark, sf_dir):
    hourly = regular_table(observations(spark, sf_dir), AIR_TARGET, HOURLY)
    return _digest(samples_of_table(hourly, AIR_TARGET, HOURLY, SampleSpec(), False))


@check("samples_single", f"""WITH {SINGLE} SELECT {META.format(u="HOUR", h=23, cal=CALENDAR.format(t="forecast_start_time"))}, {DIGEST} FROM lagged""")
def _(spark, sf_dir):
    return _digest(training_samples(observations(spark, sf_dir), AIR_TARGET))


@check("samples_daily", f"""WITH {DAILY_SAMPLES} SELECT {META.format(u="DAY", h=6, cal=CALENDAR.format(t="forecast_start_time"))}, {DIGEST} FROM samples""")
def _(spark, sf_dir):
    return _digest(daily_samples(spark, sf_dir))


@check("lag_matrix", f"""WITH {SINGLE} SELECT site_id, forecast_start_time, CAST(168 - i AS INTEGER) AS lag, {rsql("lags[i + 1]", "value")}
  FROM lagged, range(0, 168) t(i)""")
def _(spark, sf_dir):
    s = training_samples(observations(spark, sf_dir), AIR_TARGET)
    return s.select("site_id", "forecast_start_time", F.posexplode("lags").alias("i", "v")).select(
        "site_id", "forecast_start_time", (F.lit(168) - F.col("i")).alias("lag"), r("v").alias("value")
    )


@check("targets", f"""WITH {SINGLE} SELECT site_id, forecast_start_time, CAST(h AS INTEGER) AS horizon, targets[h] AS value
  FROM lagged, range(1, 25) t(h)""")
def _(spark, sf_dir):
    s = training_samples(observations(spark, sf_dir), AIR_TARGET)
    return s.select("site_id", "forecast_start_time", F.posexplode("targets").alias("i", "value")).select(
        "site_id", "forecast_start_time", (F.col("i") + 1).alias("horizon"), "value"
    )


@check("stride_positions", f"""WITH {DAILY_DENSE}, {samples_sql(28, 7, "1 DAY", "filled")}
  SELECT s.site_id, s.datetime, CAST(CASE WHEN month(s.datetime) IN (3,4,5,6) THEN 1 ELSE 6 END AS INTEGER) AS stride
  FROM visits v JOIN sized s USING (site_id, idx) WHERE s.idx <= s.n - 7""")
def _(spark, sf_dir):
    ranges = bounds(bucket_last(daily(spark, sf_dir), DAILY, ("site_id",)), ("site_id",))
    return stride_positions(ranges, ("site_id",), DAILY, DAILY_SPEC).select(
        "site_id", tick_time("tick", DAILY).alias("datetime"), "stride"
    )


# Every lag counts by value and place, so neither a lost nor a moved value goes unseen; precipitation has missing ones.
NEXT = f"""{WIDE},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY datetime) - 1 AS idx,
         month(datetime) AS month, hour(datetime) AS hour FROM wide),
hist AS (
  SELECT site_id, datetime, idx, discharge_o, f.feature, f.v AS value
  FROM numbered, LATERAL (VALUES ('discharge', discharge), ('air_temp', air_temp), ('snow_depth', snow_depth),
    ('precipitation', precipitation), ('month', CAST(month AS DOUBLE)), ('hour', CAST(hour AS DOUBLE))) f(feature, v))
SELECT site_id, datetime AS prediction_time, discharge_o AS target, feature,
  {rsql("coalesce(total, 0)", "lag_sum", 4)}, {rsql("coalesce(placed, 0) - (idx - 169) * coalesce(total, 0)", "lag_places", 3)}, n AS lag_count,
  CAST(coalesce(absent, 0) - (idx - 169) * (168 - n) AS BIGINT) AS absent_places, {rsql("oldest", "lag_oldest")}, {rsql("newest", "lag_newest")}
FROM (SELECT *, sum(value) OVER w AS total, sum(value * idx) OVER w AS placed, count(value) OVER w AS n,
        sum(CASE WHEN value IS NULL THEN idx END) OVER w AS absent, first_value(value) OVER w AS oldest, last_value(value) OVER w AS newest
      FROM hist WINDOW w AS (PARTITION BY site_id, feature ORDER BY idx ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING))
WHERE idx >= 168 AND discharge_o IS NOT NULL"""


@check("next_hour_samples", f"WITH {NEXT}")
def _(spark, sf_dir):
    names = ["discharge", "air_temp", "snow_depth", "precipitation", "month", "hour"]
    rows = regular_blocks(observations(spark, sf_dir), DISCHARGE, HOURLY, before=168)
    at = tick_time("tick", HOURLY)
    rows = rows.withColumns({"month": F.month(at).cast("double"), "hour": F.hour(at).cast("double")})
    wide = lag_table(rows, names, "discharge", HOURLY, 168)
    lags = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"{n}_lags").alias("v")) for n in names])
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    placed = F.transform("v", lambda x, i: x * (i + 1))
    absent = F.transform("v", lambda x, i: F.when(x.isNull(), (i + 1).cast("double")))
    return wide.select("site_id", "prediction_time", "target", F.inline(lags)).select(
        "site_id", "prediction_time", "target", "feature",
        r(total("v"), 4).alias("lag_sum"),
        r(total(placed), 3).alias("lag_places"),
        F.size(F.filter("v", lambda x: x.isNotNull())).cast("long").alias("lag_count"),
        total(absent).cast("long").alias("absent_places"),
        r(F.element_at("v", 1)).alias("lag_oldest"),
        r(F.element_at("v", -1)).alias("lag_newest"),
    )


@check("ratio_split", f"""WITH {DAILY_SAMPLES},
ranked AS (SELECT site_id, forecast_start_time, row_number() OVER (PARTITION BY site_id ORDER BY forecast_start_time) AS position,
                  count(*) OVER (PARTITION BY site_id) AS total FROM samples)
SELECT site_id, forecast_start_time, CAST(position AS BIGINT) AS position,
       CASE WHEN position <= floor(total * 0.8) THEN 'train' ELSE 'test' END AS part FROM ranked""")
def _(spark, sf_dir):
    return ratio_split(daily_samples(spark, sf_dir), ["site_id"], "forecast_start_time", DAILY).select(
        "site_id", "forecast_start_time", "position", "part"
    )
