"""Checks: irregular observations to regular series."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import (
    AIR_TARGET,
    CALENDAR,
    HOURLY,
    LINEAR,
    OBS,
    POINTS,
    bounded_sql,
    grid_sql,
    observations,
    season_name_sql,
)
from checks.registry import check, r, rsql
from rillcast.config import DISCHARGE, LIVE_SIGNED, Grid
from rillcast.functions.timeaxis import calendar, season_name, tick_time
from rillcast.operators.regular import (
    between,
    blank_negative,
    bounds,
    bucket_last,
    feature_stretches,
    fill_series,
    gap_runs,
    negative_counts,
    series,
    stretches,
    ticks,
    into_blocks,
)
from rillcast.plans.training import regular_table


def clean(spark, sf_dir):
    signed = F.col("variable_code").isin(list(LIVE_SIGNED))
    return observations(spark, sf_dir).withColumn("value", blank_negative(F.col("value"), signed))


def points(spark, sf_dir):
    return bucket_last(clean(spark, sf_dir))


@check("series_extract", f"WITH {OBS} SELECT * FROM obs WHERE site_id = 2 AND variable_id IN (2, 3)")
def _(spark, sf_dir):
    return series(observations(spark, sf_dir), 2, [2, 3])


@check("neg_to_null", f"""WITH {OBS} SELECT site_id, variable_code, count(*) AS n,
  count(*) FILTER (WHERE value < 0 AND variable_code <> 'AirTemp') AS n_negative FROM obs GROUP BY ALL""")
def _(spark, sf_dir):
    return negative_counts(observations(spark, sf_dir), LIVE_SIGNED)


@check("range_read", f"""WITH {OBS} SELECT * FROM obs
  WHERE datetime_utc > TIMESTAMP '2024-01-10 00:00:00' AND datetime_utc <= TIMESTAMP '2024-01-12 00:00:00'""")
def _(spark, sf_dir):
    ts = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 00:00:00", "2024-01-12 00:00:00")]
    return between(observations(spark, sf_dir), *ts)


@check("bucket_last", f"WITH {POINTS} SELECT * FROM points")
def _(spark, sf_dir):
    return points(spark, sf_dir).select(
        "site_id", "variable_code", tick_time("tick", HOURLY).alias("datetime"), "value"
    )


@check("bucket_start", f"""WITH {OBS} SELECT site_id, variable_code, date_trunc('hour', datetime_utc) AS datetime, value
  FROM obs QUALIFY row_number() OVER (PARTITION BY site_id, variable_code, date_trunc('hour', datetime_utc)
    ORDER BY datetime_utc DESC, variable_id DESC, datastream_id DESC) = 1""")
def _(spark, sf_dir):
    grid = Grid(label="start")
    return bucket_last(observations(spark, sf_dir), grid).select(
        "site_id", "variable_code", tick_time("tick", grid).alias("datetime"), "value"
    )


FEATURES_SQL = """feat(target_site, feature, src_site, code) AS (VALUES
  (3,'discharge',3,'Discharge'),(3,'air_temp',2,'AirTemp'),(3,'snow_depth',1,'SnowDepth'),(3,'precipitation',2,'Precip'),
  (4,'discharge',4,'Discharge'),(4,'air_temp',2,'AirTemp'),(4,'snow_depth',1,'SnowDepth'),(4,'precipitation',2,'Precip'))"""
OVERLAP = f"""{POINTS},
{FEATURES_SQL},
span AS (SELECT site_id, variable_code, min(datetime) AS lo, max(datetime) AS hi FROM points GROUP BY ALL),
rng AS (SELECT target_site AS site_id, max(lo) AS lo, min(hi) AS hi FROM feat
        JOIN span ON span.site_id = src_site AND variable_code = code GROUP BY ALL)"""


@check("overlap_grid", f"WITH {OVERLAP} SELECT site_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM rng")
def _(spark, sf_dir):
    runs = feature_stretches(observations(spark, sf_dir), DISCHARGE, HOURLY)
    rows = ticks(into_blocks(runs.where("feature = 'discharge'"), HOURLY.block))
    return rows.select(F.col("target_site").alias("site_id"), tick_time("tick", HOURLY).alias("datetime"))


def _nulls(name):
    w = "PARTITION BY site_id ORDER BY datetime ROWS BETWEEN"
    back, ahead = f"{w} UNBOUNDED PRECEDING AND CURRENT ROW", f"{w} 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    time = f"CASE WHEN {name}_o IS NOT NULL THEN datetime END"
    return f"""last_value({name}_o IGNORE NULLS) OVER ({back}) AS {name}_v0,
  last_value({time} IGNORE NULLS) OVER ({back}) AS {name}_t0,
  first_value({name}_o IGNORE NULLS) OVER ({ahead}) AS {name}_v1,
  first_value({time} IGNORE NULLS) OVER ({ahead}) AS {name}_t1"""


def _of(name, expr):
    for c in ("v0", "v1", "t0", "t1"):
        expr = expr.replace(c, f"{name}_{c}")
    return expr.replace("observed", f"{name}_o")


WIDE_RAW = f"""{OVERLAP},
wgrid AS (SELECT site_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM rng),
wraw AS (
  SELECT g.*, d.value AS discharge_o, a.value AS air_temp_o, s.value AS snow_depth_o, p.value AS precipitation_o
  FROM wgrid g
  LEFT JOIN points d ON d.site_id = g.site_id AND d.variable_code = 'Discharge' AND d.datetime = g.datetime
  LEFT JOIN points a ON a.site_id = 2 AND a.variable_code = 'AirTemp' AND a.datetime = g.datetime
  LEFT JOIN points s ON s.site_id = 1 AND s.variable_code = 'SnowDepth' AND s.datetime = g.datetime
  LEFT JOIN points p ON p.site_id = 2 AND p.variable_code = 'Precip' AND p.datetime = g.datetime)"""
WIDE = f"""{WIDE_RAW},
wscan AS (SELECT *, {", ".join(_nulls(n) for n in ("discharge", "air_temp", "snow_depth", "precipitation"))} FROM wraw),
wfill AS (
  SELECT site_id, datetime, discharge_o, air_temp_o, snow_depth_o, precipitation_o,
    {_of("discharge", LINEAR)} AS discharge, {_of("air_temp", LINEAR)} AS air_temp,
    coalesce(snow_depth_v0, snow_depth_v1) AS snow_depth,
    {_of("precipitation", bounded_sql())} AS precipitation
  FROM wscan),
wide AS (
  SELECT *, CASE WHEN count(precipitation) OVER t >= 18 THEN avg(precipitation) OVER t END AS precip_avg_last_24h
  FROM wfill WINDOW t AS (PARTITION BY site_id ORDER BY datetime ROWS 23 PRECEDING))"""


def wide(spark, sf_dir):
    return regular_table(observations(spark, sf_dir), DISCHARGE)


@check("wide_hourly", f"""WITH {WIDE_RAW} SELECT site_id, datetime, discharge_o AS discharge_observed,
  discharge_o IS NULL AS discharge_missing_raw, air_temp_o IS NULL AS air_temp_missing_raw,
  snow_depth_o IS NULL AS snow_depth_missing_raw, precipitation_o IS NULL AS precipitation_missing_raw FROM wraw""")
def _(spark, sf_dir):
    return wide(spark, sf_dir).select(
        "site_id", "datetime", "discharge_observed", "discharge_missing_raw", "air_temp_missing_raw",
        "snow_depth_missing_raw", "precipitation_missing_raw",
    )


@check("regular_multi", f"""WITH {WIDE} SELECT site_id, datetime, {rsql("discharge", "discharge")}, {rsql("air_temp", "air_temp")},
  {rsql("snow_depth", "snow_depth")}, {rsql("precipitation", "precipitation")},
  {rsql("precip_avg_last_24h", "precip_avg_last_24h")}, {CALENDAR.format(t="datetime")} FROM wide""")
def _(spark, sf_dir):
    cols = ["discharge", "air_temp", "snow_depth", "precipitation", "precip_avg_last_24h"]
    return wide(spark, sf_dir).select(
        "site_id", "datetime", *[r(c).alias(c) for c in cols],
        "year", "month", "day", "hour", "day_of_week", "day_of_year", "season",
    )


AIR_DENSE = f"""{POINTS.replace("SELECT site_id, variable_code, datetime, v AS value FROM clean WHERE v IS NOT NULL",
                               "SELECT site_id, variable_code, datetime, v AS value FROM clean WHERE v IS NOT NULL AND variable_code = 'AirTemp'")},
{grid_sql()},
filled AS (SELECT *, {LINEAR} AS value FROM dense)"""


@check("regular_single", f"""WITH {AIR_DENSE} SELECT site_id, datetime, {rsql("value", "air_temp")},
  observed AS air_temp_observed, observed IS NULL AS air_temp_missing_raw, {CALENDAR.format(t="datetime")} FROM filled""")
def _(spark, sf_dir):
    return regular_table(observations(spark, sf_dir), AIR_TARGET).withColumn("air_temp", r("air_temp"))


def _fill_check(name, fill, expr):
    @check(name, f"""WITH {POINTS}, {grid_sql()}
      SELECT site_id, variable_code, datetime, observed, {rsql(expr, "value")} FROM dense""")
    def _(spark, sf_dir):
        return fill_series(points(spark, sf_dir), HOURLY, fill).select(
            "site_id", "variable_code", "datetime", "observed", r("value").alias("value")
        )


_fill_check("fill_time", "time", LINEAR)
_fill_check("fill_ffill", "carry", "coalesce(v0, v1)")
_fill_check("fill_bounded", "bounded", bounded_sql())
_fill_check("fill_none", "none", "observed")


@check("roll_24", f"""WITH {WIDE} SELECT site_id, datetime, {rsql("precip_avg_last_24h", "precip_avg_last_24h")} FROM wide""")
def _(spark, sf_dir):
    return wide(spark, sf_dir).select("site_id", "datetime", r("precip_avg_last_24h").alias("precip_avg_last_24h"))


@check("calendar", f"""SELECT o_orderkey, {CALENDAR.format(t="o_orderdate")}, {season_name_sql("o_orderdate")} AS season_name FROM orders""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return orders.withColumns(calendar("o_orderdate")).withColumn(
        "season_name", season_name("month")
    ).drop("o_orderdate")


@check("gap_runs", f"""WITH {POINTS}, {grid_sql()},
islands AS (
  SELECT site_id, variable_code, datetime,
         idx - row_number() OVER (PARTITION BY site_id, variable_code ORDER BY idx) AS island
  FROM dense WHERE observed IS NULL)
SELECT site_id, variable_code, min(datetime) AS gap_start, max(datetime) AS gap_end, count(*) AS length
FROM islands GROUP BY site_id, variable_code, island""")
def _(spark, sf_dir):
    return gap_runs(points(spark, sf_dir), HOURLY)


@check("long_gap_series", f"""WITH {POINTS}, {grid_sql()},
islands AS (
  SELECT site_id, variable_code, idx - row_number() OVER (PARTITION BY site_id, variable_code ORDER BY idx) AS island
  FROM dense WHERE observed IS NULL),
lengths AS (SELECT site_id, variable_code, count(*) AS length FROM islands GROUP BY site_id, variable_code, island)
SELECT site_id, variable_code, max(length) >= 3 AS has_long_gap, count(*) AS n_gaps FROM lengths GROUP BY ALL""")
def _(spark, sf_dir):
    return gap_runs(points(spark, sf_dir), HOURLY).groupBy("site_id", "variable_code").agg(
        (F.max("length") >= 3).alias("has_long_gap"), F.count(F.lit(1)).alias("n_gaps")
    )
