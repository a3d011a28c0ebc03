"""Checks: events to forecasts (batch twin of the stream)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import (
    FITTED,
    HOURLY,
    LINEAR,
    LIVE_HORIZONS,
    OBS,
    POINTS,
    REGISTRY,
    bounded_sql,
    daily_split,
    live_registry,
    observations,
    season_name_sql,
    table,
)
from checks.registry import check, r, rsql
from rillcast.config import LIVE_TARGETS, Clip
from rillcast.functions.timeaxis import on_grid
from rillcast.operators import live
from rillcast.operators.models import fit_linear, linear_registry
from rillcast.operators.prep import usable_subsets
from rillcast.operators.profile import max_id
from rillcast.session import checkpoint_dir
from rillcast.sources.tables import load_state, save_state
from rillcast.sources.staged import stage

TARGET_SQL = "CASE variable_code WHEN 'AirTemp' THEN 'air_temperature' WHEN 'Discharge' THEN 'discharge' END"
ON_HOUR = "date_trunc('hour', datetime_utc) = datetime_utc"


def events(spark, sf_dir):
    return observations(spark, sf_dir).select(*live.EVENT_COLUMNS)


def variables(spark, sf_dir):
    return events(spark, sf_dir).select("variable_id", "variable_code").distinct()


@check("poll_batch", f"""WITH {OBS} SELECT datastream_id, site_id, variable_id, variable_code, datetime_utc, value FROM obs
  WHERE datastream_id > 500 ORDER BY datastream_id LIMIT 250""")
def _(spark, sf_dir):
    facts = events(spark, sf_dir)
    return live.new_events(facts.drop("variable_code"), variables(spark, sf_dir), 500, 250)


# A poller that starts at the current maximum, falls back to an older mark, and goes on from the newest one it saved.
@check("resume_state", f"""WITH {OBS} SELECT datastream_id, site_id, variable_id, variable_code, datetime_utc, value FROM obs
  WHERE datastream_id > (SELECT max(event_id) // 2 FROM events) ORDER BY datastream_id LIMIT 250""")
def _(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    facts = events(spark, sf_dir)
    top = max_id(facts, "datastream_id").first().max_id
    for mark in (top, top // 3, top // 2):
        save_state(spark, path, "last_id", str(mark))
    return live.new_events(facts.drop("variable_code"), variables(spark, sf_dir), int(load_state(spark, path, "last_id")), 250)


# Replay of events chosen by their ids: all purchases.
@check("replay_ids", f"""WITH {OBS} SELECT datastream_id, site_id, variable_id, variable_code, datetime_utc, value FROM obs
  WHERE datastream_id IN (SELECT event_id FROM events WHERE event_type = 'purchase')""")
def _(spark, sf_dir):
    facts = events(spark, sf_dir).drop("variable_code")
    wanted = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("datastream_id"))
    return live.events_by_id(facts, variables(spark, sf_dir), wanted)


@check("exact_hour", f"WITH {OBS} SELECT datastream_id, datetime_utc FROM obs WHERE {ON_HOUR}")
def _(spark, sf_dir):
    return events(spark, sf_dir).where(on_grid("datetime_utc")).select("datastream_id", "datetime_utc")


@check("newest_guard", f"""WITH {OBS} SELECT datastream_id, site_id, variable_id, datetime_utc,
  NOT EXISTS (SELECT 1 FROM obs o WHERE o.site_id = e.site_id AND o.variable_id = e.variable_id
              AND o.datastream_id <> e.datastream_id AND o.datetime_utc >= e.datetime_utc) AS is_newest FROM obs e""")
def _(spark, sf_dir):
    e = events(spark, sf_dir)
    return live.newer_than_others(e, e).select("datastream_id", "site_id", "variable_id", "datetime_utc", "is_newest")


@check("route_events", f"""WITH {OBS}, {REGISTRY}, e AS (
  SELECT *, {TARGET_SQL} AS target_variable, {season_name_sql("(datetime_utc + INTERVAL 1 HOUR)")} AS season FROM obs)
SELECT datastream_id, e.target_variable, e.site_id, e.season, model_path FROM e LEFT JOIN registry g
  ON g.target_variable = e.target_variable AND g.site_id = e.site_id AND g.season = e.season""")
def _(spark, sf_dir):
    e = live.with_target(live.forecast_season(events(spark, sf_dir)))
    return live.route(e, live_registry(spark)).select(
        "datastream_id", "target_variable", "site_id", "season", "model_path"
    )


@check("event_json", f"""WITH {OBS} SELECT datastream_id, site_id, variable_id, variable_code, datetime_utc, value
  FROM obs WHERE {ON_HOUR}""")
def _(spark, sf_dir):
    return live.from_payload(live.to_payload(events(spark, sf_dir)))


JUDGED = f"""{OBS}, {REGISTRY},
judged AS (
  SELECT e.datastream_id, CASE WHEN NOT ({ON_HOUR}) THEN 'not_exact_hour'
    WHEN e.target_variable IS NULL THEN 'no_target'
    WHEN EXISTS (SELECT 1 FROM obs o WHERE o.site_id = e.site_id AND o.variable_id = e.variable_id
                 AND o.datastream_id <> e.datastream_id AND o.datetime_utc >= e.datetime_utc) THEN 'not_newer'
    WHEN g.model_path IS NULL THEN 'no_model' ELSE 'accepted' END AS reason
  FROM (SELECT *, {TARGET_SQL} AS target_variable, {season_name_sql("(datetime_utc + INTERVAL 1 HOUR)")} AS season FROM obs) e
  LEFT JOIN registry g ON g.target_variable = e.target_variable AND g.site_id = e.site_id AND g.season = e.season)"""


@check("reject_reasons", f"WITH {JUDGED} SELECT reason, count(DISTINCT datastream_id) AS n FROM judged GROUP BY reason")
def _(spark, sf_dir):
    e = events(spark, sf_dir)
    return live.reason_counts(live.gate(e, e, live_registry(spark)))


# Replay: every exact-hour event of a modelled series is forecast as of its own time.
def replayed(spark, sf_dir):
    e = live.with_target(live.forecast_season(events(spark, sf_dir))).where(on_grid("datetime_utc"))
    return live.route(e, live_registry(spark)).where(F.col("model_path").isNotNull())


REPLAY = f"""{POINTS}, {REGISTRY},
replay AS (
  SELECT e.*, model_path, a, b FROM (
    SELECT *, {TARGET_SQL} AS target_variable, {season_name_sql("(datetime_utc + INTERVAL 1 HOUR)")} AS season
    FROM obs WHERE {ON_HOUR}) e
  JOIN registry g ON g.target_variable = e.target_variable AND g.site_id = e.site_id AND g.season = e.season)"""


def _window(name, site, code, hours):
    """Ticks of one feature per event with the neighbours inside the event's own window."""
    return f"""{name}_grid AS (
  SELECT datastream_id, {site} AS src_site, datetime_utc AS hi,
         unnest(generate_series(datetime_utc - INTERVAL {hours - 1} HOUR, datetime_utc, INTERVAL 1 HOUR)) AS datetime
  FROM replay),
{name} AS (
  SELECT g.datastream_id, g.datetime, p.value AS observed,
    row_number() OVER w AS pos,
    last_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
    last_value(CASE WHEN p.value IS NOT NULL THEN g.datetime END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
    first_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS v1,
    first_value(CASE WHEN p.value IS NOT NULL THEN g.datetime END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t1
  FROM {name}_grid g LEFT JOIN points p ON p.site_id = g.src_site AND p.variable_code = {code} AND p.datetime = g.datetime
  WINDOW w AS (PARTITION BY g.datastream_id ORDER BY g.datetime))"""


FEATURES = f"""{REPLAY},
{_window("lagw", "site_id", "(SELECT variable_code FROM replay r WHERE r.datastream_id = g.datastream_id)", 168)},
{_window("snow", "1", "'SnowDepth'", 168)},
{_window("air", "2", "'AirTemp'", 24)},
{_window("rain", "2", "'Precip'", 24)},
runs AS (SELECT datastream_id, pos - coalesce(max(CASE WHEN observed IS NOT NULL THEN pos END) OVER (
           PARTITION BY datastream_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS run FROM lagw),
gaps AS (SELECT datastream_id, max(run) AS longest_gap FROM runs GROUP BY ALL),
lagf AS (SELECT datastream_id, list({LINEAR} ORDER BY pos) AS lags, count({LINEAR}) AS n FROM lagw GROUP BY ALL),
snowf AS (SELECT datastream_id, arg_max(coalesce(v0, v1), pos) AS snow FROM snow GROUP BY ALL),
airf AS (SELECT datastream_id, avg({LINEAR}) AS air FROM air GROUP BY ALL),
rainf AS (SELECT datastream_id, CASE WHEN count({bounded_sql()}) >= 18 THEN avg({bounded_sql()}) END AS rain FROM rain GROUP BY ALL),
feat AS (
  SELECT r.*, lags, CAST(longest_gap AS BIGINT) AS longest_gap, n,
    CASE WHEN target_variable = 'discharge' THEN snow END AS snow, CASE WHEN target_variable = 'discharge' THEN air END AS air,
    CASE WHEN target_variable = 'discharge' THEN rain END AS rain,
    CASE WHEN n = 0 THEN 'no_history' WHEN longest_gap >= 10 THEN 'long_gap' WHEN n < 168 THEN 'unfilled'
      WHEN target_variable = 'discharge' AND snow IS NULL THEN 'no_snow_depth_latest'
      WHEN target_variable = 'discharge' AND air IS NULL THEN 'no_air_temp_avg_last_24h'
      WHEN target_variable = 'discharge' AND rain IS NULL THEN 'no_precip_avg_last_24h' END AS failure
  FROM replay r JOIN lagf USING (datastream_id) JOIN gaps USING (datastream_id) LEFT JOIN snowf USING (datastream_id)
  LEFT JOIN airf USING (datastream_id) LEFT JOIN rainf USING (datastream_id))"""


def features(spark, sf_dir):
    return live.event_features(replayed(spark, sf_dir), observations(spark, sf_dir), 168)


@check("event_features", f"""WITH {FEATURES} SELECT datastream_id, target_variable, site_id, season, failure, longest_gap,
  CASE WHEN failure IS NULL THEN {rsql("list_sum(lags)", None, 4)} END AS lag_sum,
  CASE WHEN failure IS NULL THEN {rsql("lags[1]")} END AS lag_oldest,
  CASE WHEN failure IS NULL THEN {rsql("lags[168]")} END AS lag_newest FROM feat""")
def _(spark, sf_dir):
    f = features(spark, sf_dir)
    ok = F.col("failure").isNull()
    return f.select(
        "datastream_id", "target_variable", "site_id", "season", "failure", "longest_gap",
        F.when(ok, r(F.aggregate("lags", F.lit(0.0), lambda s, x: s + x), 4)).alias("lag_sum"),
        F.when(ok, r(F.element_at("lags", 1))).alias("lag_oldest"),
        F.when(ok, r(F.element_at("lags", -1))).alias("lag_newest"),
    )


@check("event_context", f"""WITH {FEATURES} SELECT datastream_id, {rsql("snow", "snow_depth_latest")},
  {rsql("air", "air_temp_avg_last_24h")}, {rsql("rain", "precip_avg_last_24h")} FROM feat WHERE target_variable = 'discharge'""")
def _(spark, sf_dir):
    names = ("snow_depth_latest", "air_temp_avg_last_24h", "precip_avg_last_24h")
    return features(spark, sf_dir).where("target_variable = 'discharge'").select(
        "datastream_id", *[r(n).alias(n) for n in names]
    )


@check("feature_failures", f"WITH {FEATURES} SELECT target_variable, coalesce(failure, 'ok') AS outcome, count(*) AS n FROM feat GROUP BY ALL")
def _(spark, sf_dir):
    return features(spark, sf_dir).groupBy(
        "target_variable", F.coalesce("failure", F.lit("ok")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("n"))


# A rate without a short decimal form: forecasts never lie on a rounding tie.
LIVE_CLIP = Clip(pct=0.0523598775598)
JSON_COLUMNS = ("site_id", "history_end_time", "forecast_start_time", "year", "month", "season", "lags")
FORECAST = f"""{FEATURES},
ready AS (SELECT *, lags[168] AS base, lags[168] - list_sum(lags) / 168 AS x,
            list_max([abs(lags[i + 1] - lags[i]) FOR i IN range(1, 168)]) AS top FROM feat WHERE failure IS NULL),
walk AS (
  WITH RECURSIVE w(datastream_id, horizon, v) AS (
    SELECT datastream_id, 0, base FROM ready
    UNION ALL
    SELECT w.datastream_id, w.horizon + 1,
      least(greatest(base + (b + (w.horizon + 1) / 10) + (a - (w.horizon + 1) / 97) * x,
                     v - greatest(2.0, 0.0523598775598 * abs(v), 1.5 * top)), v + greatest(2.0, 0.0523598775598 * abs(v), 1.5 * top))
    FROM w JOIN ready USING (datastream_id) WHERE w.horizon < 24)
  SELECT * FROM w WHERE horizon > 0),
pred AS (
  SELECT datastream_id AS source_datastream_id, 'season_specific' AS model_family, target_variable, site_id, season, season AS season_key,
    datetime_utc AS history_end_time, datetime_utc + INTERVAL 1 HOUR AS forecast_start_time, CAST(horizon AS INTEGER) AS horizon,
    CASE WHEN horizon <= 6 THEN '0-6' WHEN horizon <= 12 THEN '6-12' WHEN horizon <= 18 THEN '12-18' ELSE '18-24' END AS horizon_bin,
    datetime_utc + horizon * INTERVAL 1 HOUR AS target_timestamp, v AS prediction, model_path
  FROM walk JOIN ready USING (datastream_id))"""
PRED_COLUMNS = (
    "source_datastream_id, model_family, target_variable, site_id, season, season_key, history_end_time, "
    "forecast_start_time, horizon, horizon_bin, target_timestamp, model_path"
)


def forecasts(spark, sf_dir, json_columns=()):
    return live.forecast_rows(
        features(spark, sf_dir), live_registry(spark), LIVE_HORIZONS, LIVE_CLIP, json_columns=json_columns
    )


@check("predictions_long", f"WITH {FORECAST} SELECT {PRED_COLUMNS}, {rsql('prediction', 'prediction')} FROM pred")
def _(spark, sf_dir):
    return forecasts(spark, sf_dir).withColumn("prediction", r("prediction"))


# Every lag by its place, and the scalar fields.
@check("feature_json", f"""WITH {FORECAST} SELECT datastream_id AS source_datastream_id, site_id,
  strftime(datetime_utc, '%Y-%m-%d %H:%M:%S') AS history_end_time, strftime(datetime_utc + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS forecast_start_time,
  CAST(year(datetime_utc + INTERVAL 1 HOUR) AS INTEGER) AS year, CAST(month(datetime_utc + INTERVAL 1 HOUR) AS INTEGER) AS month, season,
  CAST(i AS INTEGER) AS place, {rsql("lags[i]", "lag")} FROM ready, range(1, 169) t(i)""")
def _(spark, sf_dir):
    rows = forecasts(spark, sf_dir, JSON_COLUMNS).where("horizon = 1")
    parsed = F.from_json(
        "feature_row_json",
        "site_id int, history_end_time string, forecast_start_time string, year int, month int, season string, lags array<double>",
    )
    return rows.withColumn("f", parsed).select(
        "source_datastream_id", "f.site_id", "f.history_end_time", "f.forecast_start_time", "f.year", "f.month", "f.season",
        F.posexplode("f.lags").alias("i", "v"),
    ).select("*", (F.col("i") + 1).alias("place"), r("v").alias("lag")).drop("i", "v")


# Forecasts of all events, then once more with a raised value for those of site 2: the later write wins.
@check("upsert", f"""WITH {FORECAST} SELECT {PRED_COLUMNS}, {rsql('prediction * CASE WHEN site_id = 2 THEN 1.0123456789 ELSE 1 END', 'prediction')}
FROM pred QUALIFY row_number() OVER (PARTITION BY model_family, target_variable, site_id, history_end_time, season_key, horizon
  ORDER BY source_datastream_id DESC) = 1""")
def _(spark, sf_dir):
    rows = stage(forecasts(spark, sf_dir))
    again = rows.where("site_id = 2").withColumn("prediction", F.col("prediction") * 1.0123456789)
    return live.upsert(live.upsert(rows.limit(0), rows), again).withColumn("prediction", r("prediction"))


@check("preview", f"WITH {FORECAST} SELECT target_variable, site_id, season, horizon, target_timestamp, {rsql('prediction', 'prediction')} "
       "FROM pred ORDER BY target_variable, site_id, source_datastream_id, horizon LIMIT 8")
def _(spark, sf_dir):
    return live.preview(forecasts(spark, sf_dir)).select(
        "target_variable", "site_id", "season", "horizon", "target_timestamp", r("prediction").alias("prediction")
    )


@check("predictions_of", f"WITH {FORECAST} SELECT source_datastream_id, horizon, {rsql('prediction', 'prediction')} FROM pred WHERE site_id = 3")
def _(spark, sf_dir):
    rows = stage(forecasts(spark, sf_dir))
    ids = events(spark, sf_dir).where("site_id = 3").select(F.col("datastream_id").alias("source_datastream_id"))
    return live.predictions_of(rows, ids).select("source_datastream_id", "horizon", r("prediction").alias("prediction"))


@check("completeness", f"""WITH {FORECAST} SELECT e.datastream_id AS source_datastream_id, count(p.horizon) AS n, count(p.horizon) < 24 AS incomplete
FROM (SELECT datastream_id FROM obs WHERE {ON_HOUR}) e LEFT JOIN pred p ON p.source_datastream_id = e.datastream_id GROUP BY ALL""")
def _(spark, sf_dir):
    ids = events(spark, sf_dir).where(on_grid("datetime_utc")).select(
        F.col("datastream_id").alias("source_datastream_id")
    )
    return live.completeness(ids, forecasts(spark, sf_dir))


# The registry is fitted from the data: targets and sites are those with enough samples.
@check("target_sites", f"""WITH {FITTED} SELECT DISTINCT 'discharge' AS target_variable, site_id, 'Discharge' AS variable_code FROM fitted""")
def _(spark, sf_dir):
    split = stage(usable_subsets(daily_split(spark, sf_dir)))
    fitted = linear_registry(fit_linear(split.where("part = 'train'")))
    return live.target_sites(fitted.withColumn("target_variable", F.lit("discharge")))


NEXT_ROWS = f"""combos AS (SELECT DISTINCT target_variable, site_id, CASE target_variable WHEN 'discharge' THEN 'Discharge' ELSE 'AirTemp' END AS variable_code FROM registry),
latest AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY site_id, variable_code ORDER BY datetime_utc DESC, datastream_id DESC) = 1),
nextrows AS (SELECT c.target_variable, l.site_id, l.variable_code, l.datetime_utc AS latest_timestamp, l.value AS latest_value,
  date_trunc('hour', l.datetime_utc) + INTERVAL 1 HOUR AS hypothetical_timestamp, l.value AS hypothetical_value
  FROM combos c JOIN latest l ON l.site_id = c.site_id AND l.variable_code = c.variable_code)"""


@check("next_hour_rows", f"WITH {OBS}, {REGISTRY}, {NEXT_ROWS} SELECT * FROM nextrows")
def _(spark, sf_dir):
    return live.next_hour_rows(observations(spark, sf_dir), live.target_sites(live_registry(spark)))


@check("insert_rows", f"""WITH {OBS}, {REGISTRY}, {NEXT_ROWS}
SELECT datastream_id, site_id, variable_code, datetime_utc, value FROM obs
UNION ALL SELECT (SELECT max(datastream_id) FROM obs) + row_number() OVER (ORDER BY md5(concat_ws('|', CAST(site_id AS VARCHAR), variable_code))),
  site_id, variable_code, hypothetical_timestamp, hypothetical_value FROM nextrows""")
def _(spark, sf_dir):
    facts = observations(spark, sf_dir).select("datastream_id", "site_id", "variable_code", "datetime_utc", "value")
    fresh = live.next_hour_rows(facts, live.target_sites(live_registry(spark))).select(
        "site_id", "variable_code",
        F.col("hypothetical_timestamp").alias("datetime_utc"), F.col("hypothetical_value").alias("value"),
    )
    return live.insert_rows(facts, fresh, ["site_id", "variable_code"])


@check("delete_keys", f"WITH {OBS} SELECT * FROM obs ANTI JOIN (SELECT datastream_id FROM obs WHERE {ON_HOUR}) USING (datastream_id)")
def _(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return live.delete_keys(obs, obs.where(on_grid("datetime_utc")), ["datastream_id"])


@check("delete_at_time", f"""WITH {OBS}, gone AS (SELECT DISTINCT site_id, variable_id, datetime_utc FROM obs WHERE {ON_HOUR} AND site_id = 2)
SELECT * FROM obs ANTI JOIN gone USING (site_id, variable_id, datetime_utc)""")
def _(spark, sf_dir):
    obs = observations(spark, sf_dir)
    gone = obs.where(on_grid("datetime_utc") & (F.col("site_id") == 2))
    return live.delete_keys(obs, gone, ["site_id", "variable_id", "datetime_utc"])


@check("history_forecast", f"""WITH {FORECAST},
hist_grid AS (SELECT datastream_id, target_variable, site_id, variable_code,
    unnest(generate_series(datetime_utc - INTERVAL 72 HOUR, datetime_utc, INTERVAL 1 HOUR)) AS datetime FROM ready),
hist AS (
  SELECT g.*, p.value AS observed,
    last_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
    last_value(CASE WHEN p.value IS NOT NULL THEN g.datetime END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
    first_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS v1,
    first_value(CASE WHEN p.value IS NOT NULL THEN g.datetime END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t1
  FROM hist_grid g LEFT JOIN points p USING (site_id, variable_code, datetime)
  WINDOW w AS (PARTITION BY g.datastream_id ORDER BY g.datetime))
SELECT datastream_id AS source_datastream_id, target_variable, site_id, datetime, {rsql(LINEAR, "value")}, 'history' AS kind FROM hist
UNION ALL SELECT source_datastream_id, target_variable, site_id, target_timestamp, {rsql("prediction", "value")}, 'forecast' FROM pred""")
def _(spark, sf_dir):
    rows = stage(forecasts(spark, sf_dir))
    out = live.history_and_forecast(rows, observations(spark, sf_dir), LIVE_TARGETS, 72, HOURLY)
    return out.withColumn("value", r("value"))
