"""Checks: preparation, models and evaluation on the daily samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import (
    DAILY,
    DAILY_SAMPLES,
    DAILY_SPEC,
    DAILY_SPLIT,
    FITTED,
    PREDICTED,
    daily_samples,
    daily_scored,
    daily_split,
    metric_sql,
    season_name_sql,
    table,
)
from checks.registry import check, r, rsql
from rillcast.config import Clip
from rillcast.functions.timeaxis import SEASONS, season_code
from rillcast.functions.vectors import (
    CYCLIC,
    SEASON_FLAGS,
    absolute,
    clipped,
    deltas,
    largest_step,
    newest,
    persistence,
)
from rillcast.operators import evaluate as ev
from rillcast.operators import models, prep
from rillcast.sources.staged import stage

L, H = DAILY_SPEC.lags, DAILY_SPEC.horizons
KEYS = ("site_id", "forecast_start_time")


def _steps(df, array, name, first=1):
    return df.select(*KEYS, F.posexplode(array).alias("_i", "_v")).select(
        *KEYS, (F.col("_i") + first).alias(name), F.col("_v").alias("value")
    )


# --- preparation ------------------------------------------------------------

@check("time_gate", """SELECT CAST(count(*) FILTER (WHERE ts IS NULL) AS BIGINT) AS history_end_time,
  CAST(count(*) FILTER (WHERE TRY_CAST(props AS TIMESTAMP) IS NULL) AS BIGINT) AS forecast_start_time,
  CAST(0 AS BIGINT) AS forecast_end_time FROM events""")
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return prep.time_problems(
        e.select(
            F.col("ts").cast("string").alias("history_end_time"),
            F.col("props").alias("forecast_start_time"),
            F.col("ts").alias("forecast_end_time"),
        )
    )


# Copies of an order line per (site, day) with a version that may be missing.
@check("dedup_newest", """WITH v AS (
  SELECT l_suppkey AS site_id, l_shipdate AS forecast_start_time, l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END AS data_version, l_tax AS source_mtime,
         concat(l_orderkey, '/', l_linenumber) AS source_path FROM lineitem)
SELECT site_id, forecast_start_time, l_orderkey, l_linenumber, data_version, source_mtime, source_path FROM v
QUALIFY row_number() OVER (PARTITION BY site_id, forecast_start_time
  ORDER BY data_version DESC NULLS FIRST, source_mtime DESC NULLS FIRST, source_path DESC) = 1""")
def _(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_suppkey").alias("site_id"),
        F.col("l_shipdate").alias("forecast_start_time"),
        "l_orderkey",
        "l_linenumber",
        F.lit(None).cast("double").alias("source_version"),
        F.when(F.col("l_returnflag") != "N", F.col("l_discount")).alias("data_version"),
        F.col("l_tax").alias("source_mtime"),
        F.concat("l_orderkey", F.lit("/"), "l_linenumber").alias("source_path"),
    )
    return prep.newest_wins(rows).drop("source_version")


@check("season_dummies", """SELECT o_orderkey, """ + ", ".join(
    f"CAST((month(o_orderdate) % 12) // 3 = {i} AS INTEGER) AS {f}" for i, f in enumerate(SEASON_FLAGS)
) + " FROM orders")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("season", season_code(F.month("o_orderdate")))
    return o.withColumns(prep.season_flag_columns("season")).select("o_orderkey", *SEASON_FLAGS)


# One priority has no season code, so every row falls back to the month.
@check("season_names", f"""SELECT o_orderkey, {season_name_sql("o_orderdate")} AS season_name FROM orders""")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("season", F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    return prep.with_season_name(o, "season", "o_orderdate").select("o_orderkey", "season_name")


_TF = {
    "hour_sin": "sin(2 * pi() * hour(t) / 24)", "hour_cos": "cos(2 * pi() * hour(t) / 24)",
    "dow_sin": "sin(2 * pi() * (isodow(t) - 1) / 7)", "dow_cos": "cos(2 * pi() * (isodow(t) - 1) / 7)",
    "month_sin": "sin(2 * pi() * (month(t) - 1) / 12)", "month_cos": "cos(2 * pi() * (month(t) - 1) / 12)",
    "day_of_year_frac": "dayofyear(t) / 366",
    **{f: f"CAST((month(t) % 12) // 3 = {i} AS DOUBLE)" for i, f in enumerate(SEASON_FLAGS)},
}


@check("time_features", f"""WITH {DAILY_SAMPLES}, s AS (
  SELECT site_id, forecast_start_time, CAST(k AS INTEGER) AS lag, history_end_time - (k - 1) * INTERVAL 1 DAY AS t
  FROM samples, range(1, 29) x(k))
SELECT site_id, forecast_start_time, lag, {", ".join(rsql(e, n) for n, e in _TF.items())} FROM s""")
def _(spark, sf_dir):
    s = prep.with_time_features(daily_samples(spark, sf_dir), L, DAILY)
    return s.select(*KEYS, F.posexplode("time_steps").alias("i", "f")).select(
        *KEYS, (F.lit(L) - F.col("i")).alias("lag"),
        *[r(F.col("f")[j]).alias(n) for j, n in enumerate((*CYCLIC, *SEASON_FLAGS))],
    )


# The form without season flags: seven features a step.
@check("time_features_plain", f"""WITH {DAILY_SAMPLES}, s AS (
  SELECT site_id, forecast_start_time, CAST(k AS INTEGER) AS lag, history_end_time - (k - 1) * INTERVAL 1 DAY AS t
  FROM samples, range(1, 29) x(k))
SELECT site_id, forecast_start_time, lag, CAST(7 AS INTEGER) AS width, {", ".join(rsql(_TF[n], n) for n in CYCLIC)} FROM s""")
def _(spark, sf_dir):
    s = prep.with_time_features(daily_samples(spark, sf_dir), L, DAILY, season_flags=False)
    return s.select(*KEYS, F.posexplode("time_steps").alias("i", "f")).select(
        *KEYS, (F.lit(L) - F.col("i")).alias("lag"), F.size("f").alias("width"), *[r(F.col("f")[j]).alias(n) for j, n in enumerate(CYCLIC)],
    )


@check("split_year", f"""WITH {DAILY_SPLIT} SELECT site_id, forecast_start_time, validation_start, validation_end, part FROM split""")
def _(spark, sf_dir):
    return daily_split(spark, sf_dir).select(*KEYS, "validation_start", "validation_end", "part")


@check("season_subsets", f"""WITH {DAILY_SPLIT} SELECT *, train_rows > 0 AND validation_rows > 0 AS usable FROM (
  SELECT site_id, season_name, count(*) FILTER (WHERE part = 'train') AS train_rows,
         count(*) FILTER (WHERE part = 'validation') AS validation_rows FROM split GROUP BY ALL)""")
def _(spark, sf_dir):
    return prep.season_subsets(daily_split(spark, sf_dir))


# Order prices per status, some missing, imputed with the median of finished orders.
@check("impute_median", f"""WITH o AS (
  SELECT o_orderkey, o_custkey % 25 AS site_id, CASE WHEN o_orderstatus = 'P' THEN 'validation' ELSE 'train' END AS part,
         CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_totalprice END AS price,
         CASE WHEN o_orderpriority LIKE '2%' THEN NULL ELSE length(o_orderpriority) END AS size FROM orders),
m AS (SELECT site_id, median(price) AS mp, median(size) AS ms FROM o WHERE part = 'train' GROUP BY site_id)
SELECT o_orderkey, site_id, part, {rsql("coalesce(price, mp, 0)", "price")}, {rsql("coalesce(CAST(size AS DOUBLE), ms, 0)", "size")}
FROM o LEFT JOIN m USING (site_id)""")
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 25).alias("site_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("validation")).otherwise(F.lit("train")).alias("part"),
        F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_totalprice")).alias("price"),
        F.when(~F.col("o_orderpriority").startswith("2"), F.length("o_orderpriority")).cast("string").alias("size"),
    )
    return prep.impute_static(o, ["price", "size"]).withColumns({"price": r("price"), "size": r("size")})


SCALERS = f"""{DAILY_SPLIT},
statics AS (SELECT *, CAST(month(forecast_start_time) AS DOUBLE) AS static_month FROM split),
parts AS (
  SELECT site_id, 'lag' AS block, unnest(lags) AS v FROM statics WHERE part = 'train'
  UNION ALL SELECT site_id, 'delta', unnest([y - base FOR y IN targets]) FROM statics WHERE part = 'train'
  UNION ALL SELECT site_id, 'static_month', static_month FROM statics WHERE part = 'train'),
scalers AS (SELECT site_id, block, avg(v) AS mean, stddev_pop(v) AS deviation FROM parts GROUP BY ALL)"""


def _statics(spark, sf_dir):
    return daily_split(spark, sf_dir).withColumn(
        "static_month", F.month("forecast_start_time").cast("double")
    )


def _scaled(spark, sf_dir):
    split = _statics(spark, sf_dir)
    scalers = prep.fit_scalers(split.where("part = 'train'"), ["static_month"])
    return prep.scale(split, scalers, ["static_month"])


@check("scaler_fit", f"""WITH {SCALERS} SELECT site_id, block, {rsql("mean", "mean")}, {rsql("deviation", "deviation")} FROM scalers""")
def _(spark, sf_dir):
    s = prep.fit_scalers(_statics(spark, sf_dir).where("part = 'train'"), ["static_month"])
    return s.withColumns({"mean": r("mean"), "deviation": r("deviation")})


SCALED = f"""{SCALERS},
sc AS (SELECT site_id, max(mean) FILTER (WHERE block = 'lag') AS lm, max(deviation) FILTER (WHERE block = 'lag') AS ls,
         max(mean) FILTER (WHERE block = 'delta') AS dm, max(deviation) FILTER (WHERE block = 'delta') AS ds,
         max(mean) FILTER (WHERE block = 'static_month') AS sm, max(deviation) FILTER (WHERE block = 'static_month') AS ss
       FROM scalers GROUP BY site_id)"""


@check("scaler_apply", f"""WITH {SCALED}
SELECT site_id, forecast_start_time, part, {rsql("list_sum([(v - lm) / ls FOR v IN lags])", "lag_sum", 4)},
  {rsql("(lags[28] - lm) / ls", "lag_newest")}, {rsql("(targets[7] - base - dm) / ds", "delta_last")},
  {rsql("(static_month - sm) / ss", "static_month")}
FROM statics JOIN sc USING (site_id)""")
def _(spark, sf_dir):
    return _scaled(spark, sf_dir).select(
        *KEYS, "part",
        r(F.aggregate("scaled_lags", F.lit(0.0), lambda s, x: s + x), 4).alias("lag_sum"),
        r(F.element_at("scaled_lags", -1)).alias("lag_newest"),
        r(F.element_at("scaled_deltas", -1)).alias("delta_last"),
        r(F.element_at("scaled_statics", 1)).alias("static_month"),
    )


@check("scaler_roundtrip", f"""WITH {DAILY_SPLIT} SELECT site_id, forecast_start_time, CAST(h AS INTEGER) AS horizon,
  {rsql("targets[h] - base", "value")} FROM split, range(1, 8) t(h)""")
def _(spark, sf_dir):
    s = _scaled(spark, sf_dir)
    back = prep.unscaled(F.col("scaled_deltas"), F.col("delta_mean"), F.col("delta_scale"))
    return _steps(s, back, "horizon").withColumn("value", r("value"))


@check("delta_targets", f"""WITH {DAILY_SAMPLES} SELECT site_id, forecast_start_time, CAST(h AS INTEGER) AS horizon,
  {rsql("targets[h] - lags[28]", "delta")}, {rsql("targets[h]", "absolute")} FROM samples, range(1, 8) t(h)""")
def _(spark, sf_dir):
    s = daily_samples(spark, sf_dir).withColumn("d", deltas())
    both = F.arrays_zip(F.col("d").alias("delta"), absolute(F.col("d"), newest()).alias("absolute"))
    return s.select(*KEYS, F.posexplode(both).alias("i", "v")).select(
        *KEYS, (F.col("i") + 1).alias("horizon"), r("v.delta").alias("delta"), r("v.absolute").alias("absolute")
    )


@check("persistence", f"""WITH {DAILY_SAMPLES} SELECT site_id, forecast_start_time, CAST(h AS INTEGER) AS horizon,
  lags[28] AS value FROM samples, range(1, 8) t(h)""")
def _(spark, sf_dir):
    return _steps(daily_samples(spark, sf_dir), persistence(H), "horizon")


TOP = "list_max([abs(lags[i + 1] - lags[i]) FOR i IN range(1, 28)])"


@check("max_change", f"""WITH {DAILY_SAMPLES} SELECT site_id, forecast_start_time, {rsql(TOP, "max_change")} FROM samples""")
def _(spark, sf_dir):
    return daily_samples(spark, sf_dir).select(*KEYS, r(largest_step()).alias("max_change"))


# The observed targets themselves are clipped: big real moves get cut.
@check("clip", f"""WITH {DAILY_SAMPLES},
p AS (SELECT site_id, forecast_start_time, lags[28] AS base, targets, {TOP} AS top FROM samples),
walk AS (
  WITH RECURSIVE w(site_id, forecast_start_time, targets, top, horizon, v) AS (
    SELECT site_id, forecast_start_time, targets, top, 0, base FROM p
    UNION ALL
    SELECT site_id, forecast_start_time, targets, top, horizon + 1,
      least(greatest(targets[horizon + 1], v - greatest(2.0, 0.05 * abs(v), 0.25 * top)),
            v + greatest(2.0, 0.05 * abs(v), 0.25 * top)) FROM w WHERE horizon < 7)
  SELECT * FROM w WHERE horizon > 0)
SELECT site_id, forecast_start_time, CAST(horizon AS INTEGER) AS horizon, {rsql("v", "value")} FROM walk""")
def _(spark, sf_dir):
    limit = Clip(multiplier=0.25)
    out = clipped(F.col("targets"), newest(), largest_step(), limit)
    return _steps(daily_samples(spark, sf_dir), out, "horizon").withColumn("value", r("value"))


def _design(spark, sf_dir):
    return prep.design_vector(prep.with_time_features(_scaled(spark, sf_dir), L, DAILY))


def _step_features(k):
    """Time features of the step ``k`` days before the newest, as an SQL list."""
    return "[" + ", ".join(e.replace("(t)", f"(history_end_time - CAST({k} AS INTEGER) * INTERVAL 1 DAY)") for e in _TF.values()) + "]"


# Every cell with its place: features in another order would not pass.
@check("design_matrix", f"""WITH {SCALED},
flat AS (SELECT site_id, forecast_start_time, list_concat([(v - lm) / ls FOR v IN lags],
    flatten([{_step_features("k")} FOR k IN range(27, -1, -1)]), [(static_month - sm) / ss]) AS cells
  FROM statics JOIN sc USING (site_id))
SELECT site_id, forecast_start_time, CAST(i AS INTEGER) AS place, {rsql("cells[i]", "value")} FROM flat, range(1, {28 + 28 * 11 + 2}) t(i)""")
def _(spark, sf_dir):
    cells = _design(spark, sf_dir).select(*KEYS, F.posexplode("features").alias("i", "v"))
    return cells.select(*KEYS, (F.col("i") + 1).alias("place"), r("v").alias("value"))


@check("sequence_matrix", f"""WITH {SCALED},
flat AS (SELECT site_id, forecast_start_time, k AS step, list_concat([(lags[28 - k] - lm) / ls], {_step_features("k")}, [(static_month - sm) / ss]) AS cells
  FROM statics JOIN sc USING (site_id), range(0, 28) t(k))
SELECT site_id, forecast_start_time, CAST(28 - step AS INTEGER) AS step, CAST(i AS INTEGER) AS place, {rsql("cells[i]", "value")}
FROM flat, range(1, 14) u(i)""")
def _(spark, sf_dir):
    s = prep.sequence_matrix(prep.with_time_features(_scaled(spark, sf_dir), L, DAILY))
    steps = s.select(*KEYS, F.posexplode("sequence").alias("k", "cells"))
    return steps.select(*KEYS, (F.col("k") + 1).alias("step"), F.posexplode("cells").alias("i", "v")).select(
        *KEYS, "step", (F.col("i") + 1).alias("place"), r("v").alias("value")
    )


# --- models -----------------------------------------------------------------

@check("linear_fit", f"""WITH {FITTED} SELECT site_id, season_name, CAST(horizon AS INTEGER) AS horizon, n,
  {rsql("slope", "slope")}, {rsql("intercept", "intercept")} FROM fitted""")
def _(spark, sf_dir):
    split = prep.usable_subsets(daily_split(spark, sf_dir))
    fitted = models.fit_linear(split.where("part = 'train'"))
    return fitted.withColumns({"slope": r("slope"), "intercept": r("intercept")})


LONG_COLUMNS = ("y_true", "y_pred", "y_pred_unclipped", "y_persistence")


def _long(spark, sf_dir, season_by="target"):
    return ev.expand(daily_scored(spark, sf_dir), DAILY, season_by)


@check("linear_score", f"""WITH {PREDICTED} SELECT site_id, forecast_start_time, horizon,
  {rsql("y_pred", "y_pred")}, {rsql("y_pred_unclipped", "y_pred_unclipped")} FROM long""")
def _(spark, sf_dir):
    return _long(spark, sf_dir).select(
        *KEYS, "horizon", r("y_pred").alias("y_pred"), r("y_pred_unclipped").alias("y_pred_unclipped")
    )


@check("udf_score", f"""WITH {DAILY_SAMPLES} SELECT site_id, forecast_start_time, CAST(h AS INTEGER) AS horizon,
  {rsql("lags[28] + h * (lags[28] - list_sum(lags) / 28) / -10", "y_pred_unclipped")} FROM samples, range(1, 8) t(h)""")
def _(spark, sf_dir):
    def drift(x):
        import numpy as np

        away = x[:, -1] - x.mean(axis=1)
        return -0.1 * away[:, None] * np.arange(1, H + 1)[None, :]

    s = models.score_with(daily_samples(spark, sf_dir), drift, "lags", H)
    return _steps(s, F.col("y_pred_unclipped"), "horizon").select(
        *KEYS, "horizon", r("value").alias("y_pred_unclipped")
    )


# A fit can't be repeated in SQL; what must hold can: every validation sample is forecast at every horizon, at its own
# target time, with finite values no further from the step before than the clip allows.
@check("gbt_fit", f"""WITH {FITTED} SELECT site_id, season_name, CAST(h AS INTEGER) AS horizon, count(*) AS n,
  min(forecast_start_time + (h - 1) * INTERVAL 1 DAY) AS first_target, count(*) AS n_finite, count(*) AS n_in_reach
FROM split SEMI JOIN usable USING (site_id, season_name), range(1, 8) t(h) WHERE part = 'validation' GROUP BY ALL""")
def _(spark, sf_dir):
    horizons = range(1, H + 1)
    data = stage(prep.usable_subsets(_design(spark, sf_dir)))
    model = models.fit_boosted(data.where("part = 'train'"), horizons)
    scored = models.score_boosted(data.where("part = 'validation'"), model, horizons)
    before = F.concat(F.array(newest()), F.slice("y_pred", 1, H - 1))
    clip = Clip()
    room = F.zip_with("y_pred", before, lambda y, b: F.abs(y - b) <= 1e-9 + F.greatest(
        F.lit(clip.floor), clip.pct * F.abs(b), clip.multiplier * largest_step()))
    scored = scored.withColumn("season_name", F.col("season_name")).withColumn("_room", room)
    long = scored.select(*KEYS, "season_name", F.posexplode(F.arrays_zip("y_pred", "y_true", "_room")).alias("_i", "v")).select(
        *KEYS, "season_name", (F.col("_i") + 1).alias("horizon"), "v.*")
    expanded = ev.expand(scored, DAILY, "start", strict=False, horizons=list(horizons)).select(*KEYS, "horizon", "target_timestamp")
    return long.join(expanded, [*KEYS, "horizon"]).groupBy("site_id", "season_name", "horizon").agg(
        F.count(F.lit(1)).alias("n"), F.min("target_timestamp").alias("first_target"),
        F.count_if(F.col("y_pred").isNotNull() & ~F.isnan("y_pred") & (F.abs("y_pred") < 1e300)).alias("n_finite"),
        F.count_if("_room").alias("n_in_reach"),
    )


# One tree of one split without sampling has an exact best split: month, site or horizon, by least squares.
@check("gbt_stump", f"""WITH {FITTED},
cases AS (SELECT CAST(month(forecast_start_time) AS DOUBLE) AS month, CAST(site_id AS DOUBLE) AS site, CAST(h AS DOUBLE) AS horizon,
    targets[h] - base AS y FROM split SEMI JOIN usable USING (site_id, season_name), range(1, 8) t(h) WHERE part = 'train'),
cells AS (SELECT month, site, horizon, f.feature, f.x, y FROM cases, LATERAL (VALUES ('month', month), ('site', site), ('horizon', horizon)) f(feature, x)),
cuts AS (SELECT DISTINCT feature, x AS cut FROM cells),
scores AS (
  SELECT feature, cut, count(*) FILTER (WHERE x <= cut) AS nl, count(*) FILTER (WHERE x > cut) AS nr,
         sum(y) FILTER (WHERE x <= cut) AS sl, sum(y) FILTER (WHERE x > cut) AS sr
  FROM cells JOIN cuts USING (feature) GROUP BY ALL HAVING count(*) FILTER (WHERE x > cut) > 0),
best AS (SELECT * FROM scores ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
SELECT DISTINCT month, site, horizon, {rsql("CASE WHEN x <= cut THEN sl / nl ELSE sr / nr END", "prediction")} FROM cells JOIN best USING (feature)""")
def _(spark, sf_dir):
    split = stage(prep.usable_subsets(daily_split(spark, sf_dir)).withColumns(
        {"months": F.array(F.month("forecast_start_time").cast("double")), "d": deltas()}))
    train = split.where("part = 'train'")
    model = models.fit_boosted(train, range(1, H + 1), trees=1, depth=1, subsample=1.0, label="d", features="months")
    cases = models.pooled_rows(train, range(1, H + 1), "months").select(
        F.element_at("months", 1).alias("month"), F.col("site_id").cast("double").alias("site"),
        F.col("horizon").cast("double").alias("horizon"), "_vector").distinct()
    return model.transform(cases).select("month", "site", "horizon", r("prediction").alias("prediction"))


@check("run_summary", f"""WITH {PREDICTED} SELECT site_id, train_rows, validation_rows, validation_start, validation_end,
  {", ".join(rsql(c, c, 4) for c in ("rmse", "mae", "persistence_rmse", "persistence_mae",
                                      "rmse_skill_vs_persistence", "mae_skill_vs_persistence"))}
FROM (SELECT site_id, count(*) FILTER (WHERE part = 'train') AS train_rows, count(*) FILTER (WHERE part = 'validation') AS validation_rows,
        min(validation_start) AS validation_start, max(validation_end) AS validation_end FROM split GROUP BY site_id)
JOIN {metric_sql("site_id")} USING (site_id)""")
def _(spark, sf_dir):
    split = stage(prep.usable_subsets(daily_split(spark, sf_dir)))
    registry = models.linear_registry(models.fit_linear(split.where("part = 'train'")))
    scored = models.score_linear(split.where("part = 'validation'"), registry, H)
    out = ev.run_summary(scored, split, ("site_id",), DAILY)
    return _rounded(out)


# --- evaluation -------------------------------------------------------------

MEASURES = ("rmse", "mae", "persistence_rmse", "persistence_mae",
            "rmse_skill_vs_persistence", "mae_skill_vs_persistence")
SHORT = ("rmse", "mae", "rmse_skill_vs_persistence", "mae_skill_vs_persistence")


def _rounded(df, measures=MEASURES):
    return df.withColumns({c: r(c, 4) for c in measures if c in df.columns})


def _measure_sql(measures=MEASURES):
    return ", ".join(rsql(c, c, 4) for c in measures)


@check("expand_long", f"""WITH {PREDICTED} SELECT site_id, forecast_start_time, horizon, horizon_bin, target_timestamp, season,
  {", ".join(rsql(c, c) for c in LONG_COLUMNS)} FROM long""")
def _(spark, sf_dir):
    return _long(spark, sf_dir).withColumns({c: r(c) for c in LONG_COLUMNS})


@check("expand_by_start", f"""WITH {PREDICTED} SELECT 'discharge' AS target_variable, site_id, forecast_start_time, horizon,
  season_name AS season, {rsql("y_true", "y_true")}, {rsql("y_pred", "y_pred")} FROM long""")
def _(spark, sf_dir):
    scored = daily_scored(spark, sf_dir).withColumn("target_variable", F.lit("discharge"))
    return ev.expand(scored, DAILY, "start", ("target_variable",)).select(
        "target_variable", *KEYS, "horizon", "season", r("y_true").alias("y_true"), r("y_pred").alias("y_pred")
    )


@check("overall_metrics", f"WITH {PREDICTED} SELECT n, {_measure_sql()} FROM {metric_sql('')}")
def _(spark, sf_dir):
    return _rounded(ev.metrics(_long(spark, sf_dir)))


@check("season_metrics", f"WITH {PREDICTED} SELECT site_id, season, {_measure_sql()} FROM {metric_sql('site_id, season')}")
def _(spark, sf_dir):
    return _rounded(ev.in_logical_order(ev.season_metrics(_long(spark, sf_dir))))


@check("horizon_metrics", f"""WITH {PREDICTED} SELECT site_id, season, horizon_bin, n, {_measure_sql()}
  FROM {metric_sql('site_id, season, horizon_bin')}""")
def _(spark, sf_dir):
    return _rounded(ev.in_logical_order(ev.horizon_metrics(_long(spark, sf_dir))))


@check("generic_metrics", f"""WITH {PREDICTED} SELECT season_name AS season, horizon_bin, n, {_measure_sql(SHORT)}
  FROM {metric_sql('season_name, horizon_bin')}""")
def _(spark, sf_dir):
    long = _long(spark, sf_dir, "start")
    return _rounded(ev.in_logical_order(ev.generic_metrics(long, ("season", "horizon_bin"))))


# The second "variable" is the unclipped forecast of the same samples.
RAW_LONG = "(SELECT * REPLACE (y_pred_unclipped AS y_pred) FROM long)"


@check("combine_metrics", f"""WITH {PREDICTED}
SELECT 'discharge' AS target_variable, site_id, season, horizon_bin, n, {_measure_sql(SHORT)} FROM {metric_sql('site_id, season, horizon_bin')}
UNION ALL
SELECT 'discharge_raw', site_id, season, horizon_bin, n, {_measure_sql(SHORT)} FROM {metric_sql('site_id, season, horizon_bin', RAW_LONG)}""")
def _(spark, sf_dir):
    long = stage(_long(spark, sf_dir))
    raw = long.withColumn("y_pred", F.col("y_pred_unclipped"))
    keys = ("site_id", "season", "horizon_bin")
    both = ev.combine({"discharge": ev.generic_metrics(long, keys), "discharge_raw": ev.generic_metrics(raw, keys)})
    return _rounded(both, SHORT)


@check("stack_models", f"""WITH {PREDICTED}
SELECT site_id, season, {rsql("rmse", "rmse", 4)}, {rsql("mae", "mae", 4)}, 'linear' AS model,
  concat(upper(season[1]), season[2:]) AS season_label FROM {metric_sql('site_id, season')}
UNION ALL
SELECT site_id, season, {rsql("persistence_rmse", "rmse", 4)}, {rsql("persistence_mae", "mae", 4)}, 'persistence',
  concat(upper(season[1]), season[2:]) FROM {metric_sql('site_id, season')}""")
def _(spark, sf_dir):
    m = stage(ev.season_metrics(_long(spark, sf_dir)))
    out = ev.stack_models({"linear": m, "persistence": _baseline(m)}, ("site_id", "season", "rmse", "mae"))
    return _rounded(out, ("rmse", "mae"))


COMPARED = f"""{PREDICTED},
compared AS (SELECT site_id, season, rmse AS rmse_linear, mae AS mae_linear, persistence_rmse AS rmse_persistence,
  persistence_mae AS mae_persistence, 100 * (persistence_rmse - rmse) / persistence_rmse AS rmse_improvement_pct,
  100 * (persistence_mae - mae) / persistence_mae AS mae_improvement_pct FROM {metric_sql('site_id, season')})"""
COMPARED_COLUMNS = ("rmse_linear", "mae_linear", "rmse_persistence", "mae_persistence",
                    "rmse_improvement_pct", "mae_improvement_pct")


def _baseline(m):
    return m.select(
        "site_id", "season", F.col("persistence_rmse").alias("rmse"), F.col("persistence_mae").alias("mae")
    )


def _compared(spark, sf_dir):
    m = stage(ev.season_metrics(_long(spark, sf_dir)))
    return ev.compare_models(m, _baseline(m), ("linear", "persistence"))


@check("model_compare", f"WITH {COMPARED} SELECT site_id, season, {', '.join(rsql(c, c, 4) for c in COMPARED_COLUMNS)} FROM compared")
def _(spark, sf_dir):
    return _rounded(_compared(spark, sf_dir), COMPARED_COLUMNS)


def _pivot_sql(value):
    return ", ".join(f"round(max({value}) FILTER (WHERE season = '{s}'), 4) + 0.0 AS {s}" for s in SEASONS)


@check("pivot_improvement", f"WITH {COMPARED} SELECT site_id, {_pivot_sql('rmse_improvement_pct')} FROM compared GROUP BY site_id")
def _(spark, sf_dir):
    return _rounded(ev.pivot_seasons(_compared(spark, sf_dir), "site_id", "rmse_improvement_pct"), SEASONS)


@check("pivot_rmse", f"""WITH {PREDICTED}, m AS (SELECT * FROM {metric_sql('site_id, season, horizon_bin')}),
frame AS (SELECT DISTINCT site_id, b AS horizon_bin FROM m, (VALUES ('0-6'), ('6-12'), ('12-18'), ('18-24')) t(b))
SELECT site_id, horizon_bin, {_pivot_sql('rmse')} FROM frame LEFT JOIN m USING (site_id, horizon_bin) GROUP BY ALL""")
def _(spark, sf_dir):
    return _rounded(ev.pivot_bins(ev.horizon_metrics(_long(spark, sf_dir)), "rmse"), SEASONS)


@check("pivot_range", f"""WITH {PREDICTED} SELECT round(min(rmse), 4) AS vmin, round(max(rmse), 4) AS vmax
  FROM {metric_sql('site_id, season, horizon_bin')}""")
def _(spark, sf_dir):
    return _rounded(ev.value_range(ev.horizon_metrics(_long(spark, sf_dir)), "rmse"), ("vmin", "vmax"))


@check("strict_season", f"WITH {PREDICTED} SELECT site_id, season, n, {_measure_sql(SHORT)} FROM {metric_sql('site_id, season')}")
def _(spark, sf_dir):
    long = ev.by_target_season(_long(spark, sf_dir, "start"))
    return _rounded(ev.in_logical_order(ev.generic_metrics(long, ("site_id", "season"))))
