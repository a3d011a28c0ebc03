"""Sensor tables derived from the driver's tables, as DataFrames and as SQL.

Events become hourly observations (five event types, five series), line items
become daily observations and, joined with their orders, parts and customers,
flat staging rows. Every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.config import DAY, Feature, Grid, SampleSpec, Target
from rillcast.functions.timeaxis import SEASONS
from rillcast.operators.models import fit_linear, linear_registry, score_linear
from rillcast.operators.normalize import META_COLUMNS
from rillcast.operators.prep import trailing_year_split, usable_subsets, with_season_name
from rillcast.operators.scan import literal_rows
from rillcast.plans.training import training_samples
from rillcast.sources.staged import stage

HOURLY = Grid()
DAILY = Grid(step=DAY)
DAILY_SPEC = SampleSpec(lags=28, horizons=7)
DAILY_TARGET = Target("discharge", (3, 4), (Feature("discharge", ("Discharge",)),))
AIR_TARGET = Target("air_temperature", (2,), (Feature("air_temp", ("AirTemp",), allow_negative=True),))

# Event type → site, variable code, variable id, value offset.
MAPPING = {
    "purchase": (3, "Discharge", 1, 5.0),
    "signup": (4, "Discharge", 1, 5.0),
    "view": (2, "AirTemp", 2, 50.0),
    "click": (2, "Precip", 3, 0.0),
    "error": (1, "SnowDepth", 4, 0.0),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("datastream_id"),
        F.when(F.col("event_id") % 10 == 0, exact).otherwise(F.col("ts")).alias("datetime_utc"),
        F.expr(_case(0)).alias("site_id"),
        F.expr(_case(1)).alias("variable_code"),
        F.expr(_case(2)).alias("variable_id"),
        (F.col("value") - F.expr(_case(3)).cast("double")).alias("value"),
    )


def _case(i: int) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return "CASE event_type " + " ".join(
        f"WHEN '{e}' THEN {text(row[i])}" for e, row in MAPPING.items()
    ) + " END"


OBS = f"""obs AS (
  SELECT event_id AS datastream_id,
         CASE WHEN event_id % 10 = 0 THEN date_trunc('hour', ts) ELSE ts END AS datetime_utc,
         {_case(0)} AS site_id, {_case(1)} AS variable_code, {_case(2)} AS variable_id,
         value - {_case(3)} AS value
  FROM events)"""

CEIL_HOUR = """CASE WHEN date_trunc('hour', datetime_utc) = datetime_utc THEN datetime_utc
  ELSE date_trunc('hour', datetime_utc) + INTERVAL 1 HOUR END"""

POINTS = f"""{OBS},
clean AS (
  SELECT *, CASE WHEN variable_code <> 'AirTemp' AND value < 0 THEN NULL ELSE value END AS v,
         {CEIL_HOUR} AS datetime
  FROM obs),
points AS (
  SELECT site_id, variable_code, datetime, v AS value FROM clean WHERE v IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY site_id, variable_code, datetime
                             ORDER BY datetime_utc DESC, variable_id DESC, datastream_id DESC) = 1)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_suppkey") % 2 + 3).cast("int").alias("site_id"),
            F.col("l_shipdate").alias("datetime_utc"),
        )
        .agg(F.sum("l_quantity").alias("value"))
        .select("site_id", F.lit("Discharge").alias("variable_code"), F.lit(1).alias("variable_id"),
                "datetime_utc", "value")
    )


DAILY_POINTS = """points AS (
  SELECT CAST(l_suppkey % 2 + 3 AS INTEGER) AS site_id, l_shipdate AS datetime, sum(l_quantity) AS value
  FROM lineitem GROUP BY ALL)"""


def daily_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_samples(daily(spark, sf_dir), DAILY_TARGET, DAILY, DAILY_SPEC)


def steps(first: str, until: str, by: str) -> str:
    return f"unnest(generate_series({first}, {until}, INTERVAL {by}))"


def grid_sql(by: str = "1 HOUR", keys: str = "site_id, variable_code") -> str:
    """Dense rows per series with previous and next observed point."""
    return f"""ends AS (SELECT {keys}, min(datetime) AS lo, max(datetime) AS hi FROM points GROUP BY {keys}),
grid AS (SELECT {keys}, lo, hi, {steps("lo", "hi", by)} AS datetime FROM ends),
dense AS (
  SELECT g.*, p.value AS observed,
         row_number() OVER w - 1 AS idx,
         last_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
         last_value(p.datetime IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0,
         first_value(p.value IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS v1,
         first_value(p.datetime IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS t1
  FROM grid g LEFT JOIN points p USING ({keys}, datetime)
  WINDOW w AS (PARTITION BY {", ".join("g." + k for k in keys.split(", "))} ORDER BY datetime))"""


LINEAR = "coalesce(v0 + (v1 - v0) * (epoch(datetime) - epoch(t0)) / (epoch(t1) - epoch(t0)), v0, v1)"


def bounded_sql(hour: str = "3600") -> str:
    """Three steps of interpolation, then three forward, then three backward."""
    p = f"(epoch(datetime) - epoch(t0)) / {hour}"
    left = f"(epoch(t1) - epoch(datetime)) / {hour}"
    return f"""CASE WHEN observed IS NOT NULL THEN observed
  WHEN v0 IS NOT NULL AND {p} <= 6
    THEN coalesce(v0 + (v1 - v0) * least({p}, 3) * {hour} / (epoch(t1) - epoch(t0)), v0)
  WHEN v1 IS NOT NULL AND {left} <= 3 THEN v1 END"""


def samples_sql(lags: int, horizons: int, by: str, grid: str, main: str = "observed",
                flags: str = "observed IS NULL", gap: int = 10, stride: int = 6,
                dense_months: str = "3,4,5,6", extra: str = "", keys: str = "site_id") -> str:
    """Accepted samples by stepping through the grid one visit at a time.

    ``grid`` names a CTE with keys, idx, datetime, value, ``main`` (unfilled).
    """
    return f"""sized AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n FROM {grid}),
visits AS (
  WITH RECURSIVE walk(k, idx) AS (
    SELECT DISTINCT {keys}, CAST({lags} AS BIGINT) FROM sized WHERE n > {lags}
    UNION ALL
    SELECT w.k, w.idx + CASE WHEN month(s.datetime) IN ({dense_months}) THEN 1 ELSE {stride} END
    FROM walk w JOIN sized s ON s.{keys} = w.k AND s.idx = w.idx
    WHERE w.idx <= s.n - {horizons})
  SELECT k AS {keys}, idx FROM walk),
runs AS (
  SELECT {keys}, idx,
         idx - coalesce(max(CASE WHEN NOT ({flags}) THEN idx END) OVER (
           PARTITION BY {keys} ORDER BY idx ROWS UNBOUNDED PRECEDING), -1) AS run
  FROM sized),
starts AS (
  SELECT s.* FROM sized s JOIN visits v USING ({keys}, idx)
  WHERE s.idx <= s.n - {horizons}
    AND NOT EXISTS (SELECT 1 FROM sized f WHERE f.{keys} = s.{keys}
                    AND f.idx BETWEEN s.idx AND s.idx + {horizons - 1} AND f.{main} IS NULL)
    AND NOT EXISTS (SELECT 1 FROM runs b WHERE b.{keys} = s.{keys} AND b.run >= {gap}
                    AND b.idx BETWEEN s.idx - {lags} + {gap - 1} AND s.idx + {horizons - 1})
    {extra}),
lagged AS (
  SELECT s.{keys}, s.idx, s.datetime AS forecast_start_time,
         list(g.value ORDER BY g.idx) FILTER (WHERE g.idx < s.idx) AS lags,
         list(g.{main} ORDER BY g.idx) FILTER (WHERE g.idx >= s.idx) AS targets
  FROM starts s JOIN sized g ON g.{keys} = s.{keys} AND g.idx BETWEEN s.idx - {lags} AND s.idx + {horizons - 1}
  GROUP BY ALL)"""


CALENDAR = """CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month,
  CAST(day({t}) AS INTEGER) AS day, CAST(hour({t}) AS INTEGER) AS hour,
  CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear({t}) AS INTEGER) AS day_of_year,
  CAST((month({t}) % 12) // 3 AS INTEGER) AS season"""


def season_name_sql(t: str) -> str:
    return f"(['winter','spring','summer','fall'])[CAST((month({t}) % 12) // 3 AS INTEGER) + 1]"


DAILY_DENSE = f"""{DAILY_POINTS},
{grid_sql("1 DAY", "site_id")},
filled AS (SELECT *, {LINEAR} AS value FROM dense)"""
DAILY_SAMPLES = f"""{DAILY_DENSE},
{samples_sql(28, 7, "1 DAY", "filled")},
samples AS (
  SELECT site_id, idx, forecast_start_time - INTERVAL 1 DAY AS history_end_time, forecast_start_time,
         forecast_start_time + INTERVAL 6 DAY AS forecast_end_time, lags, targets
  FROM lagged)"""


# --- split, model and long predictions on the daily samples -----------------

def daily_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = stage(daily_samples(spark, sf_dir))
    return trailing_year_split(with_season_name(samples), DAILY)


def daily_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation forecasts of the per-season linear models."""
    split = stage(usable_subsets(daily_split(spark, sf_dir)))
    models = linear_registry(fit_linear(split.where("part = 'train'")))
    return score_linear(split.where("part = 'validation'"), models, DAILY_SPEC.horizons)


DAILY_SPLIT = f"""{DAILY_SAMPLES},
ranges AS (
  SELECT site_id, max(forecast_end_time) AS validation_end,
         max(forecast_end_time) - INTERVAL 1 YEAR + INTERVAL 1 DAY AS validation_start
  FROM samples GROUP BY site_id),
split AS (
  SELECT s.*, validation_start, validation_end, {season_name_sql("forecast_start_time")} AS season_name,
         CASE WHEN forecast_end_time < validation_start THEN 'train' ELSE 'validation' END AS part,
         lags[28] AS base, lags[28] - list_sum(lags) / 28 AS x
  FROM samples s JOIN ranges USING (site_id)
  WHERE forecast_end_time < validation_start OR forecast_start_time >= validation_start),
usable AS (
  SELECT site_id, season_name FROM split GROUP BY ALL
  HAVING count(*) FILTER (WHERE part = 'train') > 0 AND count(*) FILTER (WHERE part = 'validation') > 0)"""

FITTED = f"""{DAILY_SPLIT},
train_long AS (
  SELECT site_id, season_name, x, h AS horizon, targets[h] - base AS y
  FROM split SEMI JOIN usable USING (site_id, season_name), range(1, 8) t(h) WHERE part = 'train'),
fitted AS (
  SELECT site_id, season_name, horizon, count(*) AS n,
         CASE WHEN var_pop(x) = 0 THEN 0 ELSE regr_slope(y, x) END AS slope,
         CASE WHEN var_pop(x) = 0 THEN avg(y) ELSE regr_intercept(y, x) END AS intercept
  FROM train_long GROUP BY ALL)"""

PREDICTED = f"""{FITTED},
raw_pred AS (
  SELECT s.site_id, s.season_name, s.forecast_start_time, f.horizon, s.base,
         s.targets[f.horizon] AS y_true, s.base + (f.intercept + f.slope * s.x) AS y_pred_unclipped,
         list_max([abs(s.lags[i + 1] - s.lags[i]) FOR i IN range(1, 28)]) AS top
  FROM split s JOIN fitted f USING (site_id, season_name) WHERE s.part = 'validation'),
clip_walk AS (
  WITH RECURSIVE w(site_id, season_name, forecast_start_time, horizon, y_pred) AS (
    SELECT site_id, season_name, forecast_start_time, 0, base FROM raw_pred WHERE horizon = 1
    UNION ALL
    SELECT w.site_id, w.season_name, w.forecast_start_time, p.horizon,
           least(greatest(p.y_pred_unclipped, w.y_pred - greatest(2.0, 0.05 * abs(w.y_pred), 1.5 * p.top)),
                 w.y_pred + greatest(2.0, 0.05 * abs(w.y_pred), 1.5 * p.top))
    FROM w JOIN raw_pred p ON p.site_id = w.site_id AND p.forecast_start_time = w.forecast_start_time
                          AND p.horizon = w.horizon + 1)
  SELECT * FROM w WHERE horizon > 0),
long AS (
  SELECT p.site_id, p.season_name, p.forecast_start_time, CAST(p.horizon AS INTEGER) AS horizon,
         CASE WHEN p.horizon <= 6 THEN '0-6' ELSE '6-12' END AS horizon_bin,
         p.forecast_start_time + (p.horizon - 1) * INTERVAL 1 DAY AS target_timestamp,
         y_true, y_pred, y_pred_unclipped, base AS y_persistence,
         {season_name_sql("(p.forecast_start_time + (p.horizon - 1) * INTERVAL 1 DAY)")} AS season
  FROM raw_pred p JOIN clip_walk c USING (site_id, forecast_start_time, horizon))"""

ERRORS = """count(*) AS n, sqrt(avg((y_true - y_pred) ** 2)) AS rmse, avg(abs(y_true - y_pred)) AS mae,
  sqrt(avg((y_true - y_persistence) ** 2)) AS persistence_rmse,
  avg(abs(y_true - y_persistence)) AS persistence_mae"""


def metric_sql(keys: str, source: str = "long") -> str:
    return f"""(SELECT *, CASE WHEN persistence_rmse > 0 THEN 1 - rmse / persistence_rmse END AS rmse_skill_vs_persistence,
  CASE WHEN persistence_mae > 0 THEN 1 - mae / persistence_mae END AS mae_skill_vs_persistence
  FROM (SELECT {keys + ', ' if keys else ''}{ERRORS} FROM {source} {'GROUP BY ALL' if keys else ''}))"""


# --- staging rows -----------------------------------------------------------

STAGING_COLUMNS = META_COLUMNS
STAGING_EXPR = {
    "owner_name": "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END",
    "contact_email": "concat(lower(c_mktsegment), '@example.org')",
    "site_code": "n_name",
    "site_name": "concat('Site ', n_name)",
    "site_description": "c_mktsegment",
    "site_type": "'Stream'",
    "state": "r_name",
    "variable_name": "concat('Flow ', p_type)",
    "variable_type": "'Hydrology'",
    "variable_code": "p_type",
    "unit_name": "CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'Brand#1' ELSE p_brand END",
    "unit_symbol": "p_brand",
    "method_name": "concat('Method ', l_returnflag)",
    "method_code": "l_returnflag",
    "processing_level_code": "l_linestatus",
    "qualifier_code": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END",
}
_DOUBLES = {"latitude", "longitude", "elevation_m"}


def _staging_select() -> str:
    parts = []
    for c in STAGING_COLUMNS:
        kind = "DOUBLE" if c in _DOUBLES else None
        expr = STAGING_EXPR.get(c)
        if expr is None:
            expr = f"CAST(NULL AS {kind or 'VARCHAR(255)'})"
        parts.append(f"{expr} AS {c}")
    return ",\n  ".join(parts)


STAGING_BODY = f"""SELECT l_orderkey * 10 + l_linenumber AS staging_id,
  {_staging_select()},
  l_shipdate AS datetime_utc, l_quantity AS value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey"""
STAGING = f"staging AS ({STAGING_BODY})"
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")


def staging(spark: SparkSession, sf_dir: str, spread=lambda lines: lines) -> DataFrame:
    """Flat staging rows; ``spread`` deals the line items over tasks while they are narrow."""
    li, o, c, n, r, p = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region", "part")
    )
    li = spread(li.select(*LINE_COLUMNS))
    joined = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
    )
    columns = []
    for name in STAGING_COLUMNS:
        kind = "double" if name in _DOUBLES else "string"
        expr = STAGING_EXPR.get(name)
        columns.append((F.expr(expr) if expr else F.lit(None)).cast(kind).alias(name))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("staging_id"),
        *columns,
        F.col("l_shipdate").alias("datetime_utc"),
        F.col("l_quantity").alias("value"),
    )


# --- models for the live queries --------------------------------------------

LIVE_HORIZONS = 24


def live_registry(spark: SparkSession) -> DataFrame:
    """Sixteen models with made-up coefficients, without discharge / site 4 / winter."""
    rows = [
        (t, s, season, f"models/{t}/site_{s}/{season}", 0.1 * (i + 1), 0.5 * s)
        for t, sites in (("air_temperature", (1, 2)), ("discharge", (3, 4)))
        for s in sites
        for i, season in enumerate(SEASONS)
        if (t, s, season) != ("discharge", 4, "winter")
    ]
    base = literal_rows(
        spark,
        "target_variable string, site_id int, season string, model_path string, a double, b double",
        rows,
    )
    h = F.sequence(F.lit(1), F.lit(LIVE_HORIZONS))
    return base.select(
        "target_variable", "site_id", "season", "model_path",
        F.transform(h, lambda k: F.col("a") - k / F.lit(97.0)).alias("slopes"),
        F.transform(h, lambda k: F.col("b") + k / F.lit(10.0)).alias("intercepts"),
    )


REGISTRY = """registry AS (
  SELECT t.target_variable, t.site_id, s.season,
         concat('models/', t.target_variable, '/site_', t.site_id, '/', s.season) AS model_path,
         0.1 * (s.i + 1) AS a, 0.5 * t.site_id AS b
  FROM (VALUES ('air_temperature', 1), ('air_temperature', 2), ('discharge', 3), ('discharge', 4)) t(target_variable, site_id),
       (VALUES ('winter', 0), ('spring', 1), ('summer', 2), ('fall', 3)) s(season, i)
  WHERE NOT (t.target_variable = 'discharge' AND t.site_id = 4 AND s.season = 'winter'))"""
