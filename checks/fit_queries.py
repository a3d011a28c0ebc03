"""Checks: forecasters of the whole design, on the daily samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import DAILY_SPEC, FITTED, daily_split
from checks.registry import check, r, rsql
from rillcast.functions.vectors import deltas
from rillcast.operators import boosting, models, prep, ridge
from rillcast.sources.staged import stage

H = DAILY_SPEC.horizons
SHRINK = 2.0


def _two_features(spark, sf_dir):
    split = prep.usable_subsets(daily_split(spark, sf_dir))
    month = F.month("forecast_start_time").cast("double")
    return stage(split.withColumns({"d": deltas(), "features": F.array(models.departure(), month)}))


# Cramer's rule on the three sums of squares and products of (1, departure, month), the constant not shrunk.
RIDGE = f"""{FITTED},
rows3 AS (
  SELECT site_id, season_name, x AS u, CAST(month(forecast_start_time) AS DOUBLE) AS v, h AS horizon, targets[h] - base AS y
  FROM split SEMI JOIN usable USING (site_id, season_name), range(1, 8) t(h) WHERE part = 'train'),
sums3 AS (
  SELECT site_id, season_name, horizon, count(*) AS n, count(*) * 1.0 AS a, sum(u) AS b, sum(v) AS c, sum(u * u) + {SHRINK} AS d, sum(u * v) AS e,
         sum(v * v) + {SHRINK} AS f, sum(y) AS p, sum(u * y) AS q, sum(v * y) AS s FROM rows3 GROUP BY ALL),
solved3 AS (
  SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM sums3),
ridge AS (
  SELECT site_id, season_name, horizon, n,
    (p * (d * f - e * e) - b * (q * f - e * s) + c * (q * e - d * s)) / det AS constant,
    (a * (q * f - e * s) - p * (b * f - e * c) + c * (b * s - q * c)) / det AS departure,
    (a * (d * s - q * e) - b * (b * s - q * c) + p * (b * e - d * c)) / det AS month
  FROM solved3)"""


@check("ridge_fit", f"""WITH {RIDGE} SELECT site_id, season_name, CAST(horizon AS INTEGER) AS horizon, n,
  {rsql("constant", "constant")}, {rsql("departure", "departure")}, {rsql("month", "month")} FROM ridge""")
def _(spark, sf_dir):
    fitted = ridge.fit_ridge(_two_features(spark, sf_dir).where("part = 'train'"), label="d", alpha=SHRINK)
    long = fitted.select("site_id", "season_name", "n", F.posexplode("coefficients").alias("h", "c"))
    names = [r(F.get("c", F.lit(k))).alias(name) for k, name in enumerate(("constant", "departure", "month"))]
    return long.select("site_id", "season_name", (F.col("h") + 1).alias("horizon"), "n", *names)


@check("ridge_score", f"""WITH {RIDGE} SELECT s.site_id, s.forecast_start_time, CAST(horizon AS INTEGER) AS horizon,
  {rsql("base + constant + departure * x + month * month(forecast_start_time)", "value", 5)}
FROM split s JOIN ridge USING (site_id, season_name) WHERE part = 'validation'""")
def _(spark, sf_dir):
    data = _two_features(spark, sf_dir)
    fitted = ridge.fit_ridge(data.where("part = 'train'"), label="d", alpha=SHRINK)
    scored = ridge.score_ridge(data.where("part = 'validation'"), fitted, H, scaled=False)
    long = scored.select("site_id", "forecast_start_time", F.posexplode("y_pred_unclipped").alias("h", "v"))
    return long.select("site_id", "forecast_start_time", (F.col("h") + 1).alias("horizon"), r("v", 5).alias("value"))


BINS, LEAST = 8, 3

_SPLIT = """
  SELECT {own}, feature, bin, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(n) OVER a AS nn, sum(g) OVER a AS gg
  FROM (SELECT {own}, feature, bin, count(*) AS n, sum(y) AS g FROM {rows} GROUP BY ALL)
  WINDOW w AS (PARTITION BY {own}, feature ORDER BY bin), a AS (PARTITION BY {own}, feature)"""
_GAIN = f"round(gl * gl / (nl + {SHRINK}) + (gg - gl) * (gg - gl) / (nn - nl + {SHRINK}) - gg * gg / (nn + {SHRINK}), 6)"


def _level_sql(k: int, before: str) -> str:
    """Nodes of level ``k`` from the samples of ``before`` (one row a sample, horizon and feature), and those samples one level down."""
    return f"""
t_split{k} AS ({_SPLIT.format(own="site_id, horizon, node", rows=before)}),
t_best{k} AS (
  SELECT site_id, horizon, node, feature, bin FROM (SELECT *, {_GAIN} AS gain FROM t_split{k} WHERE nl >= {LEAST} AND nn - nl >= {LEAST})
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY site_id, horizon, node ORDER BY gain DESC, feature, bin) = 1),
t_down{k} AS (
  SELECT c.id, c.site_id, c.horizon, c.y, c.feature, c.bin, 2 * c.node + CASE WHEN d.bin > b.bin THEN 1 ELSE 0 END AS node
  FROM {before} c JOIN t_best{k} b USING (site_id, horizon, node) JOIN {before} d ON d.id = c.id AND d.horizon = c.horizon AND d.feature = b.feature)"""


TREES = f"""{FITTED},
base2 AS (
  SELECT row_number() OVER () AS id, site_id, x, CAST(month(forecast_start_time) AS DOUBLE) AS m, targets, base
  FROM split SEMI JOIN usable USING (site_id, season_name) WHERE part = 'train'),
values2 AS (SELECT id, site_id, f.feature, f.v FROM base2, LATERAL (VALUES (0, x), (1, m)) f(feature, v)),
t_ends AS (SELECT site_id, feature, min(v) AS lo, max(v) AS hi FROM values2 GROUP BY ALL),
t_binned AS (SELECT id, site_id, feature, len([k FOR k IN range(1, {BINS}) IF lo + k * (hi - lo) / {BINS} <= v]) AS bin FROM values2 JOIN t_ends USING (site_id, feature)),
t_cases AS (
  SELECT b.id, site_id, h AS horizon, targets[h] - base AS y, feature, bin, 1 AS node
  FROM t_binned b JOIN base2 USING (id, site_id), range(1, 8) t(h)),{_level_sql(0, "t_cases")},{_level_sql(1, "t_down0")},
t_nodes AS (SELECT * FROM t_cases UNION ALL SELECT * FROM t_down0 UNION ALL SELECT * FROM t_down1)"""


# One tree of two levels for every site and horizon, without sampling: every node, its split and its value.
@check("tree_by_group", f"""WITH {TREES}
SELECT site_id, CAST(horizon AS INTEGER) AS horizon, CAST(node AS INTEGER) AS node, count(*) AS n, {rsql(f"sum(y) / (count(*) + {SHRINK})", "value")},
  any_value(best.feature)::INTEGER AS feature, any_value(best.bin)::INTEGER AS bin
FROM (SELECT site_id, horizon, node, y FROM t_nodes WHERE feature = 0) LEFT JOIN (SELECT * FROM t_best0 UNION ALL SELECT * FROM t_best1) best USING (site_id, horizon, node) GROUP BY ALL""")
def _(spark, sf_dir):
    train = _two_features(spark, sf_dir).where("part = 'train'")
    edges = stage(boosting.bin_edges(train, ["site_id"], "features", BINS))
    grown = boosting.fit_boosted_groups(train, edges, H, trees=1, depth=2, subsample=1.0, shrink=SHRINK, least_rows=LEAST, label="d")
    return grown.select("site_id", "horizon", "node", "n", r("value").alias("value"), "feature", "bin")
