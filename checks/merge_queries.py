"""Checks: loads that add to what is stored, and reports that roll up from stored summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.file_queries import folder
from checks.inputs import DAILY, ERRORS, PREDICTED, daily_scored, observations, staging
from checks.model_queries import MEASURES, _measure_sql, _rounded
from checks.registry import SQL, check, r
from checks.table_queries import FACT, STAR, star
from rillcast.operators import evaluate as ev
from rillcast.operators import profile as pf
from rillcast.operators import rollup
from rillcast.sources import loads
from rillcast.sources.staged import stage
from rillcast.sources.tables import append_batch

# The facts with the names behind their keys: surrogate keys depend on the order of loads, these don't.
NAMED_FACTS = f"""{STAR}, fact AS ({FACT})
SELECT datastream_id, fact.datetime_utc, fact.value, site.site_code, site.name AS site_name, v.variable_code, v.name AS variable_name, u.name AS unit_name,
  u.symbol AS unit_symbol, m.name AS method_name, o.name AS owner_name, q.qualifier_code, p.code AS processing_level_code
FROM fact JOIN site USING (site_id) JOIN variable v USING (variable_id) JOIN unit u ON u.unit_id = v.unit_id JOIN method m ON m.method_id = v.method_id
LEFT JOIN owner o ON o.owner_id = fact.owner_id LEFT JOIN qualifier q ON q.qualifier_id = fact.qualifier_id
LEFT JOIN processing_level p ON p.processing_level_id = fact.processing_level_id"""


def _second_load(spark, sf_dir):
    """Two loads, a third of the orders first; the second is repeated as after a failure."""
    path = folder(spark, "star")
    rows = stage(staging(spark, sf_dir))
    first = F.pmod(F.call_function("div", F.col("staging_id"), F.lit(10)), F.lit(3)) == 0
    loads.load(rows.where(first), path, 0)
    for _ in range(2):
        loads.load(rows.where(~first), path, 1)
    return {name: loads.stored(spark, path, name) for name in loads.TABLES}


@check("norm_second_load", NAMED_FACTS)
def _(spark, sf_dir):
    t = _second_load(spark, sf_dir)
    named = (
        t["datastream"]
        .join(t["site"].select("site_id", "site_code", F.col("name").alias("site_name")), "site_id")
        .join(t["variable"].select("variable_id", "variable_code", F.col("name").alias("variable_name"), "unit_id", "method_id"), "variable_id")
        .join(t["unit"].select("unit_id", F.col("name").alias("unit_name"), F.col("symbol").alias("unit_symbol")), "unit_id")
        .join(t["method"].select("method_id", F.col("name").alias("method_name")), "method_id")
        .join(t["owner"].select("owner_id", F.col("name").alias("owner_name")), "owner_id", "left")
        .join(t["qualifier"].select("qualifier_id", "qualifier_code"), "qualifier_id", "left")
        .join(t["processing_level"].select("processing_level_id", F.col("code").alias("processing_level_code")), "processing_level_id", "left")
    )
    return named.select(
        "datastream_id", "datetime_utc", "value", "site_code", "site_name", "variable_code", "variable_name", "unit_name", "unit_symbol",
        "method_name", "owner_name", "qualifier_code", "processing_level_code",
    )


# Every member once, with keys from 1 on without a gap, whatever load brought it.
@check("norm_second_load_members", f"{STAR} " + " UNION ALL ".join(
    f"SELECT '{n}' AS dimension, count(*) AS n, CAST(1 AS INTEGER) AS least_key, CAST(count(*) AS INTEGER) AS largest_key, count(*) AS n_keys FROM {n}"
    for n in ("owner", "site", "unit", "method", "processing_level", "qualifier", "variable")) )
def _(spark, sf_dir):
    t = _second_load(spark, sf_dir)
    out = None
    for n in ("owner", "site", "unit", "method", "processing_level", "qualifier", "variable"):
        key = f"{n}_id"
        part = t[n].agg(F.count("*").alias("n"), F.coalesce(F.min(key), F.lit(1)).alias("least_key"), F.coalesce(F.max(key), F.lit(0)).alias("largest_key"), F.count_distinct(key).alias("n_keys"))
        part = part.select(F.lit(n).alias("dimension"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def stored_days(spark, facts):
    """Summaries by series and day of three loads of the facts, as stored: a report merges them as far as it needs, at once."""
    path, third = folder(spark, "days"), F.pmod(F.xxhash64("datastream_id"), F.lit(3))
    for k in range(3):
        append_batch(rollup.series_days(facts.where(third == k)), path, k)
    return spark.read.parquet(path).drop("batch_id")


@check("prof_overview_rollup", SQL["prof_overview"])
def _(spark, sf_dir):
    days = stored_days(spark, stage(observations(spark, sf_dir)))
    return rollup.overview_of(days).withColumns({c: r(c) for c in ("min_value", "max_value", "avg_value")})


@check("prof_availability_rollup", SQL["prof_availability"])
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.availability(stored_days(spark, stage(t["datastream"])), t["site"], t["variable"])


@check("prof_summary_rollup", SQL["prof_summary"])
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.summary(stored_days(spark, stage(t["datastream"])), t["site"], t["variable"], t["unit"]).withColumn("avg_value", r("avg_value"))


@check("prof_daily_rollup", SQL["prof_daily_all"])
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.daily_summary(stored_days(spark, stage(t["datastream"])), t["site"], t["variable"], None).withColumn("avg_value", r("avg_value"))


def _cube_sql():
    parts = []
    for level in rollup.CUBE_LEVELS:
        keys = ", ".join(k if k in level else f"CAST(NULL AS {'INTEGER' if k == 'site_id' else 'VARCHAR'}) AS {k}" for k in rollup.CUBE_KEYS)
        group = f"GROUP BY {', '.join(level)}" if level else ""
        parts.append(f"SELECT '{','.join(level)}' AS level, {keys}, {ERRORS} FROM long {group}")
    return " UNION ALL ".join(parts)


# All metric tables at once, from the stored cubes of two runs.
@check("metric_cube", f"""WITH {PREDICTED}, cube AS ({_cube_sql()}),
told AS (SELECT *, CASE WHEN persistence_rmse > 0 THEN 1 - rmse / persistence_rmse END AS rmse_skill_vs_persistence,
  CASE WHEN persistence_mae > 0 THEN 1 - mae / persistence_mae END AS mae_skill_vs_persistence FROM cube)
SELECT level, site_id, season, horizon_bin, n, {_measure_sql()} FROM told""")
def _(spark, sf_dir):
    long = stage(ev.expand(daily_scored(spark, sf_dir), DAILY))
    path, half = folder(spark, "cube"), F.month("target_timestamp") <= 6
    append_batch(rollup.error_cube(long.where(half)), path, 0)
    append_batch(rollup.error_cube(long.where(~half)), path, 1)
    cube = rollup.added_cubes(spark.read.parquet(path).drop("batch_id"))
    return _rounded(rollup.cube_metrics(cube), MEASURES)
