"""Profiling, quality checks and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.operators.normalize import table_counts
from rillcast.operators.rollup import DAY_KEYS, merged_days, series_days
from rillcast.operators.scan import latest_rows, top_times
from rillcast.sources.staged import per_key


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts(tables).orderBy(F.desc("row_count"), "table_name")


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def overview(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("datetime_utc").alias("min_datetime_utc"),
        F.max("datetime_utc").alias("max_datetime_utc"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("avg_value"),
    )


def _per_series(facts: DataFrame, daily: bool = False) -> DataFrame:
    """Facts, or their stored summaries by series and day, reduced per series before any dimension is joined."""
    if "n_values" in facts.columns:
        return merged_days(facts, DAY_KEYS if daily else DAY_KEYS[:2])
    return series_days(facts, daily)


def _site(sites: DataFrame, *columns: str) -> DataFrame:
    return sites.select("site_id", "site_code", *columns)


def availability(facts: DataFrame, sites: DataFrame, variables: DataFrame) -> DataFrame:
    return (
        _per_series(facts)
        .join(_site(sites), "site_id")
        .join(variables.select("variable_id", "variable_code", F.col("name").alias("variable_name")), "variable_id")
        .select(
            "site_id", "site_code", "variable_id", "variable_code", "variable_name",
            F.col("n").alias("row_count"),
            F.col("first").alias("min_datetime"),
            F.col("last").alias("max_datetime"),
        )
        .orderBy("site_id", "variable_id")
    )


def summary(facts: DataFrame, sites: DataFrame, variables: DataFrame, units: DataFrame) -> DataFrame:
    names = ["site_code", "site_name", "variable_code", "variable_name", "unit_symbol"]
    return (
        _per_series(facts)
        .join(_site(sites, F.col("name").alias("site_name")), "site_id")
        .join(
            variables.select("variable_id", "variable_code", F.col("name").alias("variable_name"), "unit_id"),
            "variable_id",
        )
        .join(units.select("unit_id", F.col("symbol").alias("unit_symbol")), "unit_id", "left")
        .groupBy(*names)
        .agg(
            F.sum("n").alias("observation_count"),
            F.min("first").alias("first_observation"),
            F.max("last").alias("last_observation"),
            F.min("low").alias("min_value"),
            F.max("high").alias("max_value"),
            (F.sum("total") / F.sum("n_values")).alias("avg_value"),
        )
        .orderBy(F.desc("observation_count"), "site_code", "variable_code")
    )


def wide_sample(facts: DataFrame, dims: Mapping[str, DataFrame], n: int = 20) -> DataFrame:
    """Oldest n observations with all names. The rows are picked before the optional joins."""
    s, v = dims["site"], dims["variable"]
    picked = (
        facts.join(s.select("site_id"), "site_id", "left_semi")
        .join(v.select("variable_id"), "variable_id", "left_semi")
        .orderBy("datetime_utc", "datastream_id")
        .limit(n)
    )
    return (
        picked.join(s.select("site_id", "site_code", F.col("name").alias("site_name"), "latitude", "longitude"), "site_id")
        .join(
            v.select("variable_id", "variable_code", F.col("name").alias("variable_name"), "unit_id", "method_id"),
            "variable_id",
        )
        .join(dims["unit"].select("unit_id", F.col("name").alias("unit_name"), F.col("symbol").alias("unit_symbol")), "unit_id", "left")
        .join(dims["method"].select("method_id", F.col("name").alias("method_name")), "method_id", "left")
        .join(dims["processing_level"].select("processing_level_id", F.col("code").alias("processing_level_code")), "processing_level_id", "left")
        .join(dims["qualifier"].select("qualifier_id", "qualifier_code"), "qualifier_id", "left")
        .select(
            "datastream_id", "datetime_utc", "value", "site_code", "site_name", "latitude", "longitude",
            "variable_code", "variable_name", "unit_name", "unit_symbol", "method_name",
            "processing_level_code", "qualifier_code",
        )
        .orderBy("datetime_utc", "datastream_id")
    )


def null_summary(df: DataFrame, table: str) -> DataFrame:
    """Rows and nulls of every column: one pass, then one row per column."""
    columns = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    )
    return counted.select(
        F.lit(table).alias("table_name"), F.col("_rows").alias("total_rows"), F.inline(cells)
    )


def null_summaries(tables: Mapping[str, DataFrame], largest: int = 10) -> DataFrame:
    """Null counts of the largest tables."""
    top = row_counts(tables).limit(largest).collect()
    out = None
    for row in top:
        part = null_summary(tables[row.table_name], row.table_name)
        out = part if out is None else out.unionByName(part)
    return out


def variable_list(variables: DataFrame, units: DataFrame, methods: DataFrame | None = None) -> DataFrame:
    out = variables.select(
        "variable_id", "variable_code", F.col("name").alias("variable_name"), "variable_type", "unit_id", "method_id"
    ).join(
        units.select("unit_id", F.col("name").alias("unit_name"), F.col("symbol").alias("unit_symbol")),
        "unit_id", "left",
    )
    names = ["variable_id", "variable_code", "variable_name", "variable_type", "unit_name", "unit_symbol"]
    if methods is None:
        return out.select(*names).orderBy("variable_id")
    return (
        out.join(methods.select("method_id", F.col("name").alias("method_name")), "method_id", "left")
        .select(*names, "method_name")
        .orderBy("variable_code", "variable_name", "variable_id")
    )


def daily_summary(facts: DataFrame, sites: DataFrame, variables: DataFrame, n: int | None = 100) -> DataFrame:
    out = (
        _per_series(facts, daily=True)
        .join(_site(sites), "site_id")
        .join(variables.select("variable_id", "variable_code"), "variable_id")
        .groupBy("day_utc", "site_code", "variable_code")
        .agg(
            F.sum("n").alias("n_observations"),
            (F.sum("total") / F.sum("n_values")).alias("avg_value"),
            F.min("low").alias("min_value"),
            F.max("high").alias("max_value"),
        )
        .orderBy("day_utc", "site_code", "variable_code")
    )
    return out if n is None else out.limit(n)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct foreign-key values without a parent and how many rows hold them; null keys are allowed."""
    held = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("fk"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return held.join(parent.select(F.col(key).alias("fk")), "fk", "left_anti")


def site_list(sites: DataFrame) -> DataFrame:
    return sites.orderBy("site_code")


def find_variables(variables: DataFrame, terms: Sequence[str], name: str = "name") -> DataFrame:
    """Variables whose code or name contains any term, ignoring case."""
    text = F.lower(
        F.concat(F.coalesce("variable_code", F.lit("")), F.lit(" "), F.coalesce(name, F.lit("")))
    )
    hit = F.lit(False)
    for term in terms:
        hit = hit | text.contains(term.lower())
    return variables.where(hit)


def require_variables(variables: DataFrame, terms: Sequence[str], name: str = "name") -> DataFrame:
    found = find_variables(variables, terms, name)
    if found.isEmpty():
        raise ValueError(f"no variable matches {list(terms)}")
    return found


def latest_per_series(facts: DataFrame, keys: Sequence[str] = ("site_id", "variable_id")) -> DataFrame:
    return latest_rows(facts, keys, "datetime_utc", "datastream_id")


def observation_by_id(facts: DataFrame, variables: DataFrame, datastream_id: int) -> DataFrame:
    return facts.where(F.col("datastream_id") == datastream_id).join(
        variables.select("variable_id", "variable_code"), "variable_id"
    )


def latest_other(events: DataFrame, facts: DataFrame, keys: Sequence[str] = ("site_id", "variable_id")) -> DataFrame:
    """Add ``latest_other``: the latest time of the series among the other rows.

    Events are rows of ``facts``. Only when an event alone holds the latest
    time does the runner-up matter.
    """
    tops = per_key(top_times(facts, keys, "datetime_utc"))
    alone = (F.col("datetime_utc") == F.col("latest")) & (F.col("n_latest") == 1)
    return (
        events.join(tops, list(keys), "left")
        .withColumn("latest_other", F.when(alone, F.col("runner_up")).otherwise(F.col("latest")))
        .drop("latest", "n_latest", "runner_up")
    )


def max_id(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("long").alias("max_id"))
