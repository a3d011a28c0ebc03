"""Loads into a stored star schema: only metadata not seen before is keyed, facts are appended.

Every table is kept as one folder per load. A load looks up the digests of its
metadata among those already keyed, makes members of the unseen ones only, with
keys above the highest there is, and appends its facts. What earlier loads
wrote is never written again; a load that is repeated replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.operators.normalize import (
    FACT_IDS,
    METHOD,
    PLAIN,
    UNIT,
    VARIABLE,
    Dimension,
    fresh_members,
    key_table,
    members,
    meta_digests,
    metadata,
    variable_members,
    with_keys,
)
from rillcast.sources.staged import per_key, stage
from rillcast.sources.tables import append_batch, batches

TABLES = (*(d.name for d in PLAIN), VARIABLE.name, "metadata", "datastream")


def stored(spark: SparkSession, path: str, name: str, before: int | None = None) -> DataFrame | None:
    """A table as the loads before a number (all if not given) left it; None before the first."""
    numbers = [n for n in batches(spark, f"{path}/{name}") if before is None or n < before]
    parts = [spark.read.parquet(f"{path}/{name}/batch_id={n}") for n in numbers]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _add(rows: DataFrame, old: DataFrame | None, path: str, dim: Dimension, number: int, extra: Sequence[str] = ()) -> DataFrame:
    """Append a dimension's new members and give all it has now."""
    fresh = with_keys(rows, dim, extra) if old is None else fresh_members(old, rows, dim, extra)
    append_batch(fresh, f"{path}/{dim.name}", number)
    return stored(rows.sparkSession, path, dim.name, number + 1)


def load(staging: DataFrame, path: str, number: int) -> None:
    """Load staging rows as load ``number`` (from 0, one after another)."""
    spark, path = staging.sparkSession, path.rstrip("/")
    seen = stored(spark, path, "metadata", number)
    meta = metadata(staging)
    unseen = stage(meta if seen is None else meta.join(seen.select("_m1", "_m2"), ["_m1", "_m2"], "left_anti"))
    dims = {d.name: _add(members(unseen, d), stored(spark, path, d.name, number), path, d, number) for d in PLAIN}
    incoming = variable_members(unseen, dims[UNIT.name], dims[METHOD.name])
    dims[VARIABLE.name] = _add(incoming, stored(spark, path, VARIABLE.name, number), path, VARIABLE, number, ("unit_id", "method_id"))
    append_batch(key_table(unseen, dims), f"{path}/metadata", number)
    rows = staging.select(F.col("staging_id").cast("long").alias("datastream_id"), "datetime_utc", "value", *[c.alias(n) for n, c in meta_digests().items()])
    keys = per_key(stored(spark, path, "metadata", number + 1))
    facts = rows.join(keys, ["_m1", "_m2"]).select("datastream_id", "datetime_utc", "value", *FACT_IDS)
    append_batch(facts, f"{path}/datastream", number)
