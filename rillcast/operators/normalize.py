"""Flat staging rows to dimensions and a fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.functions.timeaxis import floor_div
from rillcast.operators.scan import dense_ids, ranked
from rillcast.sources.staged import per_key, stage


@dataclass(frozen=True)
class Dimension:
    """A dimension: which staging columns it holds and which of them must be present.

    ``first_wins`` names a column that must stay unique; of several rows the
    smallest in column order is kept (the choice is free, this one is stable).
    """

    name: str
    key: str
    columns: dict[str, str]
    required: str
    by_name: str
    first_wins: str | None = None

    @property
    def natural(self) -> list[str]:
        return [self.first_wins] if self.first_wins else list(self.columns)


# Dimension names, keys and their staging columns.
OWNER = Dimension(
    "owner", "owner_id",
    {"name": "owner_name", "owner": "owner_name", "contact_email": "contact_email"},
    "owner_name", "name",
)
SITE = Dimension(
    "site", "site_id",
    {
        "site_code": "site_code", "name": "site_name", "description": "site_description",
        "site_type": "site_type", "latitude": "latitude", "longitude": "longitude",
        "elevation_m": "elevation_m", "state": "state", "county": "county",
    },
    "site_code", "site_code", first_wins="site_code",
)
UNIT = Dimension(
    "unit", "unit_id",
    {"name": "unit_name", "symbol": "unit_symbol", "definition": "unit_definition", "unit_type": "unit_type"},
    "unit_name", "name",
)
METHOD = Dimension(
    "method", "method_id",
    {
        "name": "method_name", "description": "method_description", "method_code": "method_code",
        "method_type": "method_type", "method_link": "method_link",
        "sensor_manufacturer_name": "sensor_manufacturer_name",
        "sensor_model_name": "sensor_model_name", "sensor_model_link": "sensor_model_link",
    },
    "method_name", "name",
)
PROCESSING_LEVEL = Dimension(
    "processing_level", "processing_level_id",
    {
        "code": "processing_level_code", "definition": "processing_level_definition",
        "explanation": "processing_level_explanation",
    },
    "processing_level_code", "code",
)
QUALIFIER = Dimension(
    "qualifier", "qualifier_id",
    {"qualifier_code": "qualifier_code", "description": "qualifier_description"},
    "qualifier_code", "qualifier_code",
)
VARIABLE = Dimension(
    "variable", "variable_id",
    {
        "name": "variable_name", "definition": "variable_definition",
        "description": "variable_description", "variable_type": "variable_type",
        "variable_code": "variable_code",
    },
    "variable_code", "variable_code",
)
PLAIN = (OWNER, SITE, UNIT, METHOD, PROCESSING_LEVEL, QUALIFIER)


def members(staging: DataFrame, dim: Dimension) -> DataFrame:
    """Distinct members of a dimension (duplicates are combined before the shuffle)."""
    rows = staging.where(F.col(dim.required).isNotNull()).select(
        *[F.col(s).alias(d) for d, s in dim.columns.items()]
    )
    if not dim.first_wins:
        return rows.distinct()
    rest = [c for c in dim.columns if c != dim.first_wins]
    return (
        rows.distinct()
        .groupBy(dim.first_wins)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(dim.first_wins, "_row.*")
    )


def with_keys(rows: DataFrame, dim: Dimension, extra: Sequence[str] = ()) -> DataFrame:
    out = dense_ids(rows, [*dim.natural, *extra], dim.key)
    return out.withColumn(dim.key, F.col(dim.key).cast("int"))


def null_safe(left: DataFrame, right: DataFrame, pairs: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs.items()])


def fresh_members(existing: DataFrame, incoming: DataFrame, dim: Dimension, extra: Sequence[str] = ()) -> DataFrame:
    """The incoming members that aren't there yet, with the next free keys."""
    natural = [*dim.natural, *extra]
    fresh = incoming.join(
        existing, null_safe(incoming, existing, {c: c for c in natural}), "left_anti"
    )
    top = existing.agg(F.coalesce(F.max(dim.key), F.lit(0))).scalar()
    numbered = dense_ids(fresh, natural, dim.key, top)
    return numbered.withColumn(dim.key, F.col(dim.key).cast(existing.schema[dim.key].dataType))


def insert_new(existing: DataFrame, incoming: DataFrame, dim: Dimension, extra: Sequence[str] = ()) -> DataFrame:
    """Existing members plus the incoming ones not there yet, with the next free keys.

    Running it again with the same input changes nothing.
    """
    return existing.unionByName(fresh_members(existing, incoming, dim, extra))


def _match(staging: DataFrame, table: DataFrame, dim: Dimension, by_name: bool) -> Column:
    if by_name:
        return staging[dim.columns[dim.by_name]] == table[dim.by_name]
    pairs = {dim.columns[c]: c for c in dim.natural}
    # The required column is never null in the dimension: plain equality there.
    exact = staging[dim.required] == table[[d for d, s in dim.columns.items() if s == dim.required][0]]
    return exact & null_safe(staging, table, pairs)


def attach(staging: DataFrame, table: DataFrame, dim: Dimension, how: str, by_name: bool) -> DataFrame:
    """Add a dimension's key to staging rows.

    ``by_name`` joins on the name alone, as name-keyed loads do; two members of
    one name then multiply rows. The default joins on the whole natural key.
    """
    only = table.select(dim.key, *([dim.by_name] if by_name else dim.natural))
    return staging.join(only, _match(staging, only, dim, by_name), how).select(
        *[staging[c] for c in staging.columns], only[dim.key]
    )


# Every staging column that some dimension holds.
META_COLUMNS = tuple(dict.fromkeys(c for d in (*PLAIN, VARIABLE) for c in d.columns.values()))


def meta_digests() -> dict[str, Column]:
    """Two digests, seeded apart, that name a row's metadata; which columns are null is part of them."""
    absent = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in META_COLUMNS])
    return {f"_m{k}": F.xxhash64(F.lit(k), absent, *META_COLUMNS) for k in (1, 2)}


def metadata(staging: DataFrame) -> DataFrame:
    """Distinct metadata of staging rows with their digests: a row or a few per file, made distinct before the shuffle."""
    return staging.select(*META_COLUMNS).distinct().withColumns(meta_digests())


def variable_members(
    staging: DataFrame, units: DataFrame, methods: DataFrame, by_name: bool = False
) -> DataFrame:
    """Distinct variables with unit and method keys. Staging is made distinct before the joins."""
    needed = {*VARIABLE.columns.values(), *UNIT.columns.values(), *METHOD.columns.values()}
    combos = staging.where(F.col("variable_code").isNotNull()).select(*sorted(needed)).distinct()
    combos = attach(combos, units, UNIT, "inner", by_name)
    combos = attach(combos, methods, METHOD, "inner", by_name)
    return combos.select(
        *[F.col(s).alias(d) for d, s in VARIABLE.columns.items()], "unit_id", "method_id"
    ).distinct()


FACT_IDS = ("site_id", "variable_id", "owner_id", "qualifier_id", "processing_level_id")


def key_table(meta: DataFrame, dims: Mapping[str, DataFrame], by_name: bool = False) -> DataFrame:
    """All keys of each metadata row: its digests and the fact's id columns.

    Unit, method, variable and site must match; the others may be absent. By
    name a metadata row can have several key rows.
    """
    rows = attach(meta, dims["site"], SITE, "inner", by_name)
    rows = attach(rows, dims["unit"], UNIT, "inner", by_name)
    rows = attach(rows, dims["method"], METHOD, "inner", by_name)
    variable = dims["variable"]
    on = (
        (rows["variable_code"] == variable["variable_code"])
        & (rows["unit_id"] == variable["unit_id"])
        & (rows["method_id"] == variable["method_id"])
    )
    if not by_name:
        on = on & null_safe(
            rows, variable, {s: d for d, s in VARIABLE.columns.items() if d != "variable_code"}
        )
    rows = rows.join(variable, on).select(*[rows[c] for c in rows.columns], variable["variable_id"])
    for dim in (OWNER, QUALIFIER, PROCESSING_LEVEL):
        rows = attach(rows, dims[dim.name], dim, "left", by_name)
    return rows.select("_m1", "_m2", *FACT_IDS)


def facts(
    staging: DataFrame, dims: Mapping[str, DataFrame], by_name: bool = False, meta: DataFrame | None = None
) -> DataFrame:
    """Fact rows: one join of staging to the keys of its distinct metadata.

    With whole natural keys each staging row gives one fact row and lends it
    its id; by name rows can multiply, so ids are numbered anew (in blocks of a
    million staging ids; the count of blocks is what one task orders).
    """
    keys = per_key(key_table(metadata(staging) if meta is None else meta, dims, by_name))
    rows = staging.select("staging_id", "datetime_utc", "value", *[c.alias(n) for n, c in meta_digests().items()])
    rows = rows.join(keys, ["_m1", "_m2"]).drop("_m1", "_m2")
    if by_name:
        rows = ranked(
            rows, [], ["staging_id", "datetime_utc", "value", *FACT_IDS], floor_div(F.col("staging_id"), 1 << 20), "datastream_id"
        )
        number = F.col("datastream_id").cast("long")
    else:
        number = F.col("staging_id").cast("long")
    return rows.select(number.alias("datastream_id"), "datetime_utc", "value", *FACT_IDS)


def normalize(staging: DataFrame, by_name: bool = False) -> dict[str, DataFrame]:
    """All tables of the star schema.

    Staging is read twice: once for its distinct metadata, from which all
    dimensions and keys are made, and once for the fact.
    """
    meta = stage(metadata(staging))
    # Independent small jobs: run side by side.
    with ThreadPoolExecutor(max_workers=len(PLAIN)) as pool:
        written = pool.map(lambda d: (d.name, stage(with_keys(members(meta, d), d))), PLAIN)
        out = dict(written)
    out["variable"] = stage(
        with_keys(
            variable_members(meta, out["unit"], out["method"], by_name),
            VARIABLE, ("unit_id", "method_id"),
        )
    )
    out["datastream"] = facts(staging, out, by_name, meta)
    return out


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
