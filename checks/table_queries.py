"""Checks: sensor files, normalisation, profiling and quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import (
    DAILY_SAMPLES,
    DAILY_SPEC,
    DAILY_TARGET,
    OBS,
    STAGING,
    daily_samples,
    observations,
    staging,
    table,
)
from checks.registry import check, r, rsql
from rillcast.operators import normalize as nz
from rillcast.operators import profile as pf
from rillcast.sources import sensor_csv as sc
from rillcast.session import checkpoint_dir
from rillcast.sources.staged import stage
from rillcast.sources.tables import audit, load_training, write_training

def spread(df, key):
    """Rows over all cores: the driver's tables come as one row group, so one task would read them.

    Tasks get pieces of bounded size, more of them the more rows there are; a
    join on the key that has to shuffle takes the pieces as they are, so there
    they are no more than shuffle partitions.
    """
    return df.hint("rebalance", F.col(key))


# --- sensor files derived from the tables -------------------------------------

# One "file" per part: a header with repeated keys, unknown keys and empty values.
HEADER = (
    ("# Sensor export",),
    ("# Workspace:",),
    ("# Name: Plant ", "p_brand"),
    ("# Owner: N/A",),
    ("# Site Information:",),
    ("# Name: Site ", "p_name"),
    ("# SamplingFeatureCode: ", "p_type"),
    ("# Mood:",),
    ("# Description: None",),
    ("# Location Information:",),
    ("# Latitude: ", "p_retailprice"),
    ("# Longitude: east",),
    ("# Unit Information:",),
    ("# Name: litre",),
    ("# Colour: red",),
    ("# Symbol: L",),
    ("# Symbol: l/s",),
)


def header_lines(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    texts = [
        F.concat(F.lit(line[0]), *[F.col(c).cast("string") for c in line[1:]]) for line in HEADER
    ]
    return part.select(
        F.concat(F.lit("part_"), "p_partkey", F.lit(".csv")).alias("file"),
        F.posexplode(F.array(*texts)).alias("_i", "line"),
    ).select("line", "file", F.struct(F.lit(0).alias("block"), F.col("_i").alias("row")).alias("position"))


@check("header_metadata", """SELECT concat('part_', p_partkey, '.csv') AS file, concat('Plant ', p_brand) AS workspace_name,
  CAST(NULL AS VARCHAR) AS owner_name, concat('Site ', p_name) AS site_name, CAST(NULL AS VARCHAR) AS site_description,
  p_type AS site_code, p_retailprice AS latitude, CAST(NULL AS DOUBLE) AS longitude, 'litre' AS unit_name, 'l/s' AS unit_symbol
FROM part""")
def _(spark, sf_dir):
    return sc.metadata(sc.header_entries(header_lines(spark, sf_dir))).select(
        "file", "workspace_name", "owner_name", "site_name", "site_description", "site_code",
        "latitude", "longitude", "unit_name", "unit_symbol",
    )


def data_lines(spark, sf_dir):
    """Line items as sensor lines: blank and bad times, bad values, blank qualifiers, quoted cells."""
    li = table(spark, sf_dir, "lineitem")
    time = (
        F.when(F.col("l_returnflag") == "R", F.lit("not-a-time"))
        .when(F.col("l_linenumber") == 7, F.lit("  "))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    )
    value = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    flag = F.when(F.col("l_linestatus") == "O", F.lit('"P,F"')).otherwise(F.lit(" "))
    file = F.concat(F.lit("supplier_"), F.col("l_suppkey"), F.lit(".csv"))
    rows = li.select(
        F.concat_ws(",", flag, time, value).alias("line"),
        file.alias("file"),
        F.struct(F.col("l_orderkey").alias("block"), F.col("l_linenumber").alias("row")).alias("position"),
    )
    first = F.struct(F.lit(-1).cast("long").alias("block"), F.lit(0).alias("row"))
    suppliers = table(spark, sf_dir, "supplier").select(
        # Every other file has blanks around its titles, which are trimmed.
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("ResultQualifiers, ResultTime, Result")).otherwise(
            F.lit("ResultQualifiers,ResultTime,Result")
        ).alias("line"),
        F.concat(F.lit("supplier_"), F.col("s_suppkey"), F.lit(".csv")).alias("file"),
        first.alias("position"),
    )
    return rows.unionByName(suppliers)


RECORDS = """SELECT concat('supplier_', l_suppkey, '.csv') AS file, l_shipdate AS datetime_utc,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS value, CASE WHEN l_linestatus = 'O' THEN 'P,F' END AS qualifier_code
FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber <> 7"""


@check("parse_observations", RECORDS)
def _(spark, sf_dir):
    return sc.observations(sc.records(data_lines(spark, sf_dir)))


@check("rows_per_file", f"SELECT file AS source_file, count(*) AS row_count FROM ({RECORDS}) GROUP BY ROLLUP (file)")
def _(spark, sf_dir):
    rows = sc.observations(sc.records(data_lines(spark, sf_dir)))
    return sc.rows_per_file(rows.withColumnRenamed("file", "source_file"))


def site_headers(spark, sf_dir):
    """Header lines of each supplier's file; they stand before its column titles."""
    lines = F.array(
        F.lit("# Site Information:"), F.concat(F.lit("# Name: Site "), "s_name"),
        F.lit("# Location Information:"), F.concat(F.lit("# Latitude: "), F.col("s_acctbal").cast("string")),
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey"), F.lit(".csv")).alias("file"), F.posexplode(lines).alias("_i", "line")
    ).select("line", "file", F.struct(F.lit(-2).cast("long").alias("block"), F.col("_i").alias("row")).alias("position"))


# Sensor lines joined with the header of their own file.
@check("denormalise", f"""SELECT d.*, concat('Site ', s_name) AS site_name, s_acctbal AS latitude
FROM ({RECORDS}) d JOIN supplier ON d.file = concat('supplier_', s_suppkey, '.csv')""")
def _(spark, sf_dir):
    meta = sc.metadata(sc.header_entries(site_headers(spark, sf_dir))).select("file", "site_name", "latitude")
    return sc.observations(sc.records(data_lines(spark, sf_dir))).join(meta, "file")


# --- normalisation --------------------------------------------------------------

def _md5(cols):
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in cols) + "))"


def _members_sql(dim):
    cols = ", ".join(f"{s} AS {d}" for d, s in dim.columns.items())
    return f"SELECT DISTINCT {cols} FROM staging WHERE {dim.required} IS NOT NULL"


def _keyed_sql(dim, extra=()):
    natural = [*dim.natural, *extra]
    order = ", ".join([_md5(natural), *[f"{c} NULLS FIRST" for c in natural]])
    return f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS {dim.key}, *"


SITE_MEMBERS = f"""SELECT * FROM ({_members_sql(nz.SITE)}) QUALIFY row_number() OVER (PARTITION BY site_code
  ORDER BY {", ".join(c + " NULLS FIRST" for c in nz.SITE.columns if c != "site_code")}) = 1"""
DIMS = ",\n".join(
    f"{d.name} AS ({_keyed_sql(d)} FROM ({SITE_MEMBERS if d.first_wins else _members_sql(d)}))"
    for d in nz.PLAIN
)


def _lookup(dim, how="IS NOT DISTINCT FROM", by_name=False):
    """Key of a staging row's member, as a lateral subquery; several rows where a name has several members."""
    names = [dim.by_name] if by_name else dim.natural
    match = " AND ".join(f"d.{c} {how if not by_name else '='} x.{dim.columns[c]}" for c in names)
    return f"(SELECT d.{dim.key} FROM {dim.name} d WHERE {match} AND x.{dim.required} IS NOT NULL)"


def _star(by_name):
    combos = f"""SELECT DISTINCT {", ".join(f"x.{c} AS {d}" for d, c in nz.VARIABLE.columns.items())}, lu.unit_id, lm.method_id
  FROM staging x, LATERAL {_lookup(nz.UNIT, by_name=by_name)} lu, LATERAL {_lookup(nz.METHOD, by_name=by_name)} lm
  WHERE x.variable_code IS NOT NULL"""
    return f"""WITH {STAGING},
{DIMS},
variable AS ({_keyed_sql(nz.VARIABLE, ("unit_id", "method_id"))} FROM ({combos}))"""


def _fact_rows(by_name):
    """Each staging row with all its keys: one CTE of looked-up ids, then the variable by code, unit and method."""
    need = ", ".join(f"LATERAL {_lookup(d, by_name=by_name)} l_{d.name}" for d in (nz.SITE, nz.UNIT, nz.METHOD))
    may = " ".join(
        f"LEFT JOIN LATERAL {_lookup(d, by_name=by_name)} l_{d.name} ON true" for d in (nz.OWNER, nz.QUALIFIER, nz.PROCESSING_LEVEL)
    )
    return f"""SELECT staging_id, datetime_utc, value, site_id, variable_id, owner_id, qualifier_id, processing_level_id
FROM (SELECT x.staging_id, x.datetime_utc, x.value, x.variable_code, l_site.site_id, l_unit.unit_id, l_method.method_id, l_owner.owner_id,
        l_qualifier.qualifier_id, l_processing_level.processing_level_id FROM staging x, {need} {may}) keyed
JOIN variable USING (variable_code, unit_id, method_id)"""


STAR = _star(False)
STAR_NAMED = _star(True)
FACT = f"SELECT CAST(staging_id AS BIGINT) AS datastream_id, * EXCLUDE (staging_id) FROM ({_fact_rows(False)})"
FACT_NAMED = _fact_rows(True)


def star(spark, sf_dir, by_name=False):
    """Normalised tables from staging written once, spread over files as a load would leave it."""
    return nz.normalize(stage(staging(spark, sf_dir, lambda lines: spread(lines, "l_orderkey"))), by_name)


@check("norm_dim_distinct", f"WITH {STAGING} " + " UNION ALL ".join(
    f"SELECT DISTINCT '{d.name}' AS dimension, {a} AS name, {b} AS detail FROM staging WHERE {d.required} IS NOT NULL"
    for d, a, b in (
        (nz.OWNER, "owner_name", "contact_email"), (nz.UNIT, "unit_name", "unit_symbol"),
        (nz.METHOD, "method_name", "method_code"), (nz.PROCESSING_LEVEL, "processing_level_code", "processing_level_definition"),
        (nz.QUALIFIER, "qualifier_code", "qualifier_description"),
    )
))
def _(spark, sf_dir):
    staged = stage(staging(spark, sf_dir))
    out = None
    for d, a, b in (
        (nz.OWNER, "name", "contact_email"), (nz.UNIT, "name", "symbol"), (nz.METHOD, "name", "method_code"),
        (nz.PROCESSING_LEVEL, "code", "definition"), (nz.QUALIFIER, "qualifier_code", "description"),
    ):
        part = nz.members(staged, d).select(
            F.lit(d.name).alias("dimension"), F.col(a).alias("name"), F.col(b).alias("detail")
        )
        out = part if out is None else out.unionByName(part)
    return out


@check("norm_dim_first_wins", f"WITH {STAGING} {SITE_MEMBERS}")
def _(spark, sf_dir):
    return nz.members(staging(spark, sf_dir), nz.SITE)


@check("norm_surrogate_keys", f"WITH {STAGING}, {DIMS} SELECT unit_id, name, symbol FROM unit")
def _(spark, sf_dir):
    return nz.with_keys(nz.members(staging(spark, sf_dir), nz.UNIT), nz.UNIT).select("unit_id", "name", "symbol")


@check("norm_variable_dim", f"{STAR} SELECT * FROM variable")
def _(spark, sf_dir):
    return star(spark, sf_dir)["variable"]


@check("norm_variable_by_name", f"{STAR_NAMED} SELECT * FROM variable")
def _(spark, sf_dir):
    return star(spark, sf_dir, by_name=True)["variable"]


@check("norm_fact", f"{STAR} {FACT}")
def _(spark, sf_dir):
    return star(spark, sf_dir)["datastream"]


# By name two units share a name: facts multiply, ids are numbered anew.
@check("norm_fact_by_name", f"""{STAR_NAMED}, f AS ({FACT_NAMED})
SELECT row_number() OVER (ORDER BY staging_id, datetime_utc, value NULLS FIRST, site_id, variable_id, owner_id NULLS FIRST, qualifier_id NULLS FIRST,
  processing_level_id NULLS FIRST) AS datastream_id, * EXCLUDE (staging_id) FROM f""")
def _(spark, sf_dir):
    return star(spark, sf_dir, by_name=True)["datastream"]


# Half of the units are there already; inserting all of them twice adds only the missing ones, once.
@check("norm_idempotent_insert", f"""WITH {STAGING},
old AS ({_keyed_sql(nz.UNIT)} FROM ({_members_sql(nz.UNIT)}) WHERE symbol < 'Brand#2'),
fresh AS (SELECT * FROM ({_members_sql(nz.UNIT)}) WHERE NOT symbol < 'Brand#2')
SELECT * FROM old UNION ALL
SELECT CAST((SELECT max(unit_id) FROM old) + row_number() OVER (ORDER BY {_md5(nz.UNIT.natural)}) AS INTEGER), * FROM fresh""")
def _(spark, sf_dir):
    units = stage(nz.members(staging(spark, sf_dir), nz.UNIT))
    old = nz.with_keys(units.where("symbol < 'Brand#2'"), nz.UNIT)
    once = stage(nz.insert_new(old, units, nz.UNIT))
    return nz.insert_new(once, units, nz.UNIT)


@check("norm_counts", f"{STAR}, fact AS ({FACT}) " + " UNION ALL ".join(
    f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {name}"
    for name, label in (("owner", "owner"), ("site", "site"), ("unit", "unit"), ("method", "method"),
                        ("variable", "variable"), ("fact", "datastream"))
))
def _(spark, sf_dir):
    tables = star(spark, sf_dir)
    return nz.table_counts({n: tables[n] for n in ("owner", "site", "unit", "method", "variable", "datastream")})


# --- profiling ------------------------------------------------------------------

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _tables(spark, sf_dir):
    return {t: table(spark, sf_dir, t) for t in TABLES}


@check("prof_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def _(spark, sf_dir):
    return pf.row_counts(_tables(spark, sf_dir))


FIRST_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey l_linenumber", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id turn",
}


def _key_text(keys):
    return "concat_ws('/', " + ", ".join(f"CAST({k} AS VARCHAR(99))" for k in keys.split()) + ")"


# Ten rows of every table, named by their keys.
@check("prof_sample_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, k AS sample_key FROM (SELECT {_key_text(keys)} AS k FROM {t} ORDER BY {keys.replace(' ', ', ')} LIMIT 10)"
    for t, keys in FIRST_KEYS.items()
))
def _(spark, sf_dir):
    out = None
    for t, keys in FIRST_KEYS.items():
        part = pf.head(table(spark, sf_dir, t), 10, keys.split()).select(
            F.lit(t).alias("table_name"), F.concat_ws("/", *[F.col(k).cast("string") for k in keys.split()]).alias("sample_key")
        )
        out = part if out is None else out.unionByName(part)
    return out


@check("prof_sample_of_events", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def _(spark, sf_dir):
    return pf.head(table(spark, sf_dir, "events"), 10, ["event_id"])


@check("prof_overview", f"""WITH {OBS} SELECT count(*) AS row_count, min(datetime_utc) AS min_datetime_utc, max(datetime_utc) AS max_datetime_utc,
  count(*) FILTER (WHERE value IS NULL) AS null_values, {rsql("min(value)", "min_value")}, {rsql("max(value)", "max_value")},
  {rsql("avg(value)", "avg_value")} FROM obs""")
def _(spark, sf_dir):
    return pf.overview(observations(spark, sf_dir)).withColumns(
        {c: r(c) for c in ("min_value", "max_value", "avg_value")}
    )


@check("prof_availability", f"""{STAR}, fact AS ({FACT})
SELECT st.site_id, st.site_code, v.variable_id, v.variable_code, v.name AS variable_name, count(*) AS row_count,
  min(f.datetime_utc) AS min_datetime, max(f.datetime_utc) AS max_datetime
FROM fact f JOIN site st USING (site_id) JOIN variable v USING (variable_id) GROUP BY ALL""")
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.availability(t["datastream"], t["site"], t["variable"])


@check("prof_summary", f"""{STAR}, fact AS ({FACT})
SELECT st.site_code, st.name AS site_name, v.variable_code, v.name AS variable_name, u.symbol AS unit_symbol,
  count(*) AS observation_count, min(f.datetime_utc) AS first_observation, max(f.datetime_utc) AS last_observation,
  min(f.value) AS min_value, max(f.value) AS max_value, {rsql("avg(f.value)", "avg_value")}
FROM fact f JOIN site st USING (site_id) JOIN variable v USING (variable_id) LEFT JOIN unit u USING (unit_id)
GROUP BY st.site_code, st.name, v.variable_code, v.name, u.symbol""")
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.summary(t["datastream"], t["site"], t["variable"], t["unit"]).withColumn("avg_value", r("avg_value"))


@check("prof_wide_sample", f"""{STAR}, fact AS ({FACT})
SELECT f.datastream_id, f.datetime_utc, f.value, st.site_code, st.name AS site_name, st.latitude, st.longitude, v.variable_code,
  v.name AS variable_name, u.name AS unit_name, u.symbol AS unit_symbol, m.name AS method_name,
  pl.code AS processing_level_code, q.qualifier_code
FROM fact f JOIN site st USING (site_id) JOIN variable v USING (variable_id) LEFT JOIN unit u USING (unit_id)
LEFT JOIN method m USING (method_id) LEFT JOIN processing_level pl USING (processing_level_id) LEFT JOIN qualifier q USING (qualifier_id)
ORDER BY f.datetime_utc, f.datastream_id LIMIT 20""")
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.wide_sample(t["datastream"], t)


LARGEST = {
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "events": "event_id ts user_id event_type value props",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "documents": "doc_id text lang source n_chars",
    "conversations": "conv_id turn role text",
    "embeddings": "vec_id embedding label",
    "labels": "doc_id quality toxic",
    "pages": "page_id url html",
}


@check("prof_nulls", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS total_rows, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {t}"
    for t, cols in LARGEST.items() for c in cols.split()
))
def _(spark, sf_dir):
    return pf.null_summaries(_tables(spark, sf_dir), 10)


@check("prof_variables", f"""{STAR} SELECT v.variable_id, v.variable_code, v.name AS variable_name, v.variable_type,
  u.name AS unit_name, u.symbol AS unit_symbol, m.name AS method_name
FROM variable v LEFT JOIN unit u USING (unit_id) LEFT JOIN method m USING (method_id)""")
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.variable_list(t["variable"], t["unit"], t["method"])


@check("prof_variables_plain", f"""{STAR} SELECT v.variable_id, v.variable_code, v.name AS variable_name, v.variable_type,
  u.name AS unit_name, u.symbol AS unit_symbol FROM variable v LEFT JOIN unit u USING (unit_id)""")
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.variable_list(t["variable"], t["unit"])


def _daily_sql(limit):
    return f"""{STAR}, fact AS ({FACT})
SELECT date_trunc('day', f.datetime_utc) AS day_utc, st.site_code, v.variable_code, count(*) AS n_observations,
  {rsql("avg(f.value)", "avg_value")}, min(f.value) AS min_value, max(f.value) AS max_value
FROM fact f JOIN site st USING (site_id) JOIN variable v USING (variable_id)
GROUP BY day_utc, st.site_code, v.variable_code {limit}"""


@check("prof_daily", _daily_sql("ORDER BY day_utc, st.site_code, v.variable_code LIMIT 100"))
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.daily_summary(t["datastream"], t["site"], t["variable"]).withColumn("avg_value", r("avg_value"))


@check("prof_daily_all", _daily_sql(""))
def _(spark, sf_dir):
    t = star(spark, sf_dir)
    return pf.daily_summary(t["datastream"], t["site"], t["variable"], None).withColumn("avg_value", r("avg_value"))


@check("prof_sites", f"WITH {STAGING}, {DIMS} SELECT site_id, site_code, name, site_type, state, county FROM site")
def _(spark, sf_dir):
    sites = nz.with_keys(nz.members(staging(spark, sf_dir), nz.SITE), nz.SITE)
    return pf.site_list(sites.select("site_id", "site_code", "name", "site_type", "state", "county"))


@check("dq_unique", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf_dir):
    return pf.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@check("dq_fk", """SELECT 'labels' AS child, CAST(doc_id AS BIGINT) AS fk, count(*) AS n FROM documents
  ANTI JOIN labels USING (doc_id) GROUP BY doc_id
UNION ALL SELECT 'orders', o_custkey, count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""")
def _(spark, sf_dir):
    a = pf.orphans(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")
    b = pf.orphans(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey")
    return a.select(F.lit("labels").alias("child"), "fk", "n").unionByName(
        b.select(F.lit("orders").alias("child"), "fk", "n")
    )


@check("find_variables", """SELECT p_partkey AS variable_id, p_type AS variable_code, p_name AS name FROM part
  WHERE lower(coalesce(p_type, '') || ' ' || coalesce(p_name, '')) LIKE '%econ%' OR lower(coalesce(p_type, '') || ' ' || coalesce(p_name, '')) LIKE '%ring%'""")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("variable_id"), F.col("p_type").alias("variable_code"), F.col("p_name").alias("name")
    )
    return pf.find_variables(part, ["Econ", "RING"])


@check("latest_per_series", f"""WITH {OBS} SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY site_id, variable_id
  ORDER BY datetime_utc DESC, datastream_id DESC) = 1""")
def _(spark, sf_dir):
    return pf.latest_per_series(observations(spark, sf_dir))


@check("latest_per_part", """SELECT l_partkey AS site_id, l_suppkey AS variable_id, l_shipdate AS datetime_utc,
  l_orderkey * 10 + l_linenumber AS datastream_id, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey * 10 + l_linenumber DESC) = 1""")
def _(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("site_id"), F.col("l_suppkey").alias("variable_id"),
        F.col("l_shipdate").alias("datetime_utc"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("datastream_id"), "l_quantity",
    )
    return pf.latest_per_series(li)


@check("event_by_id", f"WITH {OBS} SELECT * FROM obs WHERE datastream_id = (SELECT max(event_id) FROM events)")
def _(spark, sf_dir):
    obs = observations(spark, sf_dir)
    names = obs.select("variable_id", "variable_code").distinct()
    newest = pf.max_id(obs, "datastream_id").first().max_id
    return pf.observation_by_id(obs.drop("variable_code"), names, newest)


@check("latest_other", f"""WITH {OBS} SELECT e.datastream_id, e.site_id, e.variable_id, e.datetime_utc,
  (SELECT max(o.datetime_utc) FROM obs o WHERE o.site_id = e.site_id AND o.variable_id = e.variable_id
   AND o.datastream_id <> e.datastream_id) AS latest_other FROM obs e""")
def _(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return pf.latest_other(obs.select("datastream_id", "site_id", "variable_id", "datetime_utc"), obs)


@check("max_id", "SELECT coalesce(max(event_id), 0) AS max_id FROM events")
def _(spark, sf_dir):
    return pf.max_id(table(spark, sf_dir, "events"), "event_id")


# Training files written per site, read back and audited; 12 descriptive columns, lags and targets.
@check("training_audit", f"""WITH {DAILY_SAMPLES} SELECT site_id, count(*) AS row_count, CAST(12 + 28 + 7 AS INTEGER) AS column_count
  FROM samples GROUP BY site_id""")
def _(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"
    write_training(daily_samples(spark, sf_dir), DAILY_TARGET, path, DAILY_SPEC.lags, DAILY_SPEC.horizons)
    return audit(load_training(spark, path))
