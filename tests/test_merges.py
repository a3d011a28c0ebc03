"""Loads that append, summaries that merge, best rows by narrow aggregates."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from rillcast.operators import normalize as nz
from rillcast.operators import rollup
from rillcast.operators.scan import best_rows, ordered_numbers, packed
from rillcast.sources import loads

TIME = dt.datetime(2024, 1, 1)


def staging_rows(spark, rows):
    """Staging rows of (id, site, variable, unit, owner, value); all other metadata is null."""
    given = {"site_code", "site_name", "variable_code", "variable_name", "unit_name", "method_name", "method_code", "owner_name"}
    full = [(i, s, f"Site {s}", v, f"Name {v}", u, "M", "m", o, TIME + dt.timedelta(hours=i), x) for i, s, v, u, o, x in rows]
    df = spark.createDataFrame(
        full, "staging_id long, site_code string, site_name string, variable_code string, variable_name string, unit_name string, "
        "method_name string, method_code string, owner_name string, datetime_utc timestamp_ntz, value double")
    return df.withColumns({c: F.lit(None).cast("double" if c in ("latitude", "longitude", "elevation_m") else "string") for c in nz.META_COLUMNS if c not in given})


def named(tables):
    """Facts by the names behind their keys."""
    t = tables
    rows = (
        t["datastream"].join(t["site"].select("site_id", "site_code"), "site_id")
        .join(t["variable"].select("variable_id", "variable_code", "unit_id"), "variable_id")
        .join(t["unit"].select("unit_id", F.col("name").alias("unit")), "unit_id")
        .join(t["owner"].select("owner_id", F.col("name").alias("owner")), "owner_id", "left")
    )
    return sorted(map(tuple, rows.select("datastream_id", "site_code", "variable_code", "unit", F.coalesce("owner", F.lit("-")), "value").collect()))


def test_two_loads_equal_one(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice("ABC"), rng.choice("xy"), rng.choice(["u1", "u2"]), rng.choice([None, "o1", "o2"]), float(i)) for i in range(60)]
    rows += [(60 + i, "D", "z", "u3", "o3", float(i)) for i in range(5)] + [(70, "A", "x", "u1", None, 1.0)]
    both, path = str(tmp_path / "both"), str(tmp_path / "one")
    loads.load(staging_rows(spark, rows[:30]), both, 0)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "both").rglob("*.parquet")}
    keys = {n: {tuple(r) for r in loads.stored(spark, both, n).collect()} for n in ("site", "unit", "owner", "variable")}
    loads.load(staging_rows(spark, rows[30:]), both, 1)
    loads.load(staging_rows(spark, rows[30:]), both, 1)  # as after a failure
    loads.load(staging_rows(spark, rows), path, 0)
    two, one = ({n: loads.stored(spark, p, n) for n in loads.TABLES} for p in (both, path))
    assert named(two) == named(one) and len(named(one)) == 66
    assert all(f.stat().st_mtime_ns == at for f, at in files.items())
    for n, before in keys.items():
        after = [tuple(r) for r in two[n].collect()]
        assert before <= set(after) and sorted(r[f"{n}_id"] for r in two[n].collect()) == list(range(1, len(after) + 1))
    # A load that brings nothing new keys nothing.
    loads.load(staging_rows(spark, rows[:3]), both, 2)
    assert loads.stored(spark, both, "metadata").count() == two["metadata"].count()


def test_summaries_merge(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 2]), rng.choice([1, None]), TIME + dt.timedelta(hours=rng.randrange(80)) if rng.random() < 0.9 else None,
             None if rng.random() < 0.2 else float(rng.randrange(9))) for i in range(200)]
    facts = spark.createDataFrame(rows, "datastream_id long, site_id int, variable_id int, datetime_utc timestamp_ntz, value double")
    parts = [rollup.series_days(facts.where(F.col("datastream_id") % 3 == k)) for k in range(3)]
    merged = rollup.merged_days(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    order = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert order(merged) == order(rollup.series_days(facts))
    got = rollup.overview_of(merged).first()
    values = [r[4] for r in rows if r[4] is not None]
    assert (got.row_count, got.null_values, got.min_value, got.max_value) == (200, 200 - len(values), min(values), max(values))
    assert abs(got.avg_value - sum(values) / len(values)) < 1e-12
    empty = rollup.overview_of(rollup.series_days(facts.where("false"))).first()
    assert (empty.row_count, empty.avg_value) == (0, None)


def test_cubes_add_up(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2]), rng.choice(["winter", "spring"]), rng.choice(["0-6", "6-12"]), rng.random(), rng.random(), rng.random()) for _ in range(120)]
    long = spark.createDataFrame(rows, "site_id int, season string, horizon_bin string, y_true double, y_pred double, y_persistence double")
    half = F.col("y_true") < 0.4
    cube = rollup.added_cubes(rollup.error_cube(long.where(half)).unionByName(rollup.error_cube(long.where(~half))))
    got = {(r.level, r.site_id, r.season, r.horizon_bin): r for r in rollup.cube_metrics(cube).collect()}
    assert len(got) == 1 + 4 + 8 + 4
    for (level, *key), r in got.items():
        own = [x for x in rows if all(k is None or k == v for k, v in zip(key, x))]
        rmse = (sum((x[3] - x[4]) ** 2 for x in own) / len(own)) ** 0.5
        assert r.n == len(own) and abs(r.rmse - rmse) < 1e-12 and level == ",".join(n for n, k in zip(rollup.CUBE_KEYS, key) if k is not None)


def test_best_rows_are_whole_and_single(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, None]), rng.choice(["a", "b"]), rng.randrange(-3, 3), rng.choice("pqr")) for _ in range(80)]
    df = spark.createDataFrame(rows, "k int, l string, v int, extra string").repartition(5)
    best = best_rows(df, ["k", "l"], packed(F.lit(0), F.col("v").cast("long")))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    got = {(r.k, r.l): (r.v, r.extra) for r in best.collect()}
    assert best.count() == len(got) == len({r[:2] for r in rows})
    for key, (v, extra) in got.items():
        own = [r for r in rows if r[:2] == key]
        assert v == max(r[2] for r in own) and (*key, v, extra) in own


def test_numbers_rise_with_the_order(spark):
    rows = [(v, p) for v in (None, 1.5, 0.5) for p in ("b", "a", None)] * 2
    numbers = ordered_numbers(spark.createDataFrame(rows, "v double, p string"), ["v", "p"], "n").collect()
    key = lambda r: (r.v is None, r.v or 0, r.p is None, r.p or "")
    assert [key(r) for r in sorted(numbers, key=lambda r: r.n)] == sorted(map(key, numbers)) and len(numbers) == 9
    df = spark.range(1)
    edge = df.select(packed(F.lit(2**61), F.lit(2**63 - 1)).alias("a"), packed(F.lit(0), F.lit(-(2**63))).alias("b")).first()
    assert edge.a == Decimal(2**61 * 2**64 + 2**64 - 1) and edge.b == 0
