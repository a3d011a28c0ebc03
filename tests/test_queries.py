"""A few registered queries against their SQL twins on the smallest data; `python -m checks.compare` runs all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from checks import load
from checks.compare import TABLES, compare

SF = "/root/testdata/sf0.001"
NAMES = (
    "header_metadata", "norm_surrogate_keys", "prof_nulls", "latest_other", "fill_bounded", "samples_daily",
    "impute_median", "scaler_fit", "horizon_metrics", "pivot_rmse", "reject_reasons", "delete_keys",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_counts_all_samples(spark):
    rows = entry_module.entry(spark).collect()
    assert sum(r.n for r in rows) == 127 * 6


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    text, good = compare(spark, con, name, entry_module.queries()[name], entry_module.oracle_sql()[name], SF)
    assert good, text


def test_every_query_has_sql():
    queries, sql = load()
    assert set(queries) == set(sql)
