"""Every registered query against its DuckDB oracle on the smallest tables,
plus repartition-invariance of the order-dependent ones (metamorphic)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import key, norm  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from vigil.plans import catalog, oracle  # noqa: E402
from vigil.sources.io import DRIVER_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql()) and set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = sorted((tuple(norm(x) for x in r) for r in sdf.collect()), key=key)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(sdf.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    drows = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=key)
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["district", "n", "percent"] and df.count() > 0
