"""Every registered query against its SQL in DuckDB on the smallest driver tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from spanloom.plans import registry

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no driver tables")


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("" if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(D):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{D}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, D).toPandas()
    if name in registry.ORACLES:
        want = duck.sql(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        a, b = rows(got.convert_dtypes()), rows(want.convert_dtypes())
        assert len(a) == len(b) and a == b
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLES) <= set(entry.oracle_sql())


def test_no_product_in_plans(spark):
    for name in ("overlap_pairs_binned", "overlap_fraction_filter", "contained_intervals"):
        plan = registry.QUERIES[name](spark, D)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
