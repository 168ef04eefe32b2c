"""The driver's contract: names, columns and values of queries against their SQL, on the smallest tables."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")

import __spark_entry__ as entry  # noqa: E402
from tidemark.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    cursor = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    mine = sorted([tuple(plain(r[c]) for c in order) for r in got.collect()], key=str)
    theirs = sorted([tuple(plain(dict(zip(columns, r))[c]) for c in order) for r in cursor.fetchall()], key=str)
    assert mine == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "icp_cluster" in df.columns


def test_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
