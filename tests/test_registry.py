"""The registered queries, with their SQL, at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as registry  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = {"kmeans_aligned", "kmeans_lloyd", "agglomerate_merges", "agglomerate_centroids", "agglomerate_rounds"}
#: SQL takes minutes for a thousand rounds over all pairs; test_clustering has the same run on small tables.
NO_SQL = {"agglomerate_lineitem"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{SF}/{table}.parquet'")
    return con


#: Queries of the llm folder have their tests in tests/llm.
OWN = {q.__name__ for q in registry._QUERIES}


def test_each_query_has_its_sql():
    assert OWN - NO_SQL == set(registry.oracle_sql()) & OWN


def test_entry(spark):
    assert registry.entry(spark).count() == len(registry.SEEDS)


@pytest.mark.parametrize("name", sorted(OWN - LONG - NO_SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    rows = [tuple(r) for r in df.collect()]
    assert check.canonical(rows, df.columns) == check.canonical(cursor.fetchall(), names)
