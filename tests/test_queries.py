"""Every registered query against its SQL in DuckDB, as bags of rows."""

import math
import os
from collections import Counter

import pytest
from support import SF

import __spark_entry__ as registry

duckdb = pytest.importorskip("duckdb")

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


from stagehouse.plans import all_queries, all_sql  # noqa: E402


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query(spark, oracle, key):
    df = QUERIES[key](spark, SF)
    expected = oracle.execute(SQL[key])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, df.collect()) == bag(names, expected.fetchall())


def test_entry(spark):
    assert registry.entry(spark).columns == ["l_returnflag", "l_linestatus", "sum_qty", "n"]
