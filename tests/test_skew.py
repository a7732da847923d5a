"""The registered queries on tables where one key holds a third of the rows, and some keys are null."""

import os

import pytest
from support import SF
from pyspark.sql import functions as F

import __spark_entry__ as registry
from test_queries import bag

duckdb = pytest.importorskip("duckdb")

KEYS = {"orders": ("o_custkey", 7), "lineitem": ("l_suppkey", 3), "customer": ("c_nationkey", 5)}
QUERIES = [
    "query_join",
    "query_semi_join",
    "query_anti_join",
    "query_aggregate",
    "query_window",
    "query_set_ops",
    "hash_distributed_join",
    "replicated_dim_join",
    "write_self_overwrite",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        df = spark.read.parquet(f"{SF}/{file}")
        if name in KEYS:
            key, hot = KEYS[name]
            dealt = F.pmod(F.hash(*df.columns), F.lit(30))
            df = df.withColumn(
                key,
                F.when(dealt < 12, F.lit(hot)).when(dealt == 12, F.lit(None)).otherwise(F.col(key))
                .cast(df.schema[key].dataType),
            )
        if name == "orders":
            df = df.withColumn("o_orderdate", F.expr("if(o_orderkey % 40 = 0, null, o_orderdate)"))
        df.coalesce(1).write.parquet(f"{folder}/{file}")
    return folder


@pytest.mark.parametrize("key", QUERIES)
def test_query_on_skewed_tables(spark, skewed, key):
    oracle = duckdb.connect()
    oracle.execute("SET default_null_order = 'nulls_first'")
    for file in os.listdir(skewed):
        name = file.removesuffix(".parquet")
        oracle.execute(f"CREATE VIEW {name} AS SELECT * FROM '{skewed}/{file}/*.parquet'")
    df = registry.queries()[key](spark, skewed)
    expected = oracle.execute(registry.oracle_sql()[key])
    names = [c[0] for c in expected.description]
    assert bag(df.columns, df.collect()) == bag(names, expected.fetchall())
