import decimal
import os

import pytest
from support import plan_of, same_rows
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import OptionError, SchemaError

ALL_TYPES = (
    "c_bool boolean, c_byte tinyint, c_short smallint, c_int int, c_long bigint, c_float float, "
    "c_double double, c_dec10 decimal(10,2), c_dec38 decimal(38,18), c_udec decimal(20,0), "
    "c_str string, c_bin binary, c_date date, c_ts timestamp, c_ntz timestamp_ntz, "
    "c_arr array<int>, c_map map<string,int>, c_struct struct<k:int>"
)


@pytest.fixture(scope="module")
def typed(spark):
    values = spark.sql(
        "SELECT true, 1Y, -2S, 3, 4L, CAST(1.5 AS FLOAT), 2.5D, 12345678.91BD, "
        "CAST('12345678901234567890.123456789012345678' AS DECIMAL(38,18)), "
        "CAST('18446744073709551615' AS DECIMAL(20,0)), 'ü', X'00FF', DATE'1582-10-15', "
        "TIMESTAMP'2024-02-29 23:59:59.123456', TIMESTAMP_NTZ'2024-02-29 23:59:59.123456', "
        "array(1, null), map('a', 1), named_struct('k', 7)"
    )
    schema = T.StructType.fromDDL(ALL_TYPES)
    nulls = spark.createDataFrame([Row(*[None] * len(schema))], schema)
    return values.toDF(*schema.names).select(
        [F.col(f.name).cast(f.dataType) for f in schema.fields]
    ).unionByName(nulls)


@pytest.mark.parametrize("file_format", [None, "columnar"])
def test_every_type_survives_the_round_trip(warehouse, typed, file_format):
    typed.createOrReplaceTempView("typed")
    back = warehouse.read(table="typed", file_format=file_format)
    assert back.dtypes == typed.dtypes
    assert [r.asDict(True) for r in back.orderBy("c_int").collect()] == [
        r.asDict(True) for r in typed.orderBy("c_int").collect()
    ]


def test_every_type_survives_a_table(warehouse, typed, table):
    back = warehouse.write(typed, table)
    assert back.dtypes == typed.dtypes
    assert back.where("c_int = 3").first()["c_dec10"] == decimal.Decimal("12345678.91")


def test_read_is_a_snapshot_exported_once(spark, warehouse, orders, table):
    warehouse.write(orders, table)
    before = len(warehouse.area)
    snapshot = warehouse.read(table=table)
    assert len(warehouse.area) == before + 1
    rows = snapshot.count()
    warehouse.write(orders.limit(5), table, mode="append")
    warehouse.write(orders.limit(5), table, mode="overwrite")
    assert snapshot.count() == rows == orders.count()
    assert len(warehouse.area) == before + 2  # the retired version


def test_query_runs_before_the_export(warehouse, orders):
    orders.createOrReplaceTempView("o_view")
    staged = warehouse.unload("SELECT o_orderstatus, count(*) AS n FROM o_view GROUP BY 1")
    assert staged.rows == staged.scan().count() == orders.select("o_orderstatus").distinct().count()


def test_unload_takes_frame_table_or_text(warehouse, orders, table):
    warehouse.write(orders, table)
    for source in (orders, table, f"default.{table}", f"SELECT * FROM {table}"):
        assert warehouse.unload(source).rows == orders.count()


def test_pushdown_and_pruning_reach_the_staged_files(warehouse, orders):
    orders.createOrReplaceTempView("o_view")
    part = warehouse.read(table="o_view").where("o_totalprice > 1000").select("o_orderkey")
    plan = plan_of(part)
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "Batched: true" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_named_location_and_format(warehouse, orders, tmp_path):
    orders.createOrReplaceTempView("o_view")
    read = warehouse.read(table="o_view", location="lake", file_format="columnar")
    assert same_rows(read, orders)
    kept = warehouse.unload("o_view", location="lake", file_format="lines")
    assert os.path.dirname(kept.path) == str(tmp_path / "lake")
    assert kept.format == "json" and kept.path not in warehouse.area
    assert same_rows(kept.scan(), orders)
    with pytest.raises(OptionError, match="unknown location 'x', known: lake"):
        warehouse.read(table="o_view", location="x")
    with pytest.raises(OptionError, match="unknown file format 'x'"):
        warehouse.read(table="o_view", file_format="x")


def test_declared_schema_matches_by_name_and_widens(warehouse, customer):
    staged = warehouse.stage(customer)
    declared = T.StructType.fromDDL("C_NATIONKEY BIGINT, c_custkey BIGINT")
    out = staged.scan(declared)
    assert out.dtypes == [("C_NATIONKEY", "bigint"), ("c_custkey", "bigint")]
    assert out.agg(F.sum("C_NATIONKEY")).first()[0] == customer.agg(F.sum("c_nationkey")).first()[0]


def test_user_schema(warehouse, customer):
    customer.createOrReplaceTempView("c_view")
    wanted = T.StructType.fromDDL("c_name STRING, c_nationkey DECIMAL(12,0)")
    assert warehouse.read(table="c_view", schema=wanted).schema == wanted
    before = len(warehouse.area)
    for bad in ("nothere INT", "c_custkey INT"):
        with pytest.raises(SchemaError):
            warehouse.read(table="c_view", schema=T.StructType.fromDDL(bad))
    assert len(warehouse.area) == before


def test_schema_without_a_job(spark, warehouse, table):
    schema = T.StructType.fromDDL("a BIGINT NOT NULL, b STRING")
    warehouse.create_table(table, schema)
    spark.sparkContext.setJobGroup("schema", "no job expected")
    try:
        assert warehouse.schema_of(table=table) == schema
        found = warehouse.schema_of(query=f"SELECT a + 1 AS x, count(*) AS n FROM {table} GROUP BY 1")
        assert found.simpleString() == "struct<x:bigint,n:bigint>"
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("schema")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_source_errors(warehouse):
    for given in ({}, {"table": "a", "query": "select 1"}):
        with pytest.raises(OptionError, match="either a table or a query"):
            warehouse.read(**given)
    with pytest.raises(SchemaError, match="nosuch"):
        warehouse.read(table="nosuch")
    with pytest.raises(SchemaError, match="nosuch"):
        warehouse.read(query="SELECT * FROM nosuch")


def test_staged_view_in_sql(spark, warehouse, orders, table):
    staged = warehouse.stage(orders)
    spark.sql(f"CREATE TEMPORARY VIEW {table} USING parquet OPTIONS (path '{staged.path}')")
    assert spark.sql(f"SELECT count(*) FROM {table}").first()[0] == orders.count()
