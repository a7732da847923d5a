"""Tables of another catalog of the session, here Spark's JDBC catalog over embedded Derby."""

import uuid

import pytest
from pyspark.sql import functions as F
from support import same_rows

from stagehouse import Distribution, OptionError, SchemaError


@pytest.fixture(scope="module")
def other(spark):
    name = f"other_{uuid.uuid4().hex[:8]}"
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set(f"{prefix}.url", f"jdbc:derby:memory:{name};create=true")
    spark.conf.set(f"{prefix}.user", "app")
    spark.conf.set(f"{prefix}.password", "app")
    return f"{name}.APP"


def test_write_modes(spark, warehouse, other, table):
    name, rows = f"{other}.{table}", spark.range(20).selectExpr("id", "CAST(id AS STRING) AS s")
    assert not warehouse.exists(name)
    assert same_rows(warehouse.write(rows, name), rows)
    with pytest.raises(OptionError, match="exists already"):
        warehouse.write(rows, name)
    more = rows.select("s", "id")
    assert same_rows(warehouse.write(more, name, mode="append"), rows.unionAll(rows))
    assert warehouse.write(rows.limit(1), name, mode="ignore").count() == 40
    with pytest.raises(SchemaError, match="has no column x"):
        warehouse.write(rows.withColumn("x", F.lit(1)), name, mode="append")
    with pytest.raises(OptionError, match="cannot replace"):
        warehouse.write(rows, name, mode="overwrite")
    with pytest.raises(OptionError, match="spark_catalog"):
        warehouse.write(rows, f"{name}_h", distribution=Distribution.hash("id"))
    with pytest.raises(OptionError, match="spark_catalog"):
        warehouse.write(rows, name, mode="append", batch=("s", 1))
    assert not warehouse.exists(f"{name}_h") and warehouse.table(name).count() == 40
    warehouse.drop_table(name)
    warehouse.drop_table(name)
    assert not warehouse.exists(name)


def test_create_copy_read_and_unload(spark, warehouse, other, table, orders):
    name = f"{other}.{table}"
    warehouse.create_table(name, orders.schema)
    warehouse.create_table(name, orders.schema)
    staged = warehouse.unload(orders.select(*reversed(orders.columns)))
    assert warehouse.copy_into(name, staged.path) == orders.count()
    assert same_rows(warehouse.read(table=name), orders)
    assert warehouse.unload(name).rows == orders.count()
    query = f"SELECT o_custkey, count(*) AS n FROM {name} GROUP BY o_custkey"
    expected = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    assert same_rows(warehouse.read(query=query), expected)
    assert warehouse.schema_of(table=name).names == orders.columns


def test_a_failed_append_is_an_error_and_unknown_catalogs_are_refused(spark, warehouse, other, table):
    with pytest.raises(OptionError, match="session catalog is"):
        warehouse.write(spark.range(1), f"nosuch_catalog.db.{table}")
