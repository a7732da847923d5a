"""Writes: staging, bulk load, the four modes, table creation, the NOT NULL guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.plans.workspace import fresh, input_table, new_warehouse


def stage_dataframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir).stage(input_table(spark, sf_dir, "supplier")).scan()


def write_new_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, sf_dir)
    return warehouse.write(input_table(spark, sf_dir, "supplier"), fresh("supplier"))


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("orders")
    orders = input_table(spark, sf_dir, "orders")
    warehouse.write(orders, table)
    return warehouse.write(orders, table, mode="append")


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write brings another schema; only it remains."""
    warehouse, table = new_warehouse(spark, sf_dir), fresh("swapped")
    warehouse.write(input_table(spark, sf_dir, "orders"), table)
    return warehouse.write(input_table(spark, sf_dir, "customer"), table, mode="overwrite")


def write_self_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("orders")
    rows = warehouse.write(input_table(spark, sf_dir, "orders"), table)
    return warehouse.write(rows.where(F.col("o_orderstatus") == "F"), table, mode="overwrite")


def write_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("orders")
    warehouse.write(input_table(spark, sf_dir, "orders"), table)
    return warehouse.write(input_table(spark, sf_dir, "customer"), table, mode="ignore")


def copy_into_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged files whose columns come in another order are matched by name."""
    warehouse, table = new_warehouse(spark, sf_dir), fresh("orders")
    orders = input_table(spark, sf_dir, "orders")
    warehouse.create_table(table, orders.schema)
    staged = warehouse.stage(orders.select(*reversed(orders.columns)))
    warehouse.copy_into(table, staged.path)
    return warehouse.table(table)


def copy_into_csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header in another order than the table's columns."""
    headed = {"csv_by_name": ("csv", {"header": "true"})}
    warehouse, table = new_warehouse(spark, sf_dir, formats=headed), fresh("orders")
    orders = input_table(spark, sf_dir, "orders")
    warehouse.create_table(table, orders.schema)
    path = f"{warehouse.area.base}/{fresh('csv')}"
    orders.select(*reversed(orders.columns)).write.option("header", True).csv(path)
    warehouse.copy_into(table, path, "csv_by_name")
    return warehouse.table(table)


def copy_into_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files of which only some have all columns."""
    warehouse, table = new_warehouse(spark, sf_dir), fresh("supplier")
    supplier = input_table(spark, sf_dir, "supplier")
    warehouse.create_table(table, supplier.schema)
    path = f"{warehouse.area.base}/{fresh('mixed')}"
    supplier.select("s_suppkey").write.parquet(path)
    supplier.write.mode("append").parquet(path)
    warehouse.copy_into(table, path)
    return warehouse.table(table)


def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("nation")
    nation = input_table(spark, sf_dir, "nation")
    for _ in range(2):
        warehouse.create_table(table, nation.schema)
    return warehouse.write(nation, table, mode="append")


def not_null_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("customer")
    customer = input_table(spark, sf_dir, "customer")
    required = T.StructType(
        [T.StructField(f.name, f.dataType, nullable=False) for f in customer.schema.fields]
    )
    warehouse.create_table(table, required)
    return warehouse.write(customer, table, mode="append")


QUERIES = {
    "stage_dataframe": stage_dataframe,
    "write_new_table": write_new_table,
    "write_append": write_append,
    "write_overwrite": write_overwrite,
    "write_self_overwrite": write_self_overwrite,
    "write_ignore": write_ignore,
    "copy_into_existing": copy_into_existing,
    "copy_into_csv_by_name": copy_into_csv_by_name,
    "copy_into_mixed_files": copy_into_mixed_files,
    "create_if_absent": create_if_absent,
    "not_null_guard": not_null_guard,
}

SQL = {
    "stage_dataframe": "SELECT * FROM supplier",
    "write_new_table": "SELECT * FROM supplier",
    "write_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "write_overwrite": "SELECT * FROM customer",
    "write_self_overwrite": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "write_ignore": "SELECT * FROM orders",
    "copy_into_existing": "SELECT * FROM orders",
    "copy_into_csv_by_name": "SELECT * FROM orders",
    "copy_into_mixed_files": (
        "SELECT * FROM supplier UNION ALL SELECT s_suppkey, NULL, NULL, NULL FROM supplier"
    ),
    "create_if_absent": "SELECT * FROM nation",
    "not_null_guard": "SELECT * FROM customer",
}
