"""Table layouts: hash distribution, round robin, replication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.operators import Distribution
from stagehouse.plans.workspace import fresh, input_table, new_warehouse


def hash_distributed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables hash on the customer key, into the same number of buckets: neither the grouping
    nor the join shuffles.  Grouping first keeps a customer with very many orders out of the join."""
    warehouse = new_warehouse(spark, sf_dir)
    orders_table, customer_table = fresh("orders"), fresh("customer")
    warehouse.write(
        input_table(spark, sf_dir, "orders"),
        orders_table,
        distribution=Distribution.hash("o_custkey"),
    )
    buckets = warehouse.entry(orders_table).buckets
    warehouse.write(
        input_table(spark, sf_dir, "customer"),
        customer_table,
        distribution=Distribution.hash("c_custkey", buckets=buckets),
    )
    orders, customer = warehouse.tables(orders_table, customer_table)
    return segment_counts(orders, customer)


def segment_counts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    per_customer = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
        .groupBy("c_mktsegment")
        .agg(F.sum("n").alias("n_orders"))
    )


def round_robin_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default layout: files follow the even splits of the scan, and nothing is shuffled."""
    warehouse = new_warehouse(spark, sf_dir)
    return warehouse.write(
        input_table(spark, sf_dir, "lineitem"),
        fresh("lineitem"),
        distribution="HEAP, DISTRIBUTION = ROUND_ROBIN",
    )


def replicated_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, table = new_warehouse(spark, sf_dir), fresh("nation")
    nation = warehouse.write(
        input_table(spark, sf_dir, "nation"), table, distribution="REPLICATE"
    )
    customer = input_table(spark, sf_dir, "customer")
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.max("c_acctbal").alias("top_balance"))
    )


QUERIES = {
    "hash_distributed_join": hash_distributed_join,
    "round_robin_write": round_robin_write,
    "replicated_dim_join": replicated_dim_join,
}

SQL = {
    "hash_distributed_join": (
        "SELECT c_mktsegment, count(*) AS n_orders FROM orders "
        "JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"
    ),
    "round_robin_write": "SELECT * FROM lineitem",
    "replicated_dim_join": (
        "SELECT n_name, count(*) AS n_customers, max(c_acctbal) AS top_balance FROM customer "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
    ),
}
