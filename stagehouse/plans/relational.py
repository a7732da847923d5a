"""SELECT texts handed to ``read(query=...)``: the warehouse runs them, only results are staged.

Where one key may hold a large part of the rows, the text given to Spark combines rows per key
before it joins; the plain text is the one to compare with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagehouse.operators.running import number_rows
from stagehouse.plans.workspace import new_warehouse

# Orders are combined per customer, then per nation, so no hot customer or nation is shuffled whole.
JOIN = """
SELECT n.n_name, sum(t.n_orders) AS n_orders, round(sum(t.total), 2) AS total
FROM (SELECT c.c_nationkey, sum(o.n_orders) AS n_orders, sum(o.total) AS total
      FROM (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total
            FROM orders GROUP BY o_custkey) o
      JOIN customer c ON o.o_custkey = c.c_custkey
      GROUP BY c.c_nationkey) t
JOIN nation n ON t.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""

# Buyers are made distinct before the join: a semi join cannot split a hot key of its right side.
SEMI_JOIN = """
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) b
              WHERE b.o_custkey = c_custkey)
"""

ANTI_JOIN = SEMI_JOIN.replace("WHERE EXISTS", "WHERE NOT EXISTS")

AGGREGATE = """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
       count(DISTINCT l_suppkey) AS n_supp, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""

ROLLUP = """
SELECT o_orderstatus, o_orderpriority, count(*) AS n
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
"""

TOPK = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
"""

SET_OPS = """
(SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R'
 EXCEPT SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
UNION ALL
(SELECT DISTINCT o_custkey AS k FROM orders
 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
"""

SCALARS = """
SELECT o_orderkey, upper(substring(o_orderpriority, 1, 3)) AS pri,
       CAST(year(o_orderdate) AS BIGINT) AS y, CAST(floor(o_totalprice) AS BIGINT) AS whole,
       coalesce(nullif(o_orderstatus, 'F'), 'done') AS st
FROM orders
"""

_TEXTS = {
    "query_join": (JOIN, ("orders", "customer", "nation")),
    "query_semi_join": (SEMI_JOIN, ("orders", "customer")),
    "query_anti_join": (ANTI_JOIN, ("orders", "customer")),
    "query_aggregate": (AGGREGATE, ("lineitem",)),
    "query_rollup": (ROLLUP, ("orders",)),
    "query_topk": (TOPK, ("orders",)),
    "query_set_ops": (SET_OPS, ("lineitem", "supplier", "orders", "customer")),
    "query_scalars": (SCALARS, ("orders",)),
}


def _through_query(text: str, tables: tuple[str, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return new_warehouse(spark, sf_dir, *tables).read(query=text)

    return run


def query_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders numbered by date, each with the order before.  Ranges of (customer, date,
    order) are numbered by themselves and carried on, so no customer has to fit into one task."""
    warehouse = new_warehouse(spark, sf_dir, "orders")
    orders = warehouse.read(query="SELECT o_custkey, o_orderdate, o_orderkey FROM orders")
    return number_rows(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        warehouse.area,
        previous={"prev_order": "o_orderkey"},
    ).select("o_custkey", "o_orderkey", "rn", "prev_order")


QUERIES = {key: _through_query(text, tables) for key, (text, tables) in _TEXTS.items()}
QUERIES["query_window"] = query_window

SQL = {
    "query_join": (
        "SELECT n.n_name, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS total "
        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
        "JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"
    ),
    "query_semi_join": (
        "SELECT c_custkey, c_name FROM customer WHERE EXISTS "
        "(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"
    ),
    "query_anti_join": (
        "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS "
        "(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"
    ),
    "query_aggregate": AGGREGATE,
    "query_rollup": ROLLUP,
    "query_window": (
        "SELECT o_custkey, o_orderkey, "
        "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) "
        "AS BIGINT) AS rn, "
        "lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) "
        "AS prev_order FROM orders"
    ),
    "query_topk": TOPK,
    "query_set_ops": (
        "(SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' "
        "EXCEPT SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) UNION ALL "
        "(SELECT o_custkey AS k FROM orders "
        "INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0)"
    ),
    "query_scalars": SCALARS,
}
