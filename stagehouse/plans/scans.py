"""Reads: tables, queries, named locations and formats, declared schemas, short name, SQL view."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import OptionError
from stagehouse.operators import JdbcWarehouse
from stagehouse.plans.workspace import input_table, new_warehouse

PRICING_SQL = (
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n "
    "FROM lineitem GROUP BY ALL"
)

TYPED_SQL = (
    "SELECT l_orderkey AS c_long, l_linenumber AS c_int, "
    "CAST(l_linenumber AS SMALLINT) AS c_short, CAST(l_linenumber AS TINYINT) AS c_byte, "
    "l_quantity > 25 AS c_bool, CAST(l_quantity AS FLOAT) AS c_float, "
    "l_extendedprice AS c_double, CAST(l_quantity AS DECIMAL(10,2)) AS c_dec10, "
    "l_returnflag AS c_str, CAST(l_shipdate AS DATE) AS c_date, l_shipdate AS c_ntz "
    "FROM lineitem"
)

# The typed columns, and text that is hard on text formats: chr(92) is a backslash, chr(34) a quote.
HARD_TEXT_SQL = TYPED_SQL.replace(
    " FROM lineitem",
    ", CASE WHEN l_linenumber % 2 = 0 THEN '' END AS c_blank, "
    "concat('  a, ', chr(34), l_returnflag, chr(34), chr(10), chr(92), 'N', chr(13), chr(92), 'n ') "
    "AS c_hard, CASE WHEN l_linenumber > 2 THEN concat(chr(92), 'N') END AS c_mark FROM lineitem",
)

NESTED_SQL = "SELECT vec_id, embedding, label FROM embeddings"

VIEW_SQL = (
    "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {orders} "
    "GROUP BY o_orderpriority"
)


def staged_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "lineitem").read(table="lineitem")


def staged_query_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "lineitem").read(query=PRICING_SQL)


def unload_then_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "orders").unload("orders").scan()


def named_location_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "orders").read(table="orders", location="exports")


def named_format_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "orders").read(table="orders", file_format="columnar")


def named_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = {"lines": ("json", {})}
    warehouse = new_warehouse(spark, sf_dir, "lineitem", formats=formats)
    return warehouse.read(query=HARD_TEXT_SQL, file_format="lines")


def named_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    formats = {"commas": ("csv", {})}
    warehouse = new_warehouse(spark, sf_dir, "lineitem", formats=formats)
    return warehouse.read(query=HARD_TEXT_SQL, file_format="commas")


def declared_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reader itself widens ``c_nationkey`` to bigint while it decodes the column."""
    staged = new_warehouse(spark, sf_dir, "customer").unload("customer")
    declared = T.StructType(
        [
            T.StructField(f.name, T.LongType() if f.name == "c_nationkey" else f.dataType)
            for f in staged.schema.fields
        ]
    )
    return staged.scan(declared)


def user_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = T.StructType.fromDDL("p_size INT, p_name STRING, p_partkey BIGINT")
    return new_warehouse(spark, sf_dir, "part").read(table="part", schema=wanted)


def typed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "lineitem").read(query=TYPED_SQL)


def nested_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_warehouse(spark, sf_dir, "embeddings").read(query=NESTED_SQL)


def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter and projection reach the scan of the staged files."""
    rows = new_warehouse(spark, sf_dir, "lineitem").read(table="lineitem")
    return rows.where(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber")


@contextmanager
def _database(spark: SparkSession, sf_dir: str, key: str) -> Iterator[JdbcWarehouse]:
    """The database that ``spark.stagehouse.jdbc.url`` names, which executors must reach.  A local
    session that names none uses embedded Derby in memory, visible to its own process only."""
    url = spark.conf.get("spark.stagehouse.jdbc.url", None)
    embedded = None
    if url is None:
        if not spark.sparkContext.master.startswith("local"):
            raise OptionError("spark.stagehouse.jdbc.url must name a database executors can reach")
        embedded = f"jdbc:derby:memory:stagehouse_{uuid.uuid4().hex}"
        url = f"{embedded};create=true"
    catalog = new_warehouse(spark, sf_dir)
    try:
        yield JdbcWarehouse(
            spark,
            url,
            catalog.area.base,
            user=spark.conf.get("spark.stagehouse.jdbc.user", "app"),
            password=spark.conf.get("spark.stagehouse.jdbc.password", "app"),
            rename="RENAME TABLE {old} TO {new}" if embedded else None,
            partition_columns=[key],
            num_partitions=max(4, spark.sparkContext.defaultParallelism),
        )
    finally:
        if embedded:
            _forget(spark, embedded)


def jdbc_staged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into a database, out of it in slices of the order key, staged and scanned."""
    with _database(spark, sf_dir, "o_orderkey") as database:
        table = f"orders_{uuid.uuid4().hex[:12]}"
        try:
            database.write(input_table(spark, sf_dir, "orders"), table)
            return database.read(table=table)
        finally:
            database.drop_table(table)


def jdbc_long_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, and their bytes as a binary column, through a database in its own types."""
    with _database(spark, sf_dir, "doc_id") as database:
        table = f"documents_{uuid.uuid4().hex[:12]}"
        docs = input_table(spark, sf_dir, "documents")
        try:
            database.write(docs.withColumn("raw", F.encode("text", "utf-8")), table)
            back = database.read(table=table)
        finally:
            database.drop_table(table)
    return back.select(*docs.columns, F.md5("raw").alias("raw_md5"))


def _forget(spark: SparkSession, embedded: str) -> None:
    """Free an in-memory Derby database; Derby reports success as an exception."""
    try:
        spark._jvm.java.sql.DriverManager.getConnection(f"{embedded};drop=true")
    except Py4JJavaError:
        pass


def format_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged directory in its own format, by the reader's path option."""
    staged = new_warehouse(spark, sf_dir, "orders").unload("orders")
    reader = spark.read.format(staged.format).options(**staged.options).schema(staged.schema)
    return reader.option("path", staged.path).load()


def staged_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = new_warehouse(spark, sf_dir, "orders").unload("orders")
    view = f"staged_orders_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TEMPORARY VIEW {view} USING parquet OPTIONS (path '{staged.path}')")
    return spark.sql(VIEW_SQL.format(orders=view))


QUERIES = {
    "staged_table_scan": staged_table_scan,
    "staged_query_scan": staged_query_scan,
    "unload_then_scan": unload_then_scan,
    "named_location_scan": named_location_scan,
    "named_format_scan": named_format_scan,
    "named_json_scan": named_json_scan,
    "named_csv_scan": named_csv_scan,
    "declared_schema_scan": declared_schema_scan,
    "user_schema_scan": user_schema_scan,
    "typed_round_trip": typed_round_trip,
    "nested_round_trip": nested_round_trip,
    "scan_filter_project": scan_filter_project,
    "jdbc_staged_scan": jdbc_staged_scan,
    "jdbc_long_text": jdbc_long_text,
    "format_scan": format_scan,
    "staged_view_sql": staged_view_sql,
}

SQL = {
    "staged_table_scan": "SELECT * FROM lineitem",
    "staged_query_scan": PRICING_SQL,
    "unload_then_scan": "SELECT * FROM orders",
    "named_location_scan": "SELECT * FROM orders",
    "named_format_scan": "SELECT * FROM orders",
    "named_json_scan": HARD_TEXT_SQL,
    "named_csv_scan": HARD_TEXT_SQL,
    "declared_schema_scan": (
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer"
    ),
    "user_schema_scan": "SELECT p_size, p_name, p_partkey FROM part",
    "typed_round_trip": TYPED_SQL,
    "nested_round_trip": NESTED_SQL,
    "scan_filter_project": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45",
    "jdbc_staged_scan": "SELECT * FROM orders",
    "jdbc_long_text": "SELECT *, md5(text) AS raw_md5 FROM documents",
    "format_scan": "SELECT * FROM orders",
    "staged_view_sql": VIEW_SQL.format(orders="orders"),
}
