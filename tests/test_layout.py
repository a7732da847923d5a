import glob
import os

import pytest
from support import exchanges, plan_of, same_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import Distribution, OptionError, SchemaError
from stagehouse.operators import layout as layout_module
from stagehouse.plans.layouts import segment_counts
from stagehouse.operators.layout import (
    BucketSpread,
    cluster_by_bucket,
    count_buckets,
    slice_buckets,
)


@pytest.mark.parametrize(
    "text, columns",
    [
        ("HASH(o_custkey)", ("o_custkey",)),
        ("hash([o_custkey])", ("o_custkey",)),
        ("HASH (a, b)", ("a", "b")),
        ("HEAP, DISTRIBUTION = HASH([a],[b])", ("a", "b")),
        ("DISTRIBUTION=hash(`a`)", ("a",)),
    ],
)
def test_parse_hash(text, columns):
    layout = Distribution.parse(text)
    assert (layout.kind, layout.columns) == ("hash", columns)


def test_parse_others():
    assert Distribution.parse(None) == Distribution()
    assert Distribution.parse("").kind == "round_robin"
    assert Distribution.parse("HEAP, DISTRIBUTION = ROUND_ROBIN").other == ("HEAP",)
    assert Distribution.parse("REPLICATE").kind == "replicate"
    both = Distribution.parse("CLUSTERED INDEX (a, b), DISTRIBUTION = REPLICATE")
    assert (both.kind, both.other) == ("replicate", ("CLUSTERED INDEX (a, b)",))
    assert Distribution.parse("CLUSTERED COLUMNSTORE INDEX").other == (
        "CLUSTERED COLUMNSTORE INDEX",
    )
    for bad in ("HASH(a), REPLICATE", "HASH()", "HASH(a,,b)"):
        with pytest.raises(OptionError):
            Distribution.parse(bad)


def test_check_compares_whole_names_ignoring_case():
    grid = T.StructType.fromDDL("grid INT, Id2 INT")
    with pytest.raises(SchemaError, match="distribution column id not in"):
        Distribution.hash("id").check(grid)
    assert Distribution.hash("GRID", "id2").check(grid).columns == ("grid", "Id2")


def test_bucket_count_follows_the_data():
    by_key = Distribution.hash("a")
    assert by_key.sized(0).buckets == 8
    assert by_key.sized(100 << 40).buckets == layout_module.MAX_BUCKETS
    assert by_key.sized(10 << 30).buckets == 16
    assert Distribution.hash("a", buckets=5).sized(10 << 40).buckets == 5


def test_wrong_column_is_refused_before_any_job(warehouse, orders, table):
    with pytest.raises(SchemaError):
        warehouse.write(orders, table, distribution="HASH(cust)")
    assert len(warehouse.area) == 0 and not warehouse.exists(table)


def test_hash_join_and_grouping_without_shuffle(spark, warehouse, orders, customer, table):
    by_orders = Distribution.hash("o_custkey", buckets=4)
    by_customer = Distribution.hash("c_custkey", buckets=4)
    o = warehouse.write(orders, table, distribution=by_orders)
    c = warehouse.write(customer, f"{table}_c", distribution=by_customer)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(o.join(c, o["o_custkey"] == c["c_custkey"])) == 0
        assert exchanges(segment_counts(o, c)) == 1  # the result, by segment
        assert exchanges(orders.join(customer, F.expr("o_custkey = c_custkey"))) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert exchanges(o.groupBy("o_custkey").count()) == 0
    assert same_rows(o, orders) and same_rows(c, customer)


def test_one_file_per_bucket_and_the_bucket_spark_expects(spark, warehouse, orders, table):
    warehouse.write(orders, table, distribution=Distribution.hash("o_custkey", buckets=4))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    files = glob.glob(os.path.join(warehouse.entry(table).location.removeprefix("file:"), "*.parquet"))
    assert len(files) == 4
    one = spark.table(table).where("o_custkey = 7")
    assert "SelectedBucketsCount: 1 out of 4" in plan_of(one.groupBy("o_custkey").count())
    assert one.count() == orders.where("o_custkey = 7").count()


def hot_orders(orders):
    """A third of all rows, and more, under one key, many of them copies of one row."""
    hot = orders.limit(1).select(*orders.columns, F.explode(F.sequence(F.lit(1), F.lit(900))))
    return orders.unionByName(hot.drop("col")).unionByName(
        orders.limit(600).withColumn("o_custkey", F.lit(1).cast("bigint"))
    )


def test_hot_bucket_is_loaded_by_many_tasks(spark, warehouse, orders, monkeypatch):
    monkeypatch.setattr(layout_module, "FILE_BYTES", 400)
    rows = hot_orders(orders)
    layout = Distribution.hash("o_custkey", buckets=16)
    staged = warehouse.stage(rows)
    counts = count_buckets(staged.scan(), layout)
    slices = slice_buckets(counts, 16, staged_bytes=16000)
    assert sum(counts.values()) == staged.rows and max(slices) > 5
    placed = cluster_by_bucket(staged.scan(), layout, slices)
    assert placed.columns == orders.columns
    per_task = (
        placed.select(
            F.spark_partition_id().alias("task"),
            F.pmod(F.hash("o_custkey"), F.lit(16)).alias("bucket"),
        )
        .groupBy("task")
        .agg(F.countDistinct("bucket").alias("buckets"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    assert all(t["buckets"] == 1 for t in per_task)
    assert max(t["rows"] for t in per_task) <= 2 * 400 / 16000 * staged.rows
    assert same_rows(placed, rows)


@pytest.mark.parametrize(
    "buckets, largest, rows, size, by_bucket",
    [
        (8, 0, 0, 0, True),
        (8, 20, 100, 1 << 30, True),  # even
        (64, 40, 100, 1 << 20, True),  # hot, but small
        (64, 40, 100, 10 << 30, False),  # hot
        (8, 13, 100, 100 << 40, False),  # even, but too few buckets for the data
        (65536, 2, 65536, 100 << 40, True),
    ],
)
def test_when_to_scan_by_bucket(buckets, largest, rows, size, by_bucket):
    assert BucketSpread(buckets, largest, rows, size).by_bucket is by_bucket


def test_table_with_a_hot_bucket_is_scanned_in_even_splits(
    warehouse, orders, customer, table, monkeypatch
):
    monkeypatch.setattr(layout_module, "HOT_BYTES", 100)
    rows = hot_orders(orders)
    warehouse.write(rows, table, distribution=Distribution.hash("o_custkey", buckets=16))
    warehouse.write(
        customer, f"{table}_c", distribution=Distribution.hash("c_custkey", buckets=16)
    )
    alone = warehouse.table(f"{table}_c")
    assert "Bucketed: true" in plan_of(alone.groupBy("c_custkey").count())
    o, c = warehouse.tables(table, f"{table}_c")
    for frame, key in ((o, "o_custkey"), (c, "c_custkey")):
        assert "Bucketed: true" not in plan_of(frame.groupBy(key).count())
    assert same_rows(o, rows) and same_rows(c, customer)


def test_query_text_on_a_hot_bucket_is_shuffled(spark, warehouse, orders, customer, table, monkeypatch):
    by = lambda key: Distribution.hash(key, buckets=16)
    warehouse.write(hot_orders(orders), table, distribution=by("o_custkey"))
    warehouse.write(customer, f"{table}_c", distribution=by("c_custkey"))
    join = f"SELECT * FROM {table} JOIN {table}_c ON o_custkey = c_custkey"
    inner = (
        f"SELECT c_custkey, count(*) AS n FROM {table}_c "
        f"WHERE c_custkey IN (SELECT o_custkey FROM {table}) GROUP BY c_custkey"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    exported = []
    import stagehouse.operators.warehouse as module

    stage = module.stage
    monkeypatch.setattr(module, "stage", lambda df, *a: exported.append(df) or stage(df, *a))
    try:
        for text in (join, inner):
            assert "Exchange hashpartitioning" not in plan_of(warehouse.source(query=text))
        expected = [sorted(map(repr, warehouse.source(query=t).collect())) for t in (join, inner)]
        monkeypatch.setattr(layout_module, "HOT_BYTES", 100)
        for text, rows in zip((join, inner), expected):
            exported.clear()
            assert sorted(map(repr, warehouse.read(query=text).collect())) == rows
            warehouse.unload(text)
            for df in exported:
                assert exchanges(df) >= 2 and "Bucketed: true" not in plan_of(df)
            assert len(exported) == 2
        assert spark.conf.get("spark.sql.sources.bucketing.enabled") == "true"
        alone = f"SELECT c_custkey, count(*) AS n FROM {table}_c GROUP BY c_custkey"
        assert exchanges(warehouse.source(query=alone)) == 0  # no hot bucket, no shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_to_a_hash_table_keeps_clustering_and_counts(warehouse, orders, table):
    layout = Distribution.hash("o_custkey", buckets=4)
    warehouse.write(orders, table, distribution=layout)
    both = warehouse.write(orders, table, mode="append")
    assert both.count() == 2 * orders.count()
    assert exchanges(both.groupBy("o_custkey").count()) == 0
    spread = warehouse.entry(table).spread
    assert spread.rows == 2 * orders.count() and spread.by_bucket and spread.staged_bytes > 0
    with pytest.raises(OptionError, match="append keeps the layout"):
        warehouse.write(orders, table, mode="append", distribution="ROUND_ROBIN")


def test_hash_on_several_columns(warehouse, orders, table):
    layout = Distribution.hash("o_custkey", "o_orderstatus", buckets=4)
    out = warehouse.write(orders, table, distribution=layout)
    assert same_rows(out, orders)
    assert exchanges(out.groupBy("o_custkey", "o_orderstatus").count()) == 0


def test_round_robin(warehouse, orders, table):
    warehouse.write(orders, table, distribution=Distribution.round_robin(3))
    folder = warehouse.entry(table).location.removeprefix("file:")
    sizes = [
        warehouse.spark.read.parquet(f).count() for f in glob.glob(os.path.join(folder, "*.parquet"))
    ]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 3


def test_replicated_table_is_broadcast_only_within_the_limit(warehouse, customer, table):
    small = warehouse.write(customer, table, distribution="REPLICATE")
    assert "hint broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "BroadcastHashJoin" in plan_of(customer.join(small, "c_custkey"))
    warehouse.broadcast_bytes = 1000
    large = warehouse.table(table)
    assert "hint broadcast" not in large._jdf.queryExecution().logical().toString().lower()
    assert same_rows(small, large)


def test_small_file_with_many_rows_is_measured_unpacked(spark, warehouse, table):
    rows = spark.range(0, 200_000, 1, 1).select(F.lit("x" * 50).alias("s"))
    warehouse.broadcast_bytes = 1 << 20
    out = warehouse.write(rows, table, distribution="REPLICATE")
    assert "hint broadcast" not in out._jdf.queryExecution().logical().toString().lower()


def test_other_layout_words_are_kept(warehouse, orders, table):
    warehouse.write(
        orders, table, distribution="CLUSTERED COLUMNSTORE INDEX", table_options={"team": "me"}
    )
    properties = warehouse.entry(table).properties
    assert properties["stagehouse.table_options"] == "CLUSTERED COLUMNSTORE INDEX"
    assert properties["team"] == "me"


def test_many_small_splits_are_read_in_fewer_tasks(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 64)
    monkeypatch.setattr(layout_module, "MAP_BYTES", 100)
    assert layout_module.widen_splits(df, 2000).rdd.getNumPartitions() == 20
    assert layout_module.widen_splits(df, 800).rdd.getNumPartitions() == 64


def test_nested_columns_get_no_broadcast_hint(spark, warehouse, table):
    out = warehouse.write(spark.sql("SELECT array(1, 2) AS a"), table, distribution="REPLICATE")
    assert "hint broadcast" not in out._jdf.queryExecution().logical().toString().lower()


def test_bucketed_load_does_not_sort(spark, warehouse, orders, table):
    warehouse.create_table(table, orders.schema, Distribution.hash("o_custkey", buckets=4))
    orders.createOrReplaceTempView("o_view")
    load = f"EXPLAIN INSERT INTO {table} SELECT * FROM o_view"
    assert "Sort [" in spark.sql(load).first()[0]
    with warehouse._unsorted_buckets():
        assert "Sort [" not in spark.sql(load).first()[0]


def test_copy_into_a_hash_table_reads_the_files_where_they_lie(warehouse, orders, table):
    warehouse.create_table(table, orders.schema, Distribution.hash("o_custkey", buckets=4))
    staged = warehouse.stage(orders.select(*reversed(orders.columns)))
    known = set(warehouse.area)
    seen = []
    new_dir = warehouse.area.new_dir
    warehouse.area.new_dir = lambda *a: seen.append(a) or new_dir(*a)
    assert warehouse.copy_into(table, staged.path) == orders.count()
    assert seen == [] and set(warehouse.area) == known
    assert same_rows(warehouse.table(table), orders)
    assert warehouse.entry(table).spread.rows == orders.count()
