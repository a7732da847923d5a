import os

import pytest
from support import SF, same_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import Distribution, LoadError, OptionError, SchemaError


def bad_rows(df):
    """A frame that fails while it is computed."""
    return df.withColumn(
        df.columns[0], F.when(F.rand() >= 0, F.raise_error(F.lit("broken row"))).cast("bigint")
    )


@pytest.mark.parametrize("mode", ["errorifexists", "overwrite", "ignore", "error", "default"])
def test_absent_table_is_created(warehouse, orders, table, mode):
    assert same_rows(warehouse.write(orders, table, mode=mode), orders)


def test_append_needs_a_table(warehouse, orders, table):
    with pytest.raises(OptionError, match="does not exist"):
        warehouse.write(orders, table, mode="append")
    assert len(warehouse.area) == 0


def test_modes_on_an_existing_table(warehouse, orders, customer, table):
    warehouse.write(orders, table)
    with pytest.raises(OptionError, match="exists already"):
        warehouse.write(customer, table)
    assert same_rows(warehouse.write(customer, table, mode="ignore"), orders)
    appended = warehouse.write(orders, table, mode="append")
    assert same_rows(appended, orders.unionAll(orders))
    with pytest.raises(SchemaError, match="has no column"):
        warehouse.write(customer, table, mode="append")
    assert same_rows(warehouse.write(customer, table, mode="overwrite"), customer)
    with pytest.raises(OptionError, match="mode must be one of"):
        warehouse.write(customer, table, mode="upsert")


def test_overwrite_keeps_readers_of_the_old_version(warehouse, orders, customer, table):
    old = warehouse.write(orders, table)
    warehouse.write(customer, table, mode="overwrite")
    assert old.count() == orders.count()


def test_overwrite_from_itself(warehouse, orders, table):
    rows = warehouse.write(orders, table)
    kept = orders.where("o_orderstatus = 'F'")
    out = warehouse.write(rows.where("o_orderstatus = 'F'"), table, mode="overwrite")
    assert same_rows(out, kept)
    layout = Distribution.hash("o_custkey", buckets=4)
    out = warehouse.write(out.limit(50), table, mode="overwrite", distribution=layout)
    assert out.count() == 50


def test_append_from_itself(warehouse, orders, table):
    rows = warehouse.write(orders, table)
    assert same_rows(warehouse.write(rows, table, mode="append"), orders.unionAll(orders))


@pytest.mark.parametrize("layout", [None, Distribution.hash("o_custkey", buckets=4)])
@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_failed_load_leaves_table_and_disk_as_they_were(warehouse, orders, table, layout, mode):
    warehouse.write(orders, table, distribution=layout)
    location = warehouse.entry(table).location
    folder = os.path.dirname(location.removeprefix("file:"))
    staging = set(warehouse.area)
    files = sorted(os.listdir(location.removeprefix("file:")))
    with pytest.raises(LoadError) as error:
        how = {"distribution": layout} if mode == "overwrite" else {}
        warehouse.write(bad_rows(orders), table, mode=mode, **how)
    assert "broken row" in str(error.value.cause)
    assert warehouse.entry(table).location == location
    assert same_rows(warehouse.table(table), orders)
    assert len([f for f in os.listdir(folder) if f.startswith("v_")]) == 1
    left = [f for f in os.listdir(location.removeprefix("file:")) if f.endswith(".parquet")]
    assert sorted(left) == [f for f in files if f.endswith(".parquet")]
    assert set(warehouse.area) == staging
    assert not [
        t for t in warehouse.spark.catalog.listTables() if t.name.startswith(("new_", "old_"))
    ]


def test_entry_comes_back_when_the_new_one_cannot_take_its_place(
    warehouse, orders, customer, table, monkeypatch
):
    warehouse.write(orders, table)
    rename = warehouse._rename

    def failing(source, target):
        if source.startswith("new_"):
            raise RuntimeError("catalog is down")
        rename(source, target)

    monkeypatch.setattr(warehouse, "_rename", failing)
    with pytest.raises(LoadError) as error:
        warehouse.write(customer, table, mode="overwrite")
    assert "catalog is down" in str(error.value.cause)
    assert same_rows(warehouse.table(table), orders)


def test_new_version_stays_when_only_the_cleanup_of_the_old_one_fails(
    warehouse, orders, customer, table, monkeypatch
):
    warehouse.write(orders, table)

    def failing(_location):
        raise RuntimeError("storage is down")

    monkeypatch.setattr(warehouse, "_retire", failing)
    assert same_rows(warehouse.write(customer, table, mode="overwrite"), customer)

    def interrupted(*_):
        swap(*_)
        raise KeyboardInterrupt

    swap = warehouse._swap
    monkeypatch.setattr(warehouse, "_swap", interrupted)
    with pytest.raises(KeyboardInterrupt):
        warehouse.write(orders, table, mode="overwrite")
    assert same_rows(warehouse.table(table), orders)


def test_empty_frame(warehouse, orders, table):
    empty = orders.where("false")
    assert warehouse.write(empty, table).schema == orders.schema
    assert warehouse.write(empty, table, mode="append").count() == 0
    hashed = warehouse.write(
        empty, table, mode="overwrite", distribution=Distribution.hash("o_custkey")
    )
    assert hashed.count() == 0 and warehouse.entry(table).buckets == 8


def test_database_and_odd_names(spark, warehouse, orders, table):
    spark.sql(f"CREATE DATABASE db_{table}")
    with pytest.raises(OptionError, match="letters, digits"):
        warehouse.write(orders, f"db_{table}.`odd name-1`")
    name = f"db_{table}.`2nd`"
    assert same_rows(warehouse.write(orders, name), orders)
    assert same_rows(warehouse.write(orders.limit(3), name, mode="overwrite"), orders.limit(3))
    full = f"spark_catalog.{name}"
    assert same_rows(warehouse.write(orders, full, mode="overwrite"), orders)
    warehouse.drop_table(full)
    assert not warehouse.exists(name)
    odd = orders.select(F.col("o_orderkey").alias("a b"), F.col("o_custkey").alias("x.y`z"))
    assert same_rows(
        warehouse.write(odd, name, distribution=Distribution.hash("a b", "x.y`z")), odd
    )
    spark.sql(f"DROP DATABASE db_{table} CASCADE")


def test_a_view_is_not_a_table(warehouse, orders, table):
    orders.createOrReplaceTempView(table)
    with pytest.raises(OptionError, match="temporary view"):
        warehouse.write(orders, table, mode="overwrite")


def test_drop_is_quiet_and_files_go_later(warehouse, orders, table):
    rows = warehouse.write(orders, table)
    warehouse.drop_table(table)
    warehouse.drop_table(table)
    assert rows.count() == orders.count() and len(warehouse.area) == 1
    warehouse.keep_old = True
    warehouse.write(orders, table)
    warehouse.drop_table(table)
    assert len(warehouse.area) == 1


def test_create_if_absent_keeps_the_first(warehouse, orders, customer, table):
    warehouse.create_table(table, orders.schema, "HASH(o_custkey)")
    warehouse.create_table(table, customer.schema)
    assert warehouse.schema_of(table=table) == orders.schema
    assert warehouse.entry(table).bucket_columns == ("o_custkey",)
    assert same_rows(warehouse.write(orders, table, mode="append"), orders)


def test_copy_into_by_name(warehouse, orders, table):
    warehouse.create_table(table, T.StructType(orders.schema.fields + [T.StructField("more", T.DateType())]))
    staged = warehouse.stage(orders.select(*reversed(orders.columns)).withColumnRenamed("o_custkey", "O_CUSTKEY"))
    assert warehouse.copy_into(table, staged.path) == orders.count()
    out = warehouse.table(table)
    assert same_rows(out.drop("more"), orders) and out.where("more is not null").isEmpty()
    extra = warehouse.stage(orders.withColumn("unknown", F.lit(1)))
    with pytest.raises(SchemaError, match="no column unknown"):
        warehouse.copy_into(table, extra.path)


def test_copy_into_by_position(warehouse, orders, table):
    warehouse.create_table(table, orders.schema)
    staged = warehouse.stage(orders.toDF(*[f"c{i}" for i in range(len(orders.columns))]))
    assert warehouse.copy_into(table, staged.path, match="position") == orders.count()
    assert same_rows(warehouse.table(table), orders)
    fewer = warehouse.stage(orders.drop("o_custkey"))
    with pytest.raises(SchemaError, match="6 columns, the source 5"):
        warehouse.copy_into(table, fewer.path, match="position")
    text_first = warehouse.stage(orders.select(*[F.lit("x").alias(c) for c in orders.columns]))
    with pytest.raises(LoadError):
        warehouse.copy_into(table, text_first.path, match="position")
    with pytest.raises(OptionError, match="match must be"):
        warehouse.copy_into(table, staged.path, match="order")


def test_copy_into_checks_its_target_and_format(warehouse, orders, table):
    staged = warehouse.stage(orders)
    with pytest.raises(OptionError, match="does not exist"):
        warehouse.copy_into(table, staged.path)
    warehouse.create_table(table, orders.schema)
    with pytest.raises(OptionError, match="unknown file format"):
        warehouse.copy_into(table, staged.path, file_format="x")


@pytest.mark.parametrize("file_format", ["columnar", "lines"])
def test_copy_into_from_other_formats(warehouse, orders, table, file_format):
    warehouse.create_table(table, orders.schema)
    staged = warehouse.unload(orders, file_format=file_format)
    assert warehouse.copy_into(table, staged.path, file_format=file_format) == orders.count()
    assert same_rows(warehouse.table(table), orders)


@pytest.mark.parametrize("distribution", [None, "HASH(a)"])
def test_not_null_is_enforced(spark, warehouse, table, distribution):
    schema = T.StructType.fromDDL("a BIGINT NOT NULL, b STRING")
    warehouse.create_table(table, schema, distribution)
    good = spark.createDataFrame([(1, "x"), (2, None)], "a BIGINT, b STRING")
    assert warehouse.write(good, table, mode="append").count() == 2
    bad = spark.createDataFrame([(3, "x"), (None, "y")], "a BIGINT, b STRING")
    with pytest.raises(LoadError) as error:
        warehouse.write(bad, table, mode="append")
    assert "null in column a" in str(error.value.cause)
    assert warehouse.table(table).count() == 2
    with pytest.raises(SchemaError, match="lacks NOT NULL column a"):
        warehouse.write(good.select("b"), table, mode="append")
    assert warehouse.write(good.select("a"), table, mode="append").count() == 4


def test_nullability_is_carried_by_write(spark, warehouse, table):
    rows = spark.range(5).withColumn("s", F.lit(None).cast("string"))
    warehouse.write(rows, table)
    schema = warehouse.schema_of(table=table)
    assert not schema["id"].nullable and schema["s"].nullable
    assert [f.nullable for f in warehouse.schema_of(query=f"SELECT * FROM {table}")] == [True, True]


def test_micro_batches(spark, warehouse, table, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    warehouse.create_table(table, events.schema)
    source = str(tmp_path / "in")
    events.repartition(3).write.parquet(source)
    query = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(source)
        .writeStream.foreachBatch(lambda df, _: warehouse.write(df, table, mode="append") and None)
        .option("checkpointLocation", str(tmp_path / "marks"))
        .trigger(availableNow=True)
        .start()
    )
    try:
        assert query.awaitTermination(120) and query.exception() is None
    finally:
        query.stop()
    assert same_rows(warehouse.table(table), events)


def test_insert_into_works_natively(spark, warehouse, orders, table):
    warehouse.write(orders, table)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {table} LIMIT 7")
    assert spark.table(table).count() == orders.count() + 7
