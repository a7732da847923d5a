"""Appends from a stream count once, however often a batch is tried."""

import uuid

import pytest
from support import same_rows

import stagehouse
from stagehouse import JdbcWarehouse, LoadError, OptionError


@pytest.fixture(params=["catalog", "database"])
def house(request, spark, warehouse, tmp_path):
    if request.param == "catalog":
        return warehouse
    url = f"jdbc:derby:memory:b_{uuid.uuid4().hex};create=true"
    return JdbcWarehouse(spark, url, str(tmp_path / "s"), user="app", password="app")


def test_a_repeated_batch_adds_nothing(spark, house, table):
    rows = spark.range(10)
    house.write(rows.limit(0), table)
    for stream, number in [("a", 0), ("a", 0), ("a", 1), ("b'x", 0), ("a", 0), ("b'x", 0), ("a", 1)]:
        house.write(rows, table, mode="append", batch=(stream, number))
    assert house.table(table).count() == 30
    house.write(rows, table, mode="append")
    house.write(rows, table, mode="append", batch=("a", 2))
    assert house.table(table).count() == 50
    with pytest.raises(OptionError, match="only be appended"):
        house.write(rows, table, mode="overwrite", batch=("a", 3))


def test_a_failed_batch_is_tried_again(spark, house, table, monkeypatch):
    rows = spark.range(10)
    house.write(rows, table)
    name = "_insert" if hasattr(house, "_insert") else "run_batch"
    with monkeypatch.context() as patched:
        patched.setattr(house, name, lambda *a: 1 / 0)
        with pytest.raises((LoadError, ZeroDivisionError)):
            house.write(rows, table, mode="append", batch=("a", 0))
    house.write(rows, table, mode="append", batch=("a", 0))
    house.write(rows, table, mode="append", batch=("a", 0))
    assert house.table(table).count() == 20


def test_a_batch_lost_between_insert_and_note(spark, warehouse, table, monkeypatch):
    rows, real = spark.range(10), warehouse._note
    warehouse.write(rows, table)

    def lost(name, key, value):
        if "done" in value and "begun" not in value:
            raise RuntimeError("the driver died here")
        real(name, key, value)

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "_note", lost)
        with pytest.raises(LoadError):
            warehouse.write(rows, table, mode="append", batch=("a", 4))
    warehouse.write(rows, table, mode="append", batch=("a", 4))
    assert warehouse.table(table).count() == 20
    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "_note", lost)
        with pytest.raises(LoadError):
            warehouse.write(rows, table, mode="append", batch=("a", 5))
    warehouse.write(rows, table, mode="append")  # somebody else, in between
    with pytest.raises(LoadError, match="others wrote beside it"):
        warehouse.write(rows, table, mode="append", batch=("a", 5))


def test_stream_with_a_batch_function_that_runs_twice(spark, warehouse, tmp_path, table):
    source = str(tmp_path / "in")
    spark.range(100).repartition(4).write.parquet(source)
    warehouse.write(spark.range(0), table)

    def load(df, number):
        for _ in range(2):
            warehouse.write(df, table, mode="append", batch=("in", number))

    reader = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(source)
    writer = reader.writeStream.foreachBatch(load).trigger(availableNow=True)
    writer.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination(120)
    assert same_rows(warehouse.table(table), spark.range(100))


def test_batch_and_database_words_by_option(spark, tmp_path, table):
    url = f"jdbc:derby:memory:b_{uuid.uuid4().hex};create=true"
    options = {
        "url": url, "user": "app", "password": "app", "dbtable": table, "stagingdir": str(tmp_path),
        "typeWords": "string = varchar(30); bigint = decimal(19,0)",
        "rename": "RENAME TABLE {old} TO {new}",
    }
    rows = spark.range(5).selectExpr("id", "'x' AS s")
    stagehouse.write(rows, options)
    for _ in range(2):
        stagehouse.write(rows, {**options, "stream": "q", "batchId": 7}, mode="append")
    back = stagehouse.read(spark, options)
    assert back.dtypes == [("id", "decimal(19,0)"), ("s", "string")] and back.count() == 10
    plain = {"url": "catalog", "dbtable": table, "stagingdir": str(tmp_path), "root": str(tmp_path)}
    for bad in (
        {"rename": "x"}, {"batchid": "-1"}, {"stream": "s"}, {"typewords": "strin = x"},
    ):
        with pytest.raises(OptionError):
            stagehouse.write(rows, {**plain, **bad})


def test_bulk_statements_by_option(spark, tmp_path):
    from stagehouse.options import Options, open_warehouse

    options = Options.of({
        "url": "jdbc:derby:memory:z", "user": "a", "password": "b", "stagingdir": str(tmp_path),
        "bulkLoad": "SET x = 'a;b';\nCOPY INTO {table} FROM '{path}'", "bulkUnload": "UNLOAD {query};",
        "dialect": "tsql", "stringLength": "max",
    })
    made = open_warehouse(spark, options)
    assert made.bulk_load == ["SET x = 'a;b'", "COPY INTO {table} FROM '{path}'"]
    assert made.bulk_unload == ["UNLOAD {query}"]
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("s STRING")
    assert made._create_text("t", schema).startswith("CREATE TABLE t ([s] nvarchar(max))")
