"""Row numbers carried over ranges, against a plain window."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from support import plan_of

from stagehouse.operators.running import number_rows

DAY = dt.datetime(2024, 1, 1)


def rows(kind: str):
    for i in range(2000):
        hot = i % 3 == 0
        key = 7 if hot else i % 50
        when = DAY + dt.timedelta(seconds=i)
        if kind == "one time" and hot:
            when = DAY
        if kind == "null key" and hot:
            key = None
        if kind == "null time" and hot:
            when = None
        yield key, when, i * 7919 % 2000


@pytest.mark.parametrize("kind", ["distinct times", "one time", "null key", "null time"])
def test_hot_key(spark, warehouse, kind):
    df = spark.createDataFrame(list(rows(kind)), "k int, t timestamp, id long").repartition(4)
    made = number_rows(df, ["k"], ["t", "id"], warehouse.area, previous={"before": "id"}, ranges=16)
    by_key = Window.partitionBy("k").orderBy("t", "id")
    expected = df.withColumns(
        {"rn": F.row_number().over(by_key).cast("long"), "before": F.lag("id").over(by_key)}
    )
    assert made.columns == expected.columns
    assert sorted(map(repr, made.collect())) == sorted(map(repr, expected.collect()))
    written = spark.read.parquet(*list(warehouse.area))
    largest = written.groupBy("__range", "__key").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 2000 / 16  # the hot key has 667 rows
    assert "BroadcastHashJoin" in plan_of(made)


def test_whole_table_falling_with_equal_rows(spark, warehouse):
    df = spark.createDataFrame([(i // 300,) for i in range(900)] + [(None,)] * 100, "v int")
    made = number_rows(df, [], [("v", "desc")], warehouse.area, number="n", ranges=8)
    found = sorted((r.n, r.v) for r in made.collect())
    assert [n for n, _ in found] == list(range(1, 1001))
    assert [v for _, v in found] == [2] * 300 + [1] * 300 + [0] * 300 + [None] * 100


def test_empty_and_clashing_names(spark, warehouse):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 4)], "`a.b` int, __range int, __key int")
    made = number_rows(df, ["a.b"], ["__range"], warehouse.area, previous={"was": "__key"})
    assert sorted(tuple(r) for r in made.collect()) == [(1, 1, 4, 1, None), (1, 2, 3, 2, 4)]
    assert number_rows(df.limit(0), ["a.b"], ["__key"], warehouse.area).isEmpty()


def test_running_totals(spark, warehouse):
    values = [(i % 3 // 2, i, None if i % 5 == 0 else i) for i in range(600)]
    df = spark.createDataFrame(values, "k int, i int, v long")
    made = number_rows(df, ["k"], ["i"], warehouse.area, totals={"t": "v"}, ranges=9)
    by_key = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("i", F.sum("v").over(by_key).alias("t"))
    assert sorted(map(repr, made.select("i", "t").collect())) == sorted(map(repr, expected.collect()))
