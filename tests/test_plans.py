"""Physical plans of the registered query texts, as they are when no side is small enough to broadcast."""

import re

import pytest
from support import SF, plan_of

from stagehouse.plans import relational
from stagehouse.plans.workspace import TABLES, register_tables


@pytest.fixture(scope="module")
def large(spark):
    register_tables(spark, SF, *TABLES)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def columns_read(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>\n", plan)]


@pytest.mark.parametrize("key", sorted(relational._TEXTS))
def test_no_pairs_and_no_python(large, key):
    plan = plan_of(large.sql(relational._TEXTS[key][0]))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert bad not in plan


@pytest.mark.parametrize(
    "text, columns",
    [
        (relational.JOIN, {"o_custkey", "o_totalprice"}),
        (relational.SEMI_JOIN, {"o_custkey", "o_totalprice"}),
        (relational.AGGREGATE, {"l_returnflag", "l_linestatus", "l_quantity", "l_suppkey"}),
        (relational.TOPK, {"o_orderkey", "o_totalprice"}),
    ],
)
def test_scans_read_only_what_the_text_uses(large, text, columns):
    assert columns in columns_read(plan_of(large.sql(text)))


def test_filters_reach_the_scan(large):
    plan = plan_of(large.sql(relational.SEMI_JOIN))
    assert "GreaterThan(o_totalprice,400000.0)" in plan


def test_rows_are_combined_before_they_are_shuffled(large):
    """Every shuffle of orders by a key that may be hot comes after a partial aggregate."""
    for text, key in ((relational.JOIN, "o_custkey"), (relational.SEMI_JOIN, "o_custkey")):
        tree = large.sql(text)._jdf.queryExecution().executedPlan().toString().splitlines()
        hot = [i for i, line in enumerate(tree) if f"Exchange hashpartitioning({key}" in line]
        assert hot and all("HashAggregate" in tree[i + 1] for i in hot)


def test_window_is_numbered_by_ranges(large, monkeypatch):
    """One shuffle by range, one within ranges, and a broadcast of what goes over range borders."""
    import stagehouse.operators.running as running

    staged, stage = [], running.stage
    monkeypatch.setattr(running, "stage", lambda df, *a: staged.append(df) or stage(df, *a))
    made = relational.query_window(large, SF)
    plan = plan_of(staged[0])
    ranged = r"rangepartitioning\(__key\S+ ASC NULLS FIRST, \S+ ASC NULLS FIRST, \S+ ASC NULLS FIRST, __tie"
    assert re.search(ranged, plan)
    assert re.search(r"hashpartitioning\(__range\S+, __key", plan)
    for bad in ("SinglePartition", "Python", "CartesianProduct"):
        assert bad not in plan and bad not in plan_of(made)
    assert "BroadcastHashJoin" in plan_of(made)


def test_topk_keeps_only_k_rows_per_task(large):
    assert "TakeOrderedAndProject" in plan_of(large.sql(relational.TOPK))
