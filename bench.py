"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the cores.
Results go to Spark's ``noop`` sink, so a time covers the export or load and a full scan of what it
returns.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from stagehouse import Distribution  # noqa: E402
from stagehouse.plans import all_queries  # noqa: E402
from stagehouse.plans.layouts import segment_counts  # noqa: E402
from stagehouse.plans.workspace import fresh, input_table, new_warehouse  # noqa: E402

HEADLINE = (
    "staged_table_scan",
    "scan_filter_project",
    "staged_query_scan",
    "unload_then_scan",
    "named_format_scan",
    "typed_round_trip",
    "jdbc_staged_scan",
    "format_scan",
    "write_new_table",
    "write_append",
    "write_overwrite",
    "write_self_overwrite",
    "copy_into_existing",
    "round_robin_write",
    "hash_distributed_join",
    "replicated_dim_join",
    "query_join",
    "query_semi_join",
    "query_aggregate",
    "query_rollup",
    "query_window",
    "query_topk",
    "query_set_ops",
)
RUNS = 3


def open_session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", "/tmp/stagehouse_bench_warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(label: str, run) -> float:
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        drain(run())
        times.append(time.perf_counter() - began)
    print(label, [round(t, 2) for t in times], file=sys.stderr)
    return round(min(times), 3)


def layout_gain(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """The join of two tables hash distributed on its key, and of the same rows in plain tables,
    both without broadcast: what the layout saves each time the tables are read."""
    warehouse = new_warehouse(spark, sf_dir)
    keys = {"orders": "o_custkey", "customer": "c_custkey"}
    hashed, plain = [], []
    for name, key in keys.items():
        rows = input_table(spark, sf_dir, name)
        hashed.append(fresh(name))
        plain.append(fresh(name))
        warehouse.write(rows, hashed[-1], distribution=Distribution.hash(key, buckets=8))
        warehouse.write(rows, plain[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {
            "join_of_hash_distributed_tables": best(
                "hashed", lambda: segment_counts(*warehouse.tables(*hashed))
            ),
            "join_of_plain_tables": best("plain", lambda: segment_counts(*warehouse.tables(*plain))),
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = open_session(cpus)
    queries = all_queries()
    drain(queries["staged_table_scan"](spark, sf_dir))  # start the JVM's compilers and caches
    seconds = {key: best(key, lambda: queries[key](spark, sf_dir)) for key in HEADLINE}
    total = round(sum(seconds.values()), 3)
    seconds.update(layout_gain(spark, sf_dir))
    result = {
        "metric": f"total seconds of {len(HEADLINE)} headline queries, best of {RUNS} runs each",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
