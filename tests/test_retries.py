"""Tasks that fail and are run again must neither lose nor repeat a row."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from stagehouse import CatalogWarehouse, Distribution, JdbcWarehouse
from stagehouse.operators import layout

layout.FILE_BYTES = 2000
folder = sys.argv[1]
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def fail_once(batches):
    for i, batch in enumerate(batches):
        yield batch
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2:
            raise RuntimeError("lost")

rows = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
flaky = rows.mapInArrow(fail_once, rows.schema)
total = (4000, sum(range(4000)))

def seen(df):
    return tuple(df.agg(F.count("*"), F.sum("id")).first())

w = CatalogWarehouse(spark, folder + "/tables", folder + "/staging")
assert w.stage(flaky).rows == 4000
w.write(flaky, "plain")
assert seen(w.write(flaky, "plain", mode="append")) == (8000, 2 * total[1])
hashed = w.write(flaky, "hashed", distribution=Distribution.hash("k", buckets=4))
assert seen(hashed) == total and w.entry("hashed").spread.rows == 4000
db = JdbcWarehouse(spark, "jdbc:derby:memory:retry;create=true", folder + "/staging", user="a", password="b")
assert seen(db.write(flaky, "t")) == total
assert seen(db.read(table="t", partition_columns=["id"]).mapInArrow(fail_once, rows.schema)) == total
print("all rows once")
"""


def test_rows_survive_failing_tasks(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", CODE, str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=240,
        cwd=tmp_path,
    )
    assert "all rows once" in done.stdout, done.stderr[-3000:]
