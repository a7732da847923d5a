"""Where a registered query reads its tables and keeps its files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from stagehouse.operators import CatalogWarehouse
from stagehouse.sources.staging import hadoop_path, shared_folder

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def input_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views over the given tables, so query text can name them."""
    for name in names:
        input_table(spark, sf_dir, name).createOrReplaceTempView(name)


def work_folder(spark: SparkSession) -> str:
    """The cluster's shared folder.  Only a local session that names none, where driver and
    executors are one process, gets a temporary one."""
    is_local = spark.sparkContext.master.startswith("local")
    if is_local and not spark.conf.get("spark.checkpoint.dir", None):
        return tempfile.gettempdir()
    return shared_folder(spark)


def new_warehouse(spark: SparkSession, sf_dir: str, *views: str, **how) -> CatalogWarehouse:
    """A warehouse of its own for one query run; all its files go when the session ends, because
    the frames handed out are evaluated after the query function has returned."""
    register_tables(spark, sf_dir, *views)
    base = f"{work_folder(spark)}/stagehouse_{uuid.uuid4().hex}"
    path, fs = hadoop_path(spark, base)
    fs.mkdirs(path)
    how.setdefault("locations", {"exports": f"{base}/exports"})
    how.setdefault("formats", {"columnar": ("orc", {})})
    warehouse = CatalogWarehouse(spark, f"{base}/tables", f"{base}/staging", **how)
    warehouse.area.register(base)
    return warehouse


def fresh(name: str) -> str:
    """A table name no other run uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"
