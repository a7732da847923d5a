from __future__ import annotations

import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from support import SF  # noqa: E402

@pytest.fixture(scope="session", autouse=True)
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("session")
    spark = (
        SparkSession.builder.master("local[2]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    from stagehouse import CatalogWarehouse

    return CatalogWarehouse(
        spark,
        str(tmp_path / "tables"),
        str(tmp_path / "staging"),
        locations={"lake": str(tmp_path / "lake")},
        formats={"columnar": ("orc", {}), "lines": ("json", {})},
    )


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex[:12]}"


@pytest.fixture(scope="session")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="session")
def customer(spark):
    return spark.read.parquet(f"{SF}/customer.parquet")
