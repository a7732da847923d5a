"""Intermediate tables, written once to the cluster's shared folder and read back."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.plans.workspace import work_folder
from stagehouse.sources.staging import hadoop_path


#: Shuffle files of a query go when it ends, rather than when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own in the shared folder: lineage ends there, so a lost executor
    costs the reading task only, and the shuffle files behind it are given back.  The folder goes with
    the session, or by ``dropped``."""
    spark = df.sparkSession
    path, fs = hadoop_path(spark, f"{work_folder(spark)}/llm_{name}_{uuid.uuid4().hex}")
    fs.deleteOnExit(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path.toString())
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path.toString())


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of ``written`` tables that nothing reads any more."""
    for table_ in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table_.inputFiles()}:
            path, fs = hadoop_path(table_.sparkSession, folder)
            fs.delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the workers of this application the package, once; they may have no copy of it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        base = shutil.make_archive(
            f"{tempfile.mkdtemp()}/stagehouse", "zip", Path(__file__).parents[2], "stagehouse"
        )
        context.addPyFile(base)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def inner_names(columns: list[str], *kept: str) -> list[str]:
    """Names under which a stage holds the columns it was given: no name of its own clashes with them.
    ``kept`` stay as they are."""
    return [c if c in kept else f"own_column_{i}" for i, c in enumerate(columns)]


def own_names(df: DataFrame, inner: list[str], columns: list[str]) -> DataFrame:
    return df.select(*[F.col(i).alias(c) for i, c in zip(inner, columns, strict=True)])
