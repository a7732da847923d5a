"""The verbs both backends share: read through staged files, unload, and the write modes."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stagehouse.errors import LoadError, OptionError, SchemaError
from stagehouse.functions.casts import column_of, conform, find_field, fit
from stagehouse.functions.names import is_name
from stagehouse.operators.layout import Distribution
from stagehouse.sources.foreign import first_line, plain_path, unknown_fields
from stagehouse.sources.staging import (
    StagedDataset,
    StagingArea,
    directory_bytes,
    hadoop_path,
    stage,
)

MODES = ("errorifexists", "append", "overwrite", "ignore")
# Formats whose files carry no schema of their own: loaded under that of the table.
_SCHEMALESS = ("csv", "json", "text", "xml")


@dataclass(frozen=True)
class SettledRows:
    """Rows on disk, about to be loaded: the scan, the size of its files, and the files."""

    frame: DataFrame
    size: int
    files: StagedDataset

    def count(self) -> int:
        """Known for rows we staged; for Parquet files of others it is in their footers."""
        return self.frame.count() if self.files.rows is None else self.files.rows


class Warehouse(ABC):
    """A place with tables.

    ``locations`` maps the name of a storage location to its folder, ``formats`` the name of a file
    format to ``(spark format, options)``.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging_dir: str,
        locations: Mapping[str, str] | None = None,
        formats: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
    ):
        self.spark = spark
        self.area = StagingArea(spark, staging_dir)
        self.locations = dict(locations or {})
        self.formats = {"parquet": ("parquet", {}), **(formats or {})}

    # -- what a backend provides ------------------------------------------------------------------

    @abstractmethod
    def source(self, table: str | None = None, query: str | None = None) -> DataFrame:
        """The live rows of a table or query, not staged."""

    @abstractmethod
    def schema_of(self, table: str | None = None, query: str | None = None) -> T.StructType:
        """Names, types and nullability, found without running a job."""

    @abstractmethod
    def exists(self, table: str) -> bool:
        """True when the table is there; an error when its name cannot be that of a table."""

    @abstractmethod
    def table(self, name: str) -> DataFrame:
        """A table as it is now, scanned in place."""

    @abstractmethod
    def _append(
        self, df: DataFrame, table: str, match: str = "name", files: StagedDataset | None = None
    ) -> int:
        """Add the rows of ``df`` and return how many; all or nothing.  ``files`` are those ``df``
        scans, when it is nothing but a scan."""

    @abstractmethod
    def _append_batch(self, df: DataFrame, table: str, stream: str, number: int) -> None:
        """Add the rows of a batch, unless the table has this batch or a later one."""

    @abstractmethod
    def _publish(
        self,
        df: DataFrame,
        table: str,
        layout: Distribution,
        table_options: Mapping[str, str],
        replace: bool,
    ) -> None:
        """Make ``df`` the content of the table, under its schema; all or nothing."""

    # -- read -------------------------------------------------------------------------------------

    def read(
        self,
        table: str | None = None,
        query: str | None = None,
        location: str | None = None,
        file_format: str | None = None,
        schema: T.StructType | None = None,
        **how,
    ) -> DataFrame:
        """Export a table or a query once, and return a lazy DataFrame over the exported files.

        The result is a snapshot: later changes of the table do not show, and using it twice does
        not export twice.  The files live until the session ends or ``area.release(path)``.
        Filters and projections on the result reach the file scan; those inside ``query`` run
        before the export, so only the result of the query is written.
        ``schema`` reorders, subsets and widens the columns; ``how`` goes to ``source``.
        """
        if schema is not None:  # refuse a bad schema before the export, not after it
            fit(self.schema_of(table, query), schema)
        staged = self._exported(table, query, location, file_format, **how)
        return staged.scan() if schema is None else conform(staged.scan(), schema)

    def unload(
        self,
        source: DataFrame | str,
        location: str | None = None,
        file_format: str | None = None,
    ) -> StagedDataset:
        """Write a DataFrame, table or SELECT text to files and return where they are.

        Files in a named location stay after the session; those in the staging directory do not,
        unless ``area.keep(path)`` is called.
        """
        if not isinstance(source, str):
            staged = self._export(source, location, file_format)
        elif is_name(source):
            staged = self._exported(source, None, location, file_format)
        else:
            staged = self._exported(None, source, location, file_format)
        if location is not None:
            self.area.keep(staged.path)
        return staged

    def stage(self, df: DataFrame) -> StagedDataset:
        """Write ``df`` to a new directory of the staging area."""
        return stage(df, self.area)

    def _exported(
        self,
        table: str | None,
        query: str | None,
        location: str | None,
        file_format: str | None,
        **how,
    ) -> StagedDataset:
        return self._export(self.source(table, query, **how), location, file_format)

    def _export(
        self, df: DataFrame, location: str | None, file_format: str | None
    ) -> StagedDataset:
        parent = self._location(location)
        spark_format, options = self._format(file_format)
        return stage(df, self.area, parent, spark_format, options)

    def _location(self, name: str | None) -> str | None:
        """The folder of a named location; None for the staging directory."""
        if name is not None and name not in self.locations:
            known = ", ".join(sorted(self.locations)) or "none"
            raise OptionError(f"unknown location {name!r}, known: {known}")
        return None if name is None else self.locations[name]

    def _format(self, name: str | None) -> tuple[str, Mapping[str, str]]:
        if (name or "parquet") not in self.formats:
            known = ", ".join(sorted(self.formats))
            raise OptionError(f"unknown file format {name!r}, known: {known}")
        return self.formats[name or "parquet"]

    @staticmethod
    def _one_source(table: str | None, query: str | None) -> None:
        if (table is None) == (query is None):
            raise OptionError("give either a table or a query" + (", not both" if table else ""))

    # -- write ------------------------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str = "errorifexists",
        distribution: Distribution | str | None = None,
        table_options: Mapping[str, str] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> DataFrame:
        """Load ``df`` into a table and return the table.

        ``errorifexists`` (default) and ``ignore`` create a table that is absent; if it exists they
        raise, or leave it and return it.  ``overwrite`` replaces schema, layout and rows, and may
        read the table it replaces.  ``append`` needs an existing table and keeps its layout.  All checks run
        before the first job.

        ``batch``, the name of a stream and the number of one of its batches, is for an append within
        ``foreachBatch``: it is kept with the table, and a batch that is there already adds nothing.
        The batches of a stream come in order, one at a time.
        """
        mode = mode.lower()
        mode = "errorifexists" if mode in ("error", "default") else mode
        if mode not in MODES:
            raise OptionError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
        layout = Distribution.of(distribution).check(df.schema)
        exists = self.exists(table)
        if exists and mode == "errorifexists":
            raise OptionError(f"table {table} exists already")
        if not exists and mode == "append":
            raise OptionError(f"table {table} does not exist, so nothing can be appended to it")
        if mode == "append" and distribution is not None:
            raise OptionError("append keeps the layout of the table; give no distribution")
        if batch is not None and mode != "append":
            raise OptionError("a batch of a stream can only be appended")
        if not (exists and mode == "ignore"):
            with self._loading(table):
                if batch is not None:
                    self._append_batch(df, table, *batch)
                elif mode == "append":
                    self._append(df, table)
                else:
                    self._publish(df, table, layout, table_options or {}, replace=exists)
        return self.table(table)

    def copy_into(
        self, table: str, path: str, file_format: str = "parquet", match: str = "name"
    ) -> int:
        """Load the files below ``path`` into an existing table; returns the rows loaded.

        ``match`` pairs columns by ``name``, case ignored, or by ``position``.
        """
        if not self.exists(table):
            raise OptionError(f"table {table} does not exist")
        spark_format, options = self._format(file_format)
        with self._loading(table):
            df = self._foreign(path, spark_format, options, self.schema_of(table), match, table)
            files = StagedDataset(self.spark, path, df.schema, None, spark_format, options)
            return self._append(df, table, match, files)

    def _foreign(self, path, spark_format, options, target, match, table) -> DataFrame:
        """Files that somebody else wrote, with nothing lost or moved.  Columnar files may differ:
        their footers are merged.  Text formats are parsed by the format itself, under the types of the
        target and the format's own options (date formats, locale), and fail on a malformed record
        unless the options name another mode; the session's ANSI setting changes nothing.  A CSV header
        decides by name, for each file its own.  JSON names, nested ones too, are looked up in all
        files first.  A decimal with more digits than the target's scale is rounded, as by a cast."""
        named = {k.lower() for k in options}
        reader = self.spark.read.format(spark_format).options(**options)
        if spark_format not in _SCHEMALESS:
            return (reader if "mergeschema" in named else reader.option("mergeSchema", True)).load(
                path
            )
        if "mode" not in named:
            reader = reader.option("mode", "FAILFAST")
        if spark_format == "csv" and match == "name":
            header = next((v for k, v in options.items() if k.lower() == "header"), "false")
            if str(header).lower() != "true":
                raise OptionError("files without a header can be loaded by position only")
            return self._by_header(path, options, target)
        if spark_format == "json":
            names = self.spark.read.format("json").options(**options)
            found = names.option("primitivesAsString", True).load(path).schema
            extra = unknown_fields(found, target)
            if extra and extra != ["_corrupt_record"]:
                raise SchemaError(f"{table} has no column {', '.join(extra)}")
        return reader.schema(target).load(path)

    def _by_header(self, path, options, target) -> DataFrame:
        """CSV files in groups of the same header line, each group under the types its names have in
        the target.  Headers are read by the driver, one line a file; names the target lacks stay, for
        the check of the load to refuse."""
        groups: dict[str, list[str]] = {}
        for escaped in self.spark.read.text(path).inputFiles():
            file = plain_path(self.spark, escaped)
            groups.setdefault(first_line(self.spark, file), []).append(file)

        folder, fs = hadoop_path(self.spark, path)
        base = {"basePath": path} if fs.exists(folder) and not fs.getFileStatus(folder).isFile() else {}

        def reader():  # a reader keeps what it was told, so each load takes a new one
            return self.spark.read.format("csv").options(**{"mode": "FAILFAST", **base, **options})

        frames = []
        for line, files in groups.items():
            if not line.strip() and len(groups) > 1:
                continue  # an empty file says nothing
            names = reader().option("inferSchema", False).load(files[0]).columns
            fields = []
            for name in names:
                found = find_field(target, name)
                data_type = T.StringType() if found is None else found.dataType
                fields.append(T.StructField(name, data_type))
            typed = reader().schema(T.StructType(fields)).option("enforceSchema", False)
            frame = typed.load(files)
            known = [find_field(target, n) for n in names]
            frames.append(
                frame.select([column_of(frame, n).alias(f.name if f else n) for n, f in zip(names, known)])
            )
        merged = frames[0]
        for frame in frames[1:]:
            merged = merged.unionByName(frame, allowMissingColumns=True)
        return merged

    @contextmanager
    def _settled(self, frame: DataFrame, files: StagedDataset | None = None):
        """The rows of ``frame`` in a form that reads the same every time: staged for as long as the
        block runs, or as they are when ``frame`` only scans files that lie ready."""
        if files is not None:
            yield SettledRows(frame, directory_bytes(self.spark, files.path), files)
            return
        staged = stage(frame, self.area)
        try:
            yield SettledRows(staged.scan(), directory_bytes(self.spark, staged.path), staged)
        finally:
            self.area.release(staged.path)

    @contextmanager
    def _loading(self, table: str):
        try:
            yield
        except (OptionError, SchemaError, LoadError):
            raise
        except Exception as cause:
            raise LoadError(f"loading {table} failed, its content is unchanged", cause)
