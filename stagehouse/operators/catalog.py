"""A warehouse whose tables are entries of the Spark catalog over Parquet directories."""

from __future__ import annotations

import json
import logging
import math
import re
import threading
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import LoadError, OptionError, SchemaError
from stagehouse.functions.casts import column_of, guard_not_null
from stagehouse.functions.ddl import ddl_for
from stagehouse.functions.names import quote_name, quote_part, quote_text, split_name
from stagehouse.operators.layout import (
    BucketSpread,
    Distribution,
    cluster_by_bucket,
    count_buckets,
    slice_buckets,
    widen_splits,
)
from stagehouse.operators.load import align
from stagehouse.operators.warehouse import SettledRows, Warehouse
from stagehouse.sources.staging import (
    StagedDataset,
    directory_bytes,
    hadoop_path,
    is_below,
    path_parts,
)

log = logging.getLogger(__name__)

_PLAIN = re.compile(r"\w+", re.ASCII)
_WRITER_SETTING = threading.Lock()
_SPREAD = ("largest_bucket", "rows", "staged_bytes")  # table properties
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class TableEntry:
    """What the catalog knows about a table."""

    location: str | None
    provider: str | None
    properties: Mapping[str, str]
    bucket_columns: tuple[str, ...]
    buckets: int | None

    @property
    def not_null(self) -> set[str]:
        return set(json.loads(self.properties.get("stagehouse.not_null", "[]")))

    @property
    def kind(self) -> str:
        return self.properties.get("stagehouse.distribution", "")

    def layout(self) -> Distribution:
        if self.buckets:
            return Distribution.hash(*self.bucket_columns, buckets=self.buckets)
        return Distribution()

    @property
    def spread(self) -> BucketSpread:
        """As counted by the loads; an INSERT from elsewhere is not in it."""
        kept = [int(self.properties.get(f"stagehouse.{k}", "0")) for k in _SPREAD]
        return BucketSpread(self.buckets or 1, *kept)


def _properties(options: Mapping[str, str] | None) -> str:
    listed = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in (options or {}).items())
    return f" TBLPROPERTIES ({listed})" if listed else ""


class CatalogWarehouse(Warehouse):
    """Tables live at ``root/<table>/v_<id>``, one directory per version.

    A new version is written in full before the catalog entry moves to it, so a failed job leaves
    the table as it was, a table may be overwritten from its own rows, and frames on the old version
    still answer.  Moving the entry is two catalog steps, the old entry out and the new one in, and
    not atomic: between them another session may find no table.  Old versions are deleted when the
    session ends, unless ``keep_old``.

    A name that begins with another catalog of the session is a table there: read, created, appended to
    and dropped by that catalog's own means, without versions, layouts or buckets.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        staging_dir: str,
        locations: Mapping[str, str] | None = None,
        formats: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
        keep_old: bool = False,
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        super().__init__(spark, staging_dir, locations, formats)
        self.root = root.rstrip("/")
        self.keep_old = keep_old
        self.broadcast_bytes = broadcast_bytes

    # -- looking up -------------------------------------------------------------------------------

    @staticmethod
    def _parts(table: str) -> list[str]:
        """``[database,] table`` of the session catalog."""
        parts = split_name(table)
        if len(parts) > 1 and parts[0].lower() == "spark_catalog":
            parts = parts[1:]
        if len(parts) > 2 or not all(_PLAIN.fullmatch(p) for p in parts):
            raise OptionError(
                f"{table}: a table of the session catalog is [database.]table, of letters, digits "
                "and underscores"
            )
        return parts

    def _elsewhere(self, table: str) -> str | None:
        """The quoted name of a table in another catalog of the session, else None."""
        parts = split_name(table)
        if len(parts) < 2 or parts[0].lower() == "spark_catalog":
            return None
        known = self.spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None
        return quote_name(table) if known else None

    def _quoted(self, table: str) -> str:
        return ".".join(quote_part(p) for p in self._parts(table))

    def source(self, table: str | None = None, query: str | None = None) -> DataFrame:
        self._one_source(table, query)
        try:
            if query is not None:
                frame = self.spark.sql(query)
                if self._reads_hot_bucket(frame):
                    frame = self._without_buckets().sql(query)
                return frame
            return self.spark.table(quote_name(table))
        except AnalysisException as cause:
            raise SchemaError(f"cannot resolve {table or query}: {cause.getMessage()}", cause)

    def _reads_hot_bucket(self, frame: DataFrame) -> bool:
        """Whether a relation of the analysed plan, subqueries included, is a table of which one bucket
        is too large for a task."""
        plan = frame._jdf.queryExecution().analyzed()
        inner = plan.subqueriesAll()
        seen = set()
        for part in [plan, *(inner.apply(i) for i in range(inner.size()))]:
            leaves = part.collectLeaves()
            for leaf in (leaves.apply(i) for i in range(leaves.size())):
                if leaf.getClass().getSimpleName() != "LogicalRelation":
                    continue
                found = leaf.catalogTable()
                if found.isEmpty() or found.get().bucketSpec().isEmpty():
                    continue
                name = found.get().identifier()
                parts = [*(p for p in [name.database()] if p.isDefined())]
                seen.add(".".join(quote_part(p) for p in [*(p.get() for p in parts), name.table()]))
        return any(not self.entry(name).spread.by_bucket for name in seen)

    def _without_buckets(self) -> SparkSession:
        """A copy of the session, with its views and settings, that scans tables by file splits, so
        that Spark shuffles both sides of a join and can split a hot key.  This session stays as it is.
        (A temporary view of a DataFrame, other than one of a query text, keeps its own scans.)"""
        copy = self.spark._jsparkSession.cloneSession()
        session = SparkSession(self.spark.sparkContext, copy)
        session.conf.set("spark.sql.sources.bucketing.enabled", "false")
        return session

    def schema_of(self, table: str | None = None, query: str | None = None) -> T.StructType:
        schema = self.source(table, query).schema
        not_null = set()
        if table is not None and self._elsewhere(table) is None:
            found = self.spark.catalog.getTable(quote_name(table))
            if not found.isTemporary and found.catalog == "spark_catalog":
                not_null = self.entry(table).not_null
        return T.StructType(
            [
                T.StructField(f.name, f.dataType, f.nullable and f.name not in not_null, f.metadata)
                for f in schema.fields
            ]
        )

    def exists(self, table: str) -> bool:
        other = self._elsewhere(table)
        if other is not None:
            return self.spark.catalog.tableExists(other)
        name = self._quoted(table)
        if not self.spark.catalog.tableExists(name):
            return False
        if self.spark.catalog.getTable(name).isTemporary:
            raise OptionError(f"{table} is a temporary view; give the table a database name")
        return True

    def entry(self, table: str) -> TableEntry:
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._quoted(table)} AS JSON").first()[0]
        about = json.loads(text)
        return TableEntry(
            location=about.get("location"),
            provider=about.get("provider"),
            properties=about.get("table_properties", {}),
            bucket_columns=tuple(about.get("bucket_columns", ())),
            buckets=about.get("num_buckets"),
        )

    def table(self, name: str) -> DataFrame:
        """The table in place.

        A hash distributed table is scanned by bucket, so joins and groupings on its key need no
        shuffle.  If one bucket is far too large for a task, the files are scanned in even splits
        instead, and Spark shuffles and splits the hot key.  A replicated table is marked for
        broadcast when its rows are measured to fit ``broadcast_bytes``.
        """
        return self.tables(name)[0]

    def tables(self, *names: str) -> list[DataFrame]:
        """Tables to be joined with each other: by bucket only if none of them has an oversized
        bucket, because skew handling needs both sides of a join shuffled.

        ``read`` and ``unload`` of a query text look at the tables it names in the same way.
        """
        entries = [None if self._elsewhere(n) else self.entry(n) for n in names]
        by_bucket = all(e.spread.by_bucket for e in entries if e and e.buckets)
        frames = []
        for name, entry in zip(names, entries):
            if entry is None:
                frames.append(self.spark.table(quote_name(name)))
                continue
            frame = self.spark.table(self._quoted(name))
            if entry.buckets and not by_bucket:
                reader = self.spark.read.format(entry.provider).schema(frame.schema)
                frame = reader.load(entry.location)
            if entry.kind == "replicate" and self._fits_broadcast(frame, entry):
                frame = F.broadcast(frame)
            frames.append(frame)
        return frames

    def _fits_broadcast(self, frame: DataFrame, entry: TableEntry) -> bool:
        """Measure the rows about to be broadcast: files first, which costs no job, then, for files
        within the limit, the unpacked size, since a small file can hold many rows.  Nested columns
        have no simple size; Spark decides on those tables by itself."""
        if directory_bytes(self.spark, entry.location) > self.broadcast_bytes:
            return False
        width = F.lit(8 * (1 + math.ceil(len(frame.columns) / 64) + len(frame.columns)))
        for field in frame.schema.fields:
            if isinstance(field.dataType, (T.StringType, T.BinaryType)):
                size = F.octet_length(column_of(frame, field.name))
                width = width + F.coalesce(size, F.lit(0)) + F.lit(8)
            elif isinstance(field.dataType, T.DecimalType):
                width = width + F.lit(16)
            elif not isinstance(field.dataType, T.AtomicType) or field.dataType == T.VariantType():
                return False
        measured = frame.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]
        return measured <= self.broadcast_bytes

    # -- creating and dropping --------------------------------------------------------------------

    def create_table(
        self,
        table: str,
        schema: T.StructType,
        distribution: Distribution | str | None = None,
        table_options: Mapping[str, str] | None = None,
    ) -> None:
        """Create an empty table unless it exists.  NOT NULL columns are kept as a property, since
        Spark's file tables forget them, and are enforced when rows are loaded."""
        if self.exists(table):
            return
        other = self._elsewhere(table)
        if other is not None:
            self._refuse_layout(table, Distribution.of(distribution))
            self.spark.sql(f"CREATE TABLE {other} ({ddl_for(schema)}){_properties(table_options)}")
            return
        layout = Distribution.of(distribution).check(schema).sized(0)
        self._create_entry(table, schema, layout, table_options or {}, self._version_dir(table))

    def drop_table(self, table: str) -> None:
        """Remove the entry, if present.  Its files, when they are ours, go when the session ends."""
        if self.exists(table) and self._elsewhere(table):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._elsewhere(table)}")
        elif self.exists(table):
            location = self.entry(table).location
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(table)}")
            self._retire(location)

    def _version_dir(self, table: str) -> str:
        return "/".join([self.root, *self._parts(table), f"v_{uuid.uuid4().hex}"])

    def _retire(self, location: str | None) -> None:
        if location and not self.keep_old and is_below(location, self.root):
            self.area.register(location)

    def _create_entry(
        self,
        table: str,
        schema: T.StructType,
        layout: Distribution,
        table_options: Mapping[str, str],
        location: str,
    ) -> None:
        properties = {
            "stagehouse.distribution": layout.kind,
            "stagehouse.not_null": json.dumps([f.name for f in schema.fields if not f.nullable]),
            **table_options,
        }
        if layout.other:
            properties["stagehouse.table_options"] = ", ".join(layout.other)
        clustered = ""
        if layout.kind == "hash":
            columns = ", ".join(quote_part(c) for c in layout.columns)
            clustered = f"CLUSTERED BY ({columns}) INTO {layout.buckets} BUCKETS "
        listed = ", ".join(f"{quote_text(k)} = {quote_text(v)}" for k, v in properties.items())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._quoted(table)} ({ddl_for(schema)}) USING parquet "
            f"{clustered}LOCATION {quote_text(location)} TBLPROPERTIES ({listed})"
        )

    # -- loading ----------------------------------------------------------------------------------

    def _append(
        self, df: DataFrame, table: str, match: str = "name", files: StagedDataset | None = None
    ) -> int:
        other = self._elsewhere(table)
        if other is not None:
            frame = align(df, self.schema_of(table), match, table)
            counted = Observation()
            frame.observe(counted, F.count(F.lit(1)).alias("rows")).writeTo(other).append()
            return counted.get["rows"]
        entry = self.entry(table)
        frame = align(df, self.schema_of(table), match, table)
        if not entry.buckets:
            return self._insert(frame, table)
        with self._settled(frame, files) as settled:
            rows, spread = self._insert_clustered(settled, table, entry.layout())
        self._set_spread(table, entry.spread + spread)
        return rows

    def _append_batch(self, df: DataFrame, table: str, stream: str, number: int) -> None:
        """The number is a property of the table.  Before the insert it is noted as begun, with the rows
        there were and those to come; a batch found begun is looked at by the table's rows, which are
        counted from file footers: all there, it is done; none there, it is inserted; else somebody
        wrote beside it, which is an error."""
        if self._elsewhere(table):
            raise OptionError(f"{table}: batches of a stream are kept with tables of spark_catalog only")
        key = f"stagehouse.batch.{stream or 'stream'}"
        kept = json.loads(self.entry(table).properties.get(key, "{}"))
        if kept.get("done", -1) >= number:
            log.info("%s has batch %d of %s already", table, number, stream)
            return
        with self._settled(df) as settled:
            count = self.source(table).count()
            begun = kept.get("begun")
            if begun and begun[0] == number:
                _, before, rows = begun
                if count == before + rows and rows:
                    self._note(table, key, {"done": number})
                    return
                if count != before:
                    raise LoadError(
                        f"{table}: batch {number} of {stream!r} was begun at {before} rows, to add {rows}; "
                        f"there are {count}, so others wrote beside it"
                    )
            self._note(table, key, {**kept, "begun": [number, count, settled.count()]})
            self._append(settled.frame, table)
            self._note(table, key, {"done": number})

    def _note(self, table: str, key: str, value: Mapping) -> None:
        listed = f"{quote_text(key)} = {quote_text(json.dumps(value))}"
        self.spark.sql(f"ALTER TABLE {self._quoted(table)} SET TBLPROPERTIES ({listed})")

    def _publish(
        self,
        df: DataFrame,
        table: str,
        layout: Distribution,
        table_options: Mapping[str, str],
        replace: bool,
    ) -> None:
        """Write a new version and move the entry to it.

        The version directory is the staging directory of the load: rows are written once.  Only
        hash distribution stages first, because the rows per bucket must be known to split hot ones.
        """
        not_null = [f.name for f in df.schema.fields if not f.nullable]
        frame = guard_not_null(df, not_null, table)
        if self._elsewhere(table):
            self._publish_elsewhere(frame, table, layout, table_options, replace)
            return
        version = self._version_dir(table)
        building = self._beside(table, "new")
        try:
            if layout.kind == "hash":
                with self._settled(frame) as settled:
                    layout = layout.sized(settled.size)
                    self._create_entry(building, df.schema, layout, table_options, version)
                    _, spread = self._insert_clustered(settled, building, layout)
                self._set_spread(building, spread)
            else:
                if layout.partitions:
                    frame = frame.repartition(layout.partitions)
                self._create_entry(building, df.schema, layout, table_options, version)
                self._insert(frame, building)
            self._swap(building, table, replace)
        except BaseException:
            self._discard(building, table, version)
            raise

    def _publish_elsewhere(
        self,
        frame: DataFrame,
        table: str,
        layout: Distribution,
        table_options: Mapping[str, str],
        replace: bool,
    ) -> None:
        """A table of another catalog, by that catalog's own writer.  A replacement that the catalog
        cannot make in one step would lose the old rows if it failed, so it is refused."""
        self._refuse_layout(table, layout)
        catalog = split_name(table)[0]
        if replace:
            jvm_catalog = self.spark._jsparkSession.sessionState().catalogManager().catalog(catalog)
            staging = "org.apache.spark.sql.connector.catalog.StagingTableCatalog"
            if not self.spark._jvm.java.lang.Class.forName(staging).isInstance(jvm_catalog):
                raise OptionError(
                    f"catalog {catalog} cannot replace {table} in one step; drop the table and write it "
                    "anew, or append"
                )
        writer = frame.writeTo(self._elsewhere(table))
        for key, value in table_options.items():
            writer = writer.tableProperty(key, value)
        if replace:
            writer.createOrReplace()
        else:
            writer.create()

    @staticmethod
    def _refuse_layout(table: str, layout: Distribution) -> None:
        if layout.kind != "round_robin" or layout.partitions or layout.other:
            raise OptionError(f"{table}: layouts are for tables of spark_catalog; its catalog has its own")

    def _beside(self, table: str, word: str) -> str:
        """A fresh name in the database of the table."""
        return ".".join([*map(quote_part, self._parts(table)[:-1]), f"{word}_{uuid.uuid4().hex}"])

    def _swap(self, building: str, table: str, replace: bool) -> None:
        """Move the entry: the old one steps aside, and comes back if the new one cannot."""
        if not replace:
            self._rename(building, table)
            return
        old, location = self._beside(table, "old"), self.entry(table).location
        self._rename(table, old)
        try:
            self._rename(building, table)
        except BaseException:
            self._rename(old, table)
            raise
        try:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(old)}")
            self._retire(location)
        except Exception:
            log.exception("%s has its new version; entry %s of the old one is left", table, old)

    def _discard(self, building: str, table: str, version: str) -> None:
        """Remove what a failed write made, unless the entry of the table has moved to it."""
        if self.exists(table) and path_parts(self.entry(table).location) == path_parts(version):
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(building)}")
        path, fs = hadoop_path(self.spark, version)
        fs.delete(path, True)

    def _rename(self, table: str, name: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._quoted(table)} RENAME TO {self._quoted(name)}")

    def _insert_clustered(
        self, settled: SettledRows, table: str, layout: Distribution
    ) -> tuple[int, BucketSpread]:
        """One INSERT whose tasks hold one bucket each, after counting the rows per bucket."""
        counts = count_buckets(settled.frame, layout)
        largest, rows = max(counts.values(), default=0), sum(counts.values())
        spread = BucketSpread(layout.buckets, largest, rows, settled.size)
        if not spread.by_bucket:
            log.warning("the largest of %d buckets has %d of %d rows", *astuple(spread)[:3])
        slices = slice_buckets(counts, layout.buckets, settled.size)
        frame = cluster_by_bucket(widen_splits(settled.frame, settled.size), layout, slices)
        with self._unsorted_buckets():
            return self._insert(frame, table), spread

    def _insert(self, frame: DataFrame, table: str) -> int:
        """One INSERT job.  Its output shows when the job commits; a rerun task adds nothing twice."""
        counted = Observation()
        observed = frame.observe(counted, F.count(F.lit(1)).alias("rows"))
        observed.write.insertInto(self._quoted(table))
        if frame.sparkSession is not self.spark:  # as in foreachBatch: our cached file list is old
            self.spark.catalog.refreshTable(self._quoted(table))
        return counted.get["rows"]

    @contextmanager
    def _unsorted_buckets(self):
        """Spark sorts every task of a bucketed write by bucket, unless writers may stay open side by
        side.  Our tasks hold one bucket each, so one writer does, and nothing is sorted or spilled."""
        key = "spark.sql.maxConcurrentOutputFileWriters"
        with _WRITER_SETTING:  # one thread at a time, else another restores the wrong value
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, str(max(1, int(before))))
            try:
                yield
            finally:
                self.spark.conf.set(key, before)

    def _set_spread(self, table: str, spread: BucketSpread) -> None:
        kept = zip(_SPREAD, (spread.largest_rows, spread.rows, spread.staged_bytes))
        listed = ", ".join(f"'stagehouse.{k}' = '{v}'" for k, v in kept)
        self.spark.sql(f"ALTER TABLE {self._quoted(table)} SET TBLPROPERTIES ({listed})")
