"""Staging directories: unique names, one registry, deleted when the session's JVM ends."""

from __future__ import annotations

import logging
import threading
import time
import uuid
import weakref
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import OptionError
from stagehouse.functions.casts import conform
from stagehouse.sources import text_codec

log = logging.getLogger(__name__)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its own file system, so ``file:``, ``hdfs:`` and object stores all work."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def directory_bytes(spark: SparkSession, path: str) -> int:
    p, fs = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: the one the cluster names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    raise OptionError("spark.checkpoint.dir is not set: name a folder all executors can reach")


def path_parts(path: str) -> tuple[str, tuple[str, ...]]:
    """Scheme with authority, and the directory names; ``file:/a``, ``file:///a`` and ``/a`` agree."""
    split = urlsplit(path)
    place = "" if split.scheme in ("", "file") else f"{split.scheme}://{split.netloc}"
    return place, tuple(p for p in split.path.split("/") if p)


def is_below(path: str, root: str) -> bool:
    """True for a strict child; compares directory names, so ``/a/bc`` is not below ``/a/b``."""
    (place, parts), (root_place, root_parts) = path_parts(path), path_parts(root)
    return (
        place == root_place
        and len(parts) > len(root_parts)
        and parts[: len(root_parts)] == root_parts
    )


@dataclass(frozen=True)
class StagedDataset:
    """Files of one export.  ``scan()`` reads them back in the format they were written in.

    ``rows`` is None for files that somebody else wrote.
    """

    spark: SparkSession = field(repr=False, compare=False)
    path: str
    schema: T.StructType
    rows: int | None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def scan(self, schema: T.StructType | None = None) -> DataFrame:
        """A lazy DataFrame over the files, columnar and open to pushdown and pruning.

        ``schema`` is handed to the reader as it is: columns match by name, integers and decimals
        widen in the scan.  Use ``functions.conform`` for anything beyond that.  JSON and CSV that this
        package wrote come back as they were, then conform to ``schema``.
        """
        reader = self.spark.read.format(self.format).options(**self.options)
        if self.format not in text_codec.FORMATS or self.rows is None:
            return reader.schema(schema or self.schema).load(self.path)
        parsed = reader.schema(text_codec.file_schema(self.schema, self.format)).load(self.path)
        decoded = text_codec.decode(parsed, self.schema, self.format)
        return decoded if schema is None else conform(decoded, schema)


LEASE = ".lease"
LEASE_HOURS = 24.0
_areas: weakref.WeakSet = weakref.WeakSet()
_renewing = threading.Lock()
_thread: list[threading.Thread] = []


def _keep_renewing(area: "StagingArea") -> None:
    """One thread of the process renews the leases of all areas, each four times in its length."""
    with _renewing:
        if not area._renewed:
            area._renewed = time.time()
        _areas.add(area)
        if not _thread:
            _thread.append(threading.Thread(target=_renew_leases, daemon=True, name="leases"))
            _thread[0].start()


def _renew_leases() -> None:
    while True:
        time.sleep(60)
        for area in list(_areas):
            if time.time() - area._renewed > 900 * area.lease_hours and area._leases:
                area.renew()


class StagingArea:
    """Directories below ``base`` for this session.

    ``new_dir`` makes one; whatever is left is deleted by the file system when the JVM ends, or
    earlier by ``release``, or by leaving the ``with`` block.

    A process that is killed deletes nothing, so every directory of the base has a lease beside it: a file
    ``run_<id>.lease`` with the time it ends, which a thread puts off for as long as the process lives.
    Whoever opens an area on the same base deletes directories whose lease has ended.  A directory
    without a lease, such as one that was kept, is never touched.
    """

    def __init__(self, spark: SparkSession, base: str, lease_hours: float = LEASE_HOURS):
        self.spark = spark
        self.base = base.rstrip("/")
        self.lease_hours = lease_hours
        self._paths: dict[tuple, str] = {}
        self._leases: set[str] = set()
        self._renewed = 0.0
        self.sweep()

    def __enter__(self) -> "StagingArea":
        return self

    def __exit__(self, *_exc) -> None:
        self.release_all()

    def __contains__(self, path: str) -> bool:
        return path_parts(path) in self._paths

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(self._paths.values()))

    def __len__(self) -> int:
        return len(self._paths)

    def covers(self, path: str) -> bool:
        """True when the path lies below a registered directory, without being one itself."""
        place, parts = path_parts(path)
        above = ((place, parts[:i]) for i in range(len(parts)))
        return path not in self and any(p in self._paths for p in above)

    def new_dir(self, parent: str | None = None) -> str:
        path = f"{(parent or self.base).rstrip('/')}/run_{uuid.uuid4().hex}"
        p, fs = hadoop_path(self.spark, path)
        fs.mkdirs(p)
        if fs.getUri().getScheme() != "file":  # say which file system, for readers outside Hadoop
            path = fs.makeQualified(p).toString()
        self.register(path)
        if parent is None:
            self._lease(path)
        return path

    # -- leases -----------------------------------------------------------------------------------

    def _lease(self, path: str) -> None:
        self._leases.add(path)
        self._write_lease(path)
        _keep_renewing(self)

    def _write_lease(self, path: str) -> None:
        file, fs = hadoop_path(self.spark, path + LEASE)
        out = fs.create(file, True)
        out.write(bytearray(str(time.time() + 3600 * self.lease_hours).encode()))
        out.close()
        fs.deleteOnExit(file)

    def renew(self) -> None:
        """Put off the end of all leases; a failure is logged and tried again the next time."""
        self._renewed = time.time()
        for path in list(self._leases):
            try:
                self._write_lease(path)
            except Exception:
                log.exception("could not renew the lease of %s", path)

    def sweep(self) -> list[str]:
        """Delete the directories below the base whose lease has ended; returns them."""
        swept = []
        base, fs = hadoop_path(self.spark, self.base)
        try:
            listed = fs.listStatus(base) if fs.exists(base) else []
            names = [s.getPath().getName() for s in listed]
        except Exception:
            log.exception("could not look for expired directories in %s", self.base)
            return swept
        for name in names:
            directory = f"{self.base}/{name.removesuffix(LEASE)}"
            if not (name.startswith("run_") and name.endswith(LEASE)) or directory in self:
                continue
            try:
                if self._ended(directory):
                    for gone in (directory, directory + LEASE):
                        fs.delete(hadoop_path(self.spark, gone)[0], True)
                    swept.append(directory)
                    log.warning("deleted %s, whose lease had ended", directory)
            except Exception:
                log.exception("could not look at the lease of %s", directory)
        return swept

    def _ended(self, directory: str) -> bool:
        file, fs = hadoop_path(self.spark, directory + LEASE)
        java = self.spark._jvm.java.io
        stream = fs.open(file)
        try:
            text = java.BufferedReader(java.InputStreamReader(stream)).readLine()
        finally:
            stream.close()
        return bool(text) and float(text) < time.time()

    def _end_lease(self, path: str) -> None:
        if path in self._leases:
            self._leases.discard(path)
            file, fs = hadoop_path(self.spark, path + LEASE)
            fs.delete(file, False)
            fs.cancelDeleteOnExit(file)

    # -- the registry -----------------------------------------------------------------------------

    def register(self, path: str) -> None:
        """Delete ``path`` at exit.  Registering it again changes nothing."""
        if path in self:
            return
        p, fs = hadoop_path(self.spark, path)
        fs.deleteOnExit(p)
        self._paths[path_parts(path)] = path

    def keep(self, path: str) -> None:
        """Take ``path`` off the registry; it stays on disk after exit."""
        known = self._paths.pop(path_parts(path), None)
        if known is not None:
            p, fs = hadoop_path(self.spark, known)
            fs.cancelDeleteOnExit(p)
            self._end_lease(known)

    def release(self, path: str) -> None:
        """Delete now, whole tree; a path that is gone already is no error."""
        p, fs = hadoop_path(self.spark, path)
        fs.delete(p, True)
        self.keep(path)

    def release_all(self) -> None:
        """Release every path; one that fails is logged, stays registered, and does not stop the rest."""
        for path in list(self):
            try:
                self.release(path)
            except Exception:
                log.exception("could not delete staging directory %s", path)


def stage(
    df: DataFrame,
    area: StagingArea,
    parent: str | None = None,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StagedDataset:
    """Write ``df`` to a new directory of ``area`` in one job; the row count comes from that job.

    A failed job leaves no directory behind.  JSON and CSV are written so that ``scan`` gives back the
    same rows; a column that has no such form is refused before the job.
    """
    options = dict(options or {})
    if file_format in text_codec.FORMATS:
        text_codec.check_text(df.schema, file_format)
        options = text_codec.exact_options(file_format, options)
    path = area.new_dir(parent)
    counted = Observation()
    frame = text_codec.encode(df, file_format) if file_format in text_codec.FORMATS else df
    frame = frame.observe(counted, F.count(F.lit(1)).alias("rows"))
    try:
        frame.write.format(file_format).options(**options).mode("append").save(path)
    except BaseException:
        area.release(path)
        raise
    return StagedDataset(
        spark=area.spark,
        path=path,
        schema=df.schema,
        rows=counted.get["rows"],
        format=file_format,
        options=options,
    )
