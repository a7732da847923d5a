"""How the rows of a table are spread: by hash of columns, evenly, or as a copy for every reader."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import OptionError, SchemaError
from stagehouse.functions.casts import column_of, find_field
from stagehouse.functions.ddl import quote_column

_HASH = re.compile(r"(?:DISTRIBUTION\s*=\s*)?HASH\s*\((.*)\)", re.IGNORECASE | re.DOTALL)
_WORD = re.compile(r"(?:DISTRIBUTION\s*=\s*)?(ROUND_ROBIN|REPLICATE)", re.IGNORECASE)

MIN_BUCKETS, MAX_BUCKETS = 8, 65536
BUCKET_BYTES = 1 << 30  # aim for buckets of this many staged bytes
FILE_BYTES = 2 << 30  # no task loads much more than this many staged bytes
MAP_BYTES = 1 << 30  # a shuffle of very many small splits reads them in tasks of this size
HOT_FACTOR = 4.0  # a bucket this many times the mean counts as hot,
HOT_BYTES = 256 << 20  # unless it is this small;
SCAN_BYTES = 4 << 30  # any bucket above this is too much for one scan task


@dataclass(frozen=True)
class Distribution:
    """Layout of a table.

    ``hash`` clusters rows by ``columns`` into ``buckets`` (None: from the size of the data).
    ``round_robin`` spreads rows evenly; with ``partitions`` into that many files, else the splits
    of the written frame stay as they are and nothing is shuffled.  ``replicate`` marks a small
    table that readers may broadcast.  ``other`` keeps layout clauses Spark has no use for.
    """

    kind: str = "round_robin"
    columns: tuple[str, ...] = ()
    buckets: int | None = None
    partitions: int | None = None
    other: tuple[str, ...] = ()

    @classmethod
    def hash(cls, *columns: str, buckets: int | None = None) -> "Distribution":
        if not columns:
            raise OptionError("a hash distribution names at least one column")
        if buckets is not None and buckets < 1:
            raise OptionError("a hash distribution has at least one bucket")
        return cls("hash", columns=columns, buckets=buckets)

    @classmethod
    def round_robin(cls, partitions: int | None = None) -> "Distribution":
        return cls("round_robin", partitions=partitions)

    @classmethod
    def replicate(cls) -> "Distribution":
        return cls("replicate")

    @classmethod
    def parse(cls, text: str | None) -> "Distribution":
        """Read a layout text such as ``HEAP, DISTRIBUTION = HASH([o_custkey])``."""
        found, other = None, []
        for clause in split_list(text or ""):
            hashed, word = _HASH.fullmatch(clause), _WORD.fullmatch(clause)
            if hashed:
                names = tuple(_bare(c) for c in split_list(hashed.group(1), keep_empty=True))
                if not all(names):
                    raise OptionError(f"empty column name in {clause!r}")
                layout = cls.hash(*names)
            elif word:
                layout = cls(word.group(1).lower())
            elif clause:
                other.append(clause)
                continue
            else:
                continue
            if found is not None:
                raise OptionError(f"more than one distribution in {text!r}")
            found = layout
        return replace(found or cls(), other=tuple(other))

    @classmethod
    def of(cls, value: "Distribution | str | None") -> "Distribution":
        return value if isinstance(value, cls) else cls.parse(value)

    def clause(self, dialect) -> str:
        """What follows the column list of CREATE TABLE in a database: the ``tsql`` dialect takes the
        whole layout, others only the clauses this class does not know."""
        if dialect != "tsql":
            return " ".join(self.other)
        # HEAP and DISTRIBUTION = ROUND_ROBIN are what a table without a layout gets.
        words = self.kind.upper()
        if self.kind == "hash":
            words = f"HASH({', '.join(quote_column(c, dialect) for c in self.columns)})"
        return f"WITH ({', '.join([*(self.other or ('HEAP',)), f'DISTRIBUTION = {words}'])})"

    def check(self, schema: T.StructType) -> "Distribution":
        """The same layout with column names as the schema spells them; unknown ones are an error."""
        fields = [find_field(schema, c) for c in self.columns]
        unknown = [c for c, f in zip(self.columns, fields) if f is None]
        if unknown:
            raise SchemaError(
                f"distribution column {', '.join(unknown)} not in {', '.join(schema.names)}"
            )
        return replace(self, columns=tuple(f.name for f in fields))

    def sized(self, staged_bytes: int) -> "Distribution":
        """With a bucket count that keeps buckets near BUCKET_BYTES; a power of two, so tables of
        different size stay multiples of each other."""
        if self.kind != "hash" or self.buckets:
            return self
        wanted = max(1, math.ceil(staged_bytes / BUCKET_BYTES))
        count = 1 << (wanted - 1).bit_length()
        return replace(self, buckets=min(max(count, MIN_BUCKETS), MAX_BUCKETS))


def split_list(text: str, keep_empty: bool = False) -> list[str]:
    """The parts of a list between commas that stand in no parentheses, brackets or quotes."""
    closing, inside, parts, start = {"(": ")", "[": "]"}, [], [], 0
    for at, letter in enumerate(text):
        if inside and inside[-1] not in ")":
            if letter == inside[-1]:
                inside.pop()
        elif letter in closing:
            inside.append(closing[letter])
        elif letter in "\"'`":
            inside.append(letter)
        elif letter in ")]":
            if not inside or inside.pop() != letter:
                raise OptionError(f"unbalanced {letter} in {text!r}")
        elif letter == "," and not inside:
            parts.append(text[start:at])
            start = at + 1
    if inside:
        raise OptionError(f"{inside[-1]} is missing in {text!r}")
    parts = [p.strip() for p in [*parts, text[start:]]]
    return parts if keep_empty else [p for p in parts if p]


def _bare(name: str) -> str:
    name = name.strip()
    for left, right in (("[", "]"), ('"', '"'), ("`", "`")):
        if len(name) > 1 and name.startswith(left) and name.endswith(right):
            return name[1:-1]
    return name


def bucket_of(df: DataFrame, columns: tuple[str, ...], buckets: int) -> Column:
    """The bucket Spark's bucketed tables put a row into."""
    return F.pmod(F.hash(*[column_of(df, c) for c in columns]), F.lit(buckets))


@dataclass(frozen=True)
class BucketSpread:
    """How the rows of a table fall into its buckets.  ``staged_bytes`` is the size of all rows."""

    buckets: int
    largest_rows: int
    rows: int
    staged_bytes: int

    @property
    def by_bucket(self) -> bool:
        """False when one scan task per bucket would leave one task with far too much."""
        largest = self.staged_bytes * self.largest_rows / self.rows if self.rows else 0
        is_hot = self.largest_rows * self.buckets > HOT_FACTOR * self.rows
        return largest <= (HOT_BYTES if is_hot else SCAN_BYTES)

    def __add__(self, more: "BucketSpread") -> "BucketSpread":
        """After an append; the largest bucket is then an upper bound."""
        return BucketSpread(
            self.buckets,
            self.largest_rows + more.largest_rows,
            self.rows + more.rows,
            self.staged_bytes + more.staged_bytes,
        )


def count_buckets(df: DataFrame, layout: Distribution) -> dict[int, int]:
    """Rows per bucket: scans the key columns only, combines before the shuffle, and returns one row
    per bucket, a number the layout fixes."""
    bucket = bucket_of(df, layout.columns, layout.buckets).alias("bucket")
    return dict(df.select(bucket).groupBy("bucket").count().collect())


def slice_buckets(counts: dict[int, int], buckets: int, staged_bytes: int) -> list[int]:
    """How many tasks load each bucket, one at least, so that none loads far more than FILE_BYTES."""
    row_bytes = staged_bytes / max(1, sum(counts.values()))
    return [max(1, math.ceil(counts.get(b, 0) * row_bytes / FILE_BYTES)) for b in range(buckets)]


def widen_splits(df: DataFrame, staged_bytes: int) -> DataFrame:
    """Fewer, larger scan tasks where there are many times more than the cluster runs at once: each
    task of a wide shuffle writes a block for every target, and tiny blocks are slow to fetch."""
    tasks = staged_bytes // MAP_BYTES
    if tasks > 4 * df.sparkSession.sparkContext.defaultParallelism:
        return df.coalesce(tasks)
    return df


def cluster_by_bucket(df: DataFrame, layout: Distribution, slices: list[int]) -> DataFrame:
    """``df`` shuffled so that every task holds rows of one bucket only.

    One file per bucket comes out, several for a bucket too large for one task: its rows are dealt
    out by their position in the scan, which a rerun task repeats exactly, so neither a hot key nor
    many copies of one row end up in one task.
    """
    starts, total = [], 0
    for count in slices:
        starts.append(total)
        total += count
    names = df.columns
    with_bucket = df.withColumn("__bucket", bucket_of(df, layout.columns, layout.buckets))
    if total == layout.buckets:
        target = F.col("__bucket")
        placed = with_bucket
    else:
        placed = with_bucket.withColumn("__deal", F.monotonically_increasing_id())
        of = F.get(_int_array(slices), F.col("__bucket"))
        target = F.get(_int_array(starts), F.col("__bucket")) + F.pmod(F.col("__deal"), of)
    return placed.repartitionById(total, target.cast("int")).select(
        [column_of(df, n) for n in names]
    )


def _int_array(values) -> Column:
    """An array constant; one text literal, which the optimizer folds once, instead of one per value."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")
