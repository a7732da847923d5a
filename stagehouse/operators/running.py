"""Row numbers and previous rows within keys, where one key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagehouse.functions.names import quote_part
from stagehouse.sources.staging import StagingArea, stage


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | tuple[str, str]],
    area: StagingArea,
    number: str = "rn",
    previous: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with ``number``, the place of a row within its key from 1, and for each entry of
    ``previous`` (new column: column) the value in the row before, for each of ``totals`` the running
    sum of a column up to the row.  Null keys are one key; no ``keys`` number the whole table.  ``order`` names columns, a pair with "desc" falls; nulls come
    first in rising order and last in falling order.  Rows that it leaves equal are numbered in some
    order.

    The table is cut into ranges of (keys, order), whole rows of equal place being dealt out too, so
    a key spreads over as many ranges as its rows fill and no window group is larger than a range.
    A range's own numbers are written to ``area`` with the last row of every key in it; a key that
    goes over several ranges then gets the count and the last row of the ranges before.  At most one
    key goes on from a range to the next, so these carries are at most two rows a range, whatever the
    number of rows, and are broadcast.  An empty table gives an empty result.
    """
    previous, totals = dict(previous or {}), dict(totals or {})
    inner = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    held = df.select(
        *[F.col(quote_part(c)).alias(inner[c]) for c in df.columns],
        F.struct(*[F.col(quote_part(k)) for k in keys], F.lit(0)).alias("__key"),
        F.monotonically_increasing_id().alias("__tie"),
    )
    places = [
        F.col(inner[o]).asc() if isinstance(o, str) else F.col(inner[o[0]]).desc() for o in order
    ]
    places.append(F.col("__tie").asc())
    sizes = (ranges,) if ranges else ()
    ranged = held.repartitionByRange(*sizes, F.col("__key"), *places).withColumn(
        "__range", F.spark_partition_id()
    )
    within = Window.partitionBy("__range", "__key").orderBy(*places)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    # whether a row is its range's last of the key, and, beside it, what follows needs from it
    local = ranged.select(
        *inner.values(),
        "__key",
        "__range",
        F.row_number().over(within).cast("long").alias("__nth"),
        F.lead(F.lit(False), 1, True).over(within).alias("__last"),
        *[
            F.lag(F.col(inner[c])).over(within).alias(f"__p{i}")
            for i, c in enumerate(previous.values())
        ],
        *[
            F.sum(F.col(inner[c])).over(so_far).alias(f"__t{i}")
            for i, c in enumerate(totals.values())
        ],
    )
    local = stage(local, area).scan()
    by_range = Window.partitionBy("__key").orderBy("__range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    lasts = local.where("__last")
    carries = (
        lasts.select(
            "__key",
            "__range",
            F.sum("__nth").over(earlier).alias("__before"),
            *[
                F.lag(F.col(inner[c])).over(by_range).alias(f"__b{i}")
                for i, c in enumerate(previous.values())
            ],
            *[F.sum(f"__t{i}").over(earlier).alias(f"__s{i}") for i in range(len(totals))],
        )
        .where("__before IS NOT NULL")  # keys that begin in this range need none
        .withColumnsRenamed({"__key": "__k", "__range": "__r"})
    )
    on = (F.col("__range") == F.col("__r")) & F.col("__key").eqNullSafe(F.col("__k"))
    joined = local.join(F.broadcast(carries), on, "left")
    return joined.select(
        *[F.col(inner[c]).alias(c) for c in df.columns],
        (F.col("__nth") + F.coalesce("__before", F.lit(0))).alias(number),
        *[
            F.when(F.col("__nth") == 1, F.col(f"__b{i}")).otherwise(F.col(f"__p{i}")).alias(new)
            for i, new in enumerate(previous)
        ],
        *[_added(f"__t{i}", f"__s{i}").alias(new) for i, new in enumerate(totals)],
    )


def _added(a: str, b: str) -> Column:
    """Sum of two columns as ``sum`` takes it: nulls count for nothing."""
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))

