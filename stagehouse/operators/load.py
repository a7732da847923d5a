"""Fitting a frame to the columns of an existing table before it is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import OptionError, SchemaError
from stagehouse.functions.casts import column_of, find_field, guard_not_null

MATCHES = ("name", "position")


def align(df: DataFrame, target: T.StructType, match: str, table: str) -> DataFrame:
    """``df`` with the columns of ``target`` in its order, NOT NULL columns guarded.

    By name (case ignored): a source column the table lacks is an error, a nullable column the
    source lacks becomes null, a NOT NULL one is an error.  By position: the counts must agree.
    Types are left to the store assignment rules of the insert.
    """
    if match == "position":
        if len(df.columns) != len(target):
            raise SchemaError(f"{table} has {len(target)} columns, the source {len(df.columns)}")
        chosen = df.toDF(*target.names)
    elif match == "name":
        extra = [n for n in df.columns if find_field(target, n) is None]
        missing, columns = [], []
        for field in target.fields:
            found = find_field(df.schema, field.name)
            if found is not None:
                columns.append(column_of(df, found.name).alias(field.name))
            elif field.nullable:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            else:
                missing.append(field.name)
        if extra:
            raise SchemaError(f"{table} has no column {', '.join(extra)}")
        if missing:
            raise SchemaError(f"the source lacks NOT NULL column {', '.join(missing)} of {table}")
        chosen = df.select(columns)
    else:
        raise OptionError(f"match must be one of {', '.join(MATCHES)}, not {match!r}")
    return guard_not_null(chosen, [f.name for f in target.fields if not f.nullable], table)
