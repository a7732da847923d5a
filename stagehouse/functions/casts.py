"""Reading under a schema the caller gives: reorder, subset, widen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import SchemaError

# Decimal digits that hold every value of an integer type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_INTEGERS = list(_DIGITS)
# The integer types each floating type holds exactly.
_EXACT_IN = {
    T.FloatType: (T.ByteType, T.ShortType),
    T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType),
}


def widens(source: T.DataType, target: T.DataType) -> bool:
    """True when every value of ``source`` is kept whole as ``target``."""
    a, b = type(source), type(target)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return widens(source.elementType, target.elementType)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return widens(source.keyType, target.keyType) and widens(source.valueType, target.valueType)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return source.names == target.names and all(
            widens(x.dataType, y.dataType) for x, y in zip(source.fields, target.fields)
        )
    if isinstance(target, T.DecimalType):
        whole, fraction = target.precision - target.scale, target.scale
        if isinstance(source, T.DecimalType):
            return source.precision - source.scale <= whole and source.scale <= fraction
        return a in _DIGITS and _DIGITS[a] <= whole
    if source == target:
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType) and not isinstance(source, T.BinaryType)
    if a in _INTEGERS and b in _INTEGERS:
        return _INTEGERS.index(a) < _INTEGERS.index(b)
    if isinstance(source, T.DateType):
        return isinstance(target, (T.TimestampType, T.TimestampNTZType))
    return a in _EXACT_IN.get(b, ())


def column_of(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def find_field(schema: T.StructType, name: str) -> T.StructField | None:
    """The field of that name, case ignored as in Spark SQL; an exact match wins."""
    close = [f for f in schema.fields if f.name.lower() == name.lower()]
    exact = [f for f in close if f.name == name]
    if not exact and len(close) > 1:
        raise SchemaError(f"column {name!r} is ambiguous: {', '.join(f.name for f in close)}")
    return (exact or close or [None])[0]


def fit(source: T.StructType, wanted: T.StructType) -> list[tuple[str, T.StructField]]:
    """For each wanted field, the source column that gives it.

    A missing column, or a type that could lose values, is an error.
    """
    problems, pairs = [], []
    for field in wanted.fields:
        found = find_field(source, field.name)
        if found is None:
            problems.append(f"column {field.name!r} is missing")
        elif not widens(found.dataType, field.dataType):
            problems.append(
                f"column {field.name!r}: {found.dataType.simpleString()} does not fit into "
                f"{field.dataType.simpleString()}"
            )
        else:
            pairs.append((found.name, field))
    if problems:
        raise SchemaError("; ".join(problems))
    return pairs


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``; one lazy projection."""
    return df.select(
        [column_of(df, n).cast(f.dataType).alias(f.name) for n, f in fit(df.schema, schema)]
    )


def guard_not_null(df: DataFrame, names: list[str], where: str) -> DataFrame:
    """``df`` whose rows fail the job when one of the named columns is null.

    File tables do not enforce NOT NULL, so the check is part of the plan that loads them.
    """
    guarded = {
        n: F.when(column_of(df, n).isNotNull(), column_of(df, n)).otherwise(
            F.raise_error(F.lit(f"null in column {n} of {where}, which is declared NOT NULL"))
        )
        for n in names
    }
    return df.withColumns(guarded) if guarded else df
