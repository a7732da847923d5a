"""JSON and CSV files that give back exactly what was written.

What the formats cannot tell apart by themselves is written so that they can.  In CSV, strings are
escaped (a backslash as ``\\s``, line ends as ``\\n`` and ``\\r``, NUL as ``\\0``, the empty string as
``\\e``), so every record is one line, files stay splittable, and ``\\N`` is null and nothing else; bytes
are hexadecimal.  In both, times have microseconds and instants are written in UTC.  Types without such a
form are refused before any job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.errors import SchemaError
from stagehouse.functions.casts import column_of

FORMATS = ("json", "csv")
# Options of Spark's sources; the ones of a named format go before them.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
    "mode": "FAILFAST",
}
_CSV = {
    "nullValue": "\\N",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What is escaped in strings, in the order of writing; reading goes backwards.
_ESCAPES = (("\\", "\\s"), ("\0", "\\0"), ("\n", "\\n"), ("\r", "\\r"))
_EMPTY = "\\e"
_NO_TEXT = (T.AnsiIntervalType, T.CalendarIntervalType, T.VariantType, T.NullType)


def exact_options(file_format: str, options: Mapping[str, str]) -> dict[str, str]:
    """The options of a named format with what exactness needs beside them; the named ones win."""
    named = {k.lower() for k in options}
    wanted = {**_TIMES, **(_CSV if file_format == "csv" else {})}
    return {**{k: v for k, v in wanted.items() if k.lower() not in named}, **options}


def check_text(schema: T.StructType, file_format: str) -> None:
    """Refuse columns that a text format cannot give back."""
    problems = [
        f"column {f.name!r}: {f.dataType.simpleString()} has no exact {file_format} form"
        for f in schema.fields
        if not _has_text(f.dataType, file_format)
    ]
    if len({n.lower() for n in schema.names}) < len(schema.names):
        problems.append("column names differ in case only")
    if not schema.fields:
        problems.append(f"{file_format} needs at least one column")
    if problems:
        raise SchemaError("; ".join(problems))


def _has_text(data_type: T.DataType, file_format: str) -> bool:
    if isinstance(data_type, _NO_TEXT):
        return False
    if isinstance(data_type, T.AtomicType):
        return True
    if file_format == "csv":
        return False
    if isinstance(data_type, T.ArrayType):
        return _has_text(data_type.elementType, file_format)
    if isinstance(data_type, T.MapType):
        return isinstance(data_type.keyType, T.StringType) and _has_text(
            data_type.valueType, file_format
        )
    if isinstance(data_type, T.StructType):
        return all(_has_text(f.dataType, file_format) for f in data_type.fields)
    return False


def encode(df: DataFrame, file_format: str) -> DataFrame:
    if file_format != "csv":
        return df
    return df.select([_written(column_of(df, f.name), f.dataType).alias(f.name) for f in df.schema])


def decode(df: DataFrame, schema: T.StructType, file_format: str) -> DataFrame:
    if file_format != "csv":
        return df
    return df.select([_read(column_of(df, f.name), f.dataType).alias(f.name) for f in schema])


def file_schema(schema: T.StructType, file_format: str) -> T.StructType:
    """The schema the files are parsed under."""
    if file_format != "csv":
        return schema
    return T.StructType(
        [
            T.StructField(
                f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType
            )
            for f in schema.fields
        ]
    )


def _written(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("x"), F.hex(column))  # never an empty field
    if not isinstance(data_type, T.StringType):
        return column
    text = column
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.when(column == "", F.lit(_EMPTY)).otherwise(text)


def _read(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        return F.unhex(F.substr(column, F.lit(2)))
    if not isinstance(data_type, T.StringType):
        return column
    text = column
    for plain, escaped in reversed(_ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return F.when(column == _EMPTY, F.lit("")).otherwise(text)
