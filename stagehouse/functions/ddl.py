"""Column lists of CREATE TABLE, from a Spark schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from stagehouse.errors import SchemaError
from stagehouse.functions.dialects import UrlDialect

# Spark type -> type word of the warehouse, one column per dialect.
# {n} is the string length, {b} the binary length, {p} and {s} precision and scale.
_TYPE_WORDS = {
    T.LongType: {"ansi": "bigint", "tsql": "bigint"},
    T.IntegerType: {"ansi": "int", "tsql": "int"},
    T.ShortType: {"ansi": "smallint", "tsql": "smallint"},
    T.ByteType: {"ansi": "smallint", "tsql": "smallint"},
    T.BooleanType: {"ansi": "boolean", "tsql": "bit"},
    T.FloatType: {"ansi": "real", "tsql": "real"},
    T.DoubleType: {"ansi": "double", "tsql": "float"},
    T.DecimalType: {"ansi": "decimal({p},{s})", "tsql": "decimal({p},{s})"},
    T.StringType: {"ansi": "varchar({n})", "tsql": "nvarchar({n})"},
    T.BinaryType: {"ansi": "varbinary({b})", "tsql": "varbinary({b})"},
    T.DateType: {"ansi": "date", "tsql": "date"},
    T.TimestampType: {"ansi": "timestamp", "tsql": "datetime2"},
    T.TimestampNTZType: {"ansi": "timestamp", "tsql": "datetime2"},
}

DIALECTS = ("spark", "ansi", "tsql")


def type_word(
    column: str,
    data_type: T.DataType,
    dialect: str | UrlDialect = "ansi",
    string_length: int | str = 4000,
    binary_length: int | str = 8000,
    overrides: Mapping[type[T.DataType], str] | None = None,
) -> str:
    words = _TYPE_WORDS.get(type(data_type))
    if words is None:
        named = dialect if isinstance(dialect, str) else "database"
        raise SchemaError(
            f"column {column!r}: {data_type.simpleString()} has no {named} type; "
            "nested and interval columns stay in the Spark catalog"
        )
    if isinstance(dialect, UrlDialect):
        return dialect.type_word(column, data_type, words["ansi"], overrides or {})
    word = (overrides or {}).get(type(data_type), words[dialect])
    return word.format(
        n=string_length,
        b=binary_length,
        p=getattr(data_type, "precision", None),
        s=getattr(data_type, "scale", None),
    )


def quote_column(name: str, dialect: str | UrlDialect) -> str:
    if isinstance(dialect, UrlDialect):
        return dialect.quote(name)
    if dialect == "tsql":
        return "[" + name.replace("]", "]]") + "]"
    return '"' + name.replace('"', '""') + '"'


def ddl_for(
    schema: T.StructType,
    dialect: str | UrlDialect = "spark",
    string_length: int | str = 4000,
    binary_length: int | str = 8000,
    overrides: Mapping[type[T.DataType], str] | None = None,
) -> str:
    """Column list for CREATE TABLE: every column once, with its nullability.

    ``spark`` is Spark's own DDL and takes nested types.  ``ansi`` and ``tsql`` are for databases;
    a ``UrlDialect`` writes the words of the database behind a url.  Lengths are numbers or a word such
    as ``max``.  ``overrides`` replaces the type word of a Spark type.
    """
    if not schema.fields:
        raise SchemaError("a table needs at least one column")
    if isinstance(dialect, str) and dialect not in DIALECTS:
        raise SchemaError(f"unknown dialect {dialect!r}, one of {', '.join(DIALECTS)}")
    if dialect == "spark":
        for field in schema.fields:
            if isinstance(field.dataType, (T.AnsiIntervalType, T.CalendarIntervalType)):
                raise SchemaError(
                    f"column {field.name!r}: {field.dataType.simpleString()} cannot be stored"
                )
        return schema.toDDL()
    columns = []
    for field in schema.fields:
        word = type_word(
            field.name, field.dataType, dialect, string_length, binary_length, overrides
        )
        nullability = "" if field.nullable else " not null"
        columns.append(f"{quote_column(field.name, dialect)} {word}{nullability}")
    return ", ".join(columns)
