"""The database's own way to write types and names, as Spark knows it for a JDBC url."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stagehouse.errors import SchemaError

# Words of Spark's dialects that hold less than the Spark type, and ones that hold it.
_WIDER = {
    "mssqlserver": {"DATETIME": "DATETIME2"},
    "mysql": {
        "BLOB": "LONGBLOB",
        "DATETIME": "DATETIME(6)",
        "TIMESTAMP": "TIMESTAMP(6)",
    },
    "oracle": {"VARCHAR2(255)": "CLOB"},
    "teradata": {"VARCHAR(255)": "CLOB"},
}
_BINARY_NUMBERS = {T.FloatType: "BINARY_FLOAT", T.DoubleType: "BINARY_DOUBLE"}  # Oracle

_NUMBERS = re.compile(r"\((\d+)\s*(?:,\s*(\d+))?\)")


class UrlDialect:
    """Spark's dialect of a url: its type words first, then those Spark uses for every database.

    For a url without a dialect ``of`` gives the name of this package's own words instead.
    """

    def __init__(self, spark: SparkSession, jvm_dialect):
        self._spark = spark
        self._jvm_dialect = jvm_dialect
        name = jvm_dialect.getClass().getSimpleName().lower()
        self._name = name.removesuffix("$").removesuffix("dialect")

    @classmethod
    def of(cls, spark: SparkSession, url: str) -> "UrlDialect | str":
        found = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        unknown = found.getClass().getSimpleName().startswith("NoopDialect")
        return "ansi" if unknown else cls(spark, found)

    def quote(self, name: str) -> str:
        """The dialect's quotes; Spark leaves quotes inside a name as they are, so they are doubled."""
        quoted = self._jvm_dialect.quoteIdentifier("x")
        left, right = quoted[0], quoted[-1]
        return left + name.replace(right, 2 * right) + right

    def drop_column(self, table: str, column: str) -> str:
        return f"ALTER TABLE {table} DROP COLUMN {column}"

    def type_word(
        self,
        column: str,
        data_type: T.DataType,
        fallback: str | None,
        overrides: Mapping[type[T.DataType], str],
    ) -> str:
        """An error for a type the database cannot keep whole."""
        if type(data_type) in overrides:
            word = overrides[type(data_type)].format(
                n="", b="", p=getattr(data_type, "precision", ""), s=getattr(data_type, "scale", "")
            )
            return word
        asked = self._spark._jsparkSession.parseDataType(data_type.json())
        word = self._jvm_dialect.getJDBCType(asked)
        if word.isEmpty() and not isinstance(data_type, T.ByteType):  # "BYTE" is no common word
            utils = self._spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils
            word = utils.getCommonJDBCType(asked)
            if word.isEmpty():
                raise SchemaError(f"column {column!r}: {data_type.simpleString()} has no type word")
        elif word.isEmpty():
            return fallback
        text = word.get().databaseTypeDefinition()
        text = _WIDER.get(self._name, {}).get(text, text)
        if self._name == "oracle":
            text = _BINARY_NUMBERS.get(type(data_type), text)
        if isinstance(data_type, T.DecimalType):
            held = _NUMBERS.search(text)
            digits, scale = (int(held[1]), int(held[2] or 0)) if held else (38, 38)
            whole = data_type.precision - data_type.scale
            if held and (scale < data_type.scale or digits - scale < whole):
                raise SchemaError(
                    f"column {column!r}: {data_type.simpleString()} does not fit into the database's "
                    f"{text}; name a type word for decimals"
                )
        return text
