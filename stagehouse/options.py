"""Options by name, as a map of strings: the entry for callers that hold no warehouse object."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stagehouse.errors import OptionError
from stagehouse.operators.catalog import CatalogWarehouse
from stagehouse.operators.jdbc import JdbcWarehouse
from stagehouse.operators.layout import Distribution
from stagehouse.operators.warehouse import Warehouse

# Option names, lower case, and the field each one sets.
_FIELDS = {
    "url": "url",
    "stagingdir": "staging_dir",
    "externaldatasource": "location",
    "externalfileformat": "file_format",
    "dbtable": "table",
    "query": "query",
    "tableoptions": "distribution",
    "user": "user",
    "password": "password",
    "accesstoken": "access_token",
    "clientid": "client_id",
    "clientsecret": "client_secret",
    "authendpoint": "auth_endpoint",
    "root": "root",
    "dialect": "dialect",
    "partitioncolumn": "partition_column",
    "numpartitions": "num_partitions",
    "bulkload": "bulk_load",
    "bulkunload": "bulk_unload",
    "rename": "rename",
    "typewords": "type_words",
    "stringlength": "string_length",
    "binarylength": "binary_length",
    "stream": "stream",
    "batchid": "batch_id",
}


@dataclass(frozen=True)
class Options:
    """Options of one read or write, checked before any job."""

    url: str | None = None
    staging_dir: str | None = None
    location: str | None = None
    file_format: str | None = None
    table: str | None = None
    query: str | None = None
    distribution: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    access_token: str | None = field(default=None, repr=False)
    client_id: str | None = None
    client_secret: str | None = field(default=None, repr=False)
    auth_endpoint: str | None = None
    root: str | None = None
    dialect: str | None = None
    partition_column: str | None = None
    num_partitions: str | None = None
    bulk_load: str | None = None
    bulk_unload: str | None = None
    rename: str | None = None
    type_words: str | None = None
    string_length: str | None = None
    binary_length: str | None = None
    stream: str | None = None
    batch_id: str | None = None
    connection: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, options: Mapping[str, object]) -> "Options":
        """Names are matched without case or underscores.  What is not known here is an option of
        Spark's ``jdbc`` source, or an error when there is no database."""
        known, rest = {}, {}
        for name, value in options.items():
            target = _FIELDS.get(name.lower().replace("_", "")) or _ALIASES.get(name.lower())
            if target is None:
                rest[name] = str(value)
            elif target in known:
                raise OptionError(f"option {name!r} is given twice")
            elif value is not None:
                known[target] = str(value)
        return cls(**known, connection=rest)

    @property
    def is_jdbc(self) -> bool:
        return (self.url or "").lower().startswith("jdbc:")

    def _common_problems(self) -> list[str]:
        problems = []
        if self.url is not None and not self.is_jdbc and self.url.lower() != "catalog":
            problems.append(f"url must be 'catalog' or start with 'jdbc:', not {self.url!r}")
        if not (self.num_partitions or "1").isdigit() or self.num_partitions == "0":
            problems.append(f"numpartitions must be a positive number, not {self.num_partitions!r}")
        try:
            self.overrides()
        except OptionError as problem:
            problems.append(str(problem))
        if self.is_jdbc:
            problems += self._login_problems()
        else:
            for_a_database = [n for n in _DATABASE_ONLY if getattr(self, _FIELDS[n]) is not None]
            if for_a_database:
                problems.append(f"{', '.join(for_a_database)}: only a database takes these")
            if self.connection:
                problems.append(f"unknown option {', '.join(sorted(self.connection))}")
        return problems

    def overrides(self) -> dict[type[T.DataType], str]:
        """``typewords``: Spark types with the database's words, such as
        ``string = nvarchar(max); decimal = numeric({p},{s})``."""
        out = {}
        for pair in (self.type_words or "").split(";"):
            if pair.strip():
                name, found, word = pair.partition("=")
                kind = _TYPES.get(name.strip().lower())
                if kind is None or not word.strip():
                    raise OptionError(f"typewords: {pair.strip()!r} is not 'spark type = word'")
                out[kind] = word.strip()
        return out

    @property
    def batch(self) -> tuple[str, int] | None:
        return None if self.batch_id is None else (self.stream or "", int(self.batch_id))

    def _login_problems(self) -> list[str]:
        """Client id comes first, then user, then token; each group must be whole."""
        client = (self.client_id, self.client_secret, self.auth_endpoint)
        if self.client_id is not None:
            if None in client:
                return ["clientid, clientsecret and authendpoint must be specified together"]
            return ["a client id is not exchanged for a token here; pass the token as accesstoken"]
        if self.user is not None or self.password is not None:
            if self.user is None or self.password is None:
                return ["user and password must be specified together"]
            return []
        return [] if self.access_token is not None else ["authentication must be specified"]

    def check_read(self) -> "Options":
        problems = self._common_problems()
        if self.staging_dir is None and self.location is None:
            problems.append("stagingdir or externaldatasource must be specified")
        if self.staging_dir is not None and self.location is not None:
            problems.append("give one of stagingdir and externaldatasource, not both")
        if self.table is None and self.query is None:
            problems.append("dbtable or query must be specified")
        if self.table is not None and self.query is not None:
            problems.append("give one of dbtable and query, not both")
        return self._or_raise(problems)

    def check_write(self) -> "Options":
        problems = self._common_problems()
        if self.location is not None:
            problems.append("externaldatasource is not supported in write")
        if self.staging_dir is None:
            problems.append("stagingdir must be specified for write")
        if self.table is None:
            problems.append("dbtable must be specified for write")
        if self.query is not None:
            problems.append("query is not supported in write")
        if not self.is_jdbc and self.root is None:
            problems.append("root, the folder of the tables, must be specified for write")
        if self.batch_id is not None and not self.batch_id.isdigit():
            problems.append(f"batchid must be a number from 0, not {self.batch_id!r}")
        if self.stream is not None and self.batch_id is None:
            problems.append("stream comes with batchid")
        return self._or_raise(problems)

    def _or_raise(self, problems: list[str]) -> "Options":
        if problems:
            raise OptionError("; ".join(problems))
        return self


# The spelling of keyword arguments, for names whose field is not the option name itself.
_ALIASES = {
    "table": "table",
    "location": "location",
    "file_format": "file_format",
    "distribution": "distribution",
}

# Options that only a database takes.
_DATABASE_ONLY = (
    "bulkload",
    "bulkunload",
    "rename",
    "typewords",
    "stringlength",
    "binarylength",
    "dialect",
)
# Spark's type names.
_TYPES = {
    "bigint": T.LongType,
    "int": T.IntegerType,
    "smallint": T.ShortType,
    "tinyint": T.ByteType,
    "boolean": T.BooleanType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "decimal": T.DecimalType,
    "string": T.StringType,
    "binary": T.BinaryType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
    "timestamp_ntz": T.TimestampNTZType,
}


def _statements(text: str | None) -> list[str] | None:
    """The statements of an option, between semicolons that end a line or the text."""
    if text is None:
        return None
    return [s.strip().removesuffix(";").strip() for s in re.split(r";[ \t]*(?:\n|$)", text) if s.strip()]


def open_warehouse(
    spark: SparkSession,
    options: Options,
    locations: Mapping[str, str] | None = None,
    formats: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
) -> Warehouse:
    """The backend the url asks for: a database for ``jdbc:``, else the Spark catalog."""
    staging = options.staging_dir or (locations or {}).get(options.location or "")
    if staging is None:
        raise OptionError(f"unknown location {options.location!r}")
    if options.is_jdbc:
        column = options.partition_column
        return JdbcWarehouse(
            spark,
            options.url,
            staging,
            user=options.user,
            password=options.password,
            access_token=options.access_token,
            locations=locations,
            formats=formats,
            dialect=options.dialect,
            type_overrides=options.overrides(),
            rename=options.rename,
            bulk_load=_statements(options.bulk_load),
            bulk_unload=_statements(options.bulk_unload),
            string_length=options.string_length or 4000,
            binary_length=options.binary_length or 8000,
            partition_columns=[c.strip() for c in column.split(",")] if column else (),
            num_partitions=int(options.num_partitions or 8),
            connection=options.connection,
        )
    return CatalogWarehouse(spark, options.root or staging, staging, locations, formats)


def read(
    spark: SparkSession,
    options: Mapping[str, object],
    schema: T.StructType | None = None,
    locations: Mapping[str, str] | None = None,
    formats: Mapping[str, tuple[str, Mapping[str, str]]] | None = None,
) -> DataFrame:
    """``Warehouse.read`` by options: ``url``, ``dbtable`` or ``query``, ``stagingdir`` or
    ``externaldatasource``, ``externalfileformat``."""
    chosen = Options.of(options).check_read()
    warehouse = open_warehouse(spark, chosen, locations, formats)
    return warehouse.read(
        table=chosen.table,
        query=chosen.query,
        location=chosen.location,
        file_format=chosen.file_format,
        schema=schema,
    )


def write(df: DataFrame, options: Mapping[str, object], mode: str = "errorifexists") -> DataFrame:
    """``Warehouse.write`` by options: ``url``, ``dbtable``, ``stagingdir``, ``tableoptions``; the
    last is for a table the write creates, so an append may carry it along unused.  ``batchid``, with a
    ``stream`` name, makes an append from ``foreachBatch`` count once however often it is tried."""
    chosen = Options.of(options).check_write()
    warehouse = open_warehouse(df.sparkSession, chosen)
    layout = None
    if chosen.distribution is not None and mode.lower() != "append":
        layout = Distribution.parse(chosen.distribution)
    return warehouse.write(df, chosen.table, mode, layout, batch=chosen.batch)
