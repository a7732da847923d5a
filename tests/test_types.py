import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import OptionError, SchemaError, conform, ddl_for
from stagehouse.functions import quote_name, split_name, widens
from stagehouse.functions.names import is_name

WORDS = [
    (T.LongType(), "bigint", "bigint"),
    (T.IntegerType(), "int", "int"),
    (T.ShortType(), "smallint", "smallint"),
    (T.ByteType(), "smallint", "smallint"),
    (T.BinaryType(), "varbinary(8000)", "varbinary(8000)"),
    (T.BooleanType(), "boolean", "bit"),
    (T.StringType(), "varchar(4000)", "nvarchar(4000)"),
    (T.TimestampType(), "timestamp", "datetime2"),
    (T.TimestampNTZType(), "timestamp", "datetime2"),
    (T.DateType(), "date", "date"),
    (T.DecimalType(10, 2), "decimal(10,2)", "decimal(10,2)"),
    (T.DecimalType(38, 18), "decimal(38,18)", "decimal(38,18)"),
    (T.DoubleType(), "double", "float"),
    (T.FloatType(), "real", "real"),
]


@pytest.mark.parametrize("data_type, ansi, tsql", WORDS)
def test_type_words(data_type, ansi, tsql):
    schema = T.StructType([T.StructField("c", data_type)])
    assert ddl_for(schema, "ansi") == f'"c" {ansi}'
    assert ddl_for(schema, "tsql") == f"[c] {tsql}"


@pytest.mark.parametrize("count", [1, 2, 11])
def test_every_column_once(count):
    schema = T.StructType([T.StructField(f"c{i}", T.LongType(), i % 2 == 0) for i in range(count)])
    for dialect in ("spark", "ansi", "tsql"):
        parts = ddl_for(schema, dialect).split(",")
        assert len(parts) == count
        for i, part in enumerate(parts):
            assert f"c{i}" in part and part.strip()
            assert ("not null" in part.lower()) == (i % 2 == 1)


def test_no_column_is_an_error():
    with pytest.raises(SchemaError):
        ddl_for(T.StructType([]))


def test_nested_only_in_spark_dialect():
    schema = T.StructType.fromDDL("a ARRAY<INT>, m MAP<STRING, INT>, s STRUCT<k: INT>")
    assert "ARRAY<INT>" in ddl_for(schema)
    with pytest.raises(SchemaError, match="'a': array<int>"):
        ddl_for(schema, "ansi")


def test_interval_is_an_error_everywhere():
    schema = T.StructType.fromDDL("i INTERVAL DAY TO SECOND")
    for dialect in ("spark", "ansi"):
        with pytest.raises(SchemaError, match="'i'"):
            ddl_for(schema, dialect)


def test_lengths_overrides_and_quoting():
    schema = T.StructType.fromDDL("s STRING, b BINARY")
    assert ddl_for(schema, "ansi", string_length=10, overrides={T.BinaryType: "blob"}) == (
        '"s" varchar(10), "b" blob'
    )
    odd = T.StructType([T.StructField('a"]b', T.LongType())])
    assert ddl_for(odd, "ansi") == '"a""]b" bigint'
    assert ddl_for(odd, "tsql") == '[a"]]b] bigint'


@pytest.mark.parametrize(
    "source, target, ok",
    [
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("tinyint", "smallint", True),
        ("int", "double", True),
        ("bigint", "double", False),
        ("smallint", "float", True),
        ("int", "float", False),
        ("float", "double", True),
        ("double", "float", False),
        ("int", "decimal(10,0)", True),
        ("int", "decimal(10,2)", False),
        ("bigint", "decimal(20,0)", True),
        ("decimal(10,2)", "decimal(12,2)", True),
        ("decimal(10,2)", "decimal(12,4)", True),
        ("decimal(10,2)", "decimal(10,3)", False),
        ("decimal(10,2)", "double", False),
        ("date", "timestamp", True),
        ("date", "timestamp_ntz", True),
        ("timestamp", "date", False),
        ("int", "string", True),
        ("string", "int", False),
        ("binary", "string", False),
        ("array<int>", "array<bigint>", True),
        ("array<bigint>", "array<int>", False),
        ("struct<a:int>", "struct<a:bigint>", True),
        ("struct<a:int>", "struct<b:int>", False),
        ("map<string,int>", "map<string,bigint>", True),
    ],
)
def test_widening(source, target, ok):
    parse = T.StructType.fromDDL
    assert widens(parse(f"c {source}")["c"].dataType, parse(f"c {target}")["c"].dataType) is ok


def test_conform_reorders_subsets_and_widens(spark):
    df = spark.range(3).select(
        F.col("id").cast("int").alias("A"), F.lit("x").alias("b"), F.lit(1.0).alias("c")
    )
    out = conform(df, T.StructType.fromDDL("b STRING, a BIGINT"))
    assert out.dtypes == [("b", "string"), ("a", "bigint")]
    assert [r["a"] for r in out.collect()] == [0, 1, 2]
    with pytest.raises(SchemaError, match="'z' is missing; column 'c'"):
        conform(df, T.StructType.fromDDL("z INT, c FLOAT"))


def test_names():
    assert split_name("a.b.c") == ["a", "b", "c"]
    assert split_name("db.`odd.na``me`") == ["db", "odd.na`me"]
    assert quote_name("db.`odd.na``me`") == "`db`.`odd.na``me`"
    for bad in ("", "a..b", "a.", "select 1", "`x", "a;drop table b c"):
        with pytest.raises(OptionError):
            split_name(bad)
    assert is_name("db.t") and not is_name("SELECT * FROM t")
