"""Bulk loads of files that somebody else wrote: nothing lost, nothing moved."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from stagehouse import CatalogWarehouse, LoadError, OptionError, SchemaError
from stagehouse.operators.layout import Distribution, split_list

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def house(spark, tmp_path):
    return CatalogWarehouse(
        spark,
        str(tmp_path / "tables"),
        str(tmp_path / "staging"),
        formats={
            "headed": ("csv", {"header": "true"}),
            "bare": ("csv", {}),
            "lines": ("json", {}),
            "orc": ("orc", {}),
            "lenient": ("json", {"mode": "DROPMALFORMED"}),
        },
    )


def files(tmp_path, *texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"f{i}").write_text(text)
    return str(folder)


def content(house, table):
    return sorted(map(tuple, house.table(table).collect()), key=str)


def test_header_decides_by_name(house, tmp_path, table):
    house.create_table(table, AB)
    assert house.copy_into(table, files(tmp_path, "b,a\nx,1\ny,2\n"), "headed") == 2
    assert content(house, table) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize(
    ("kind", "texts"),
    [
        ("headed", ["a,b\n1,x,z\n"]),
        ("headed", ["a,b\nno,x\n"]),
        ("lines", ['{"a": 1, "b": "x"}\n{"a": broken\n']),
        ("lines", ['{"a": "no", "b": "x"}\n']),
    ],
)
def test_bad_records_fail_the_load(house, tmp_path, table, kind, texts):
    house.create_table(table, AB)
    with pytest.raises(LoadError):
        house.copy_into(table, files(tmp_path, *texts), kind)
    assert content(house, table) == []


def test_names_are_checked(house, tmp_path, table):
    house.create_table(table, AB)
    path = files(tmp_path, '{"a": 1}\n', '{"a": 2, "c": 3}\n')
    with pytest.raises(SchemaError):
        house.copy_into(table, path, "lines")
    with pytest.raises(OptionError):
        house.copy_into(table, path, "bare")


def test_a_mode_of_the_format_stays(house, tmp_path, table):
    house.create_table(table, AB)
    path = files(tmp_path, '{"a": 1, "b": "x"}\n{"a": "no", "b": "y"}\n')
    assert house.copy_into(table, path, "lenient") == 1


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_columns_of_later_files_arrive(spark, house, tmp_path, table, kind):
    house.create_table(table, AB)
    path = str(tmp_path / "mixed")
    spark.range(3).selectExpr("cast(id AS int) AS a").write.format(kind).save(path)
    spark.range(2).selectExpr("cast(id AS int) AS a", "'x' AS b").write.format(kind).mode(
        "append"
    ).save(path)
    assert house.copy_into(table, path, kind) == 5
    assert sum(b == "x" for _, b in content(house, table)) == 2


def test_layout_text_with_brackets():
    text = "PARTITION (d RANGE RIGHT FOR VALUES (1, 2)), DISTRIBUTION = HASH([a,b], c)"
    layout = Distribution.parse(text)
    assert layout.columns == ("a,b", "c")
    assert layout.other == ("PARTITION (d RANGE RIGHT FOR VALUES (1, 2))",)
    assert split_list("a, 'b,(c', [d,e]") == ["a", "'b,(c'", "[d,e]"]
    for broken in ("HASH(a", "HASH(a))", "HASH([a)", "HEAP, 'x"):
        with pytest.raises(OptionError):
            Distribution.parse(broken)


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_every_file_has_its_own_header(house, tmp_path, table, ansi):
    house.create_table(table, AB)
    path = files(tmp_path, "a,b\n1,x\n", "b,a\ny,2\n", "A\n3\n", "")
    assert house.copy_into(table, path, "headed") == 3
    assert content(house, table) == [(1, "x"), (2, "y"), (3, None)]
    (tmp_path / "other").mkdir()
    other = files(tmp_path / "other", "a,b\n1,x\n", "a,c\n1,x\n")
    with pytest.raises(SchemaError, match="has no column c"):
        house.copy_into(table, other, "headed")


@pytest.mark.parametrize("value", ["12x", "1.5", "99999999999"])
def test_bad_numbers_fail_whatever_the_session_says(house, tmp_path, table, ansi, value):
    house.create_table(table, AB)
    with pytest.raises(LoadError):
        house.copy_into(table, files(tmp_path, f"a,b\n{value},x\n"), "headed")
    assert content(house, table) == []


def test_the_formats_own_options_act_by_name(spark, tmp_path, table, ansi):
    options = {"header": "true", "dateFormat": "dd/MM/yyyy", "sep": ";", "nullValue": "-"}
    house = CatalogWarehouse(
        spark, str(tmp_path / "t"), str(tmp_path / "s"), formats={"own": ("csv", options)}
    )
    house.create_table(table, T.StructType.fromDDL("d DATE, n INT, m DECIMAL(6,2)"))
    house.copy_into(table, files(tmp_path, "n;d;m\n1;29/02/2024;1.25\n-;-;-\n"), "own")
    found = [tuple(map(str, r)) for r in content(house, table)]
    assert sorted(found) == [("2024-02-29", "1", "1.25"), ("None", "None", "None")]


def test_a_zone_is_not_cut_from_a_local_time(house, tmp_path, table, ansi):
    house.create_table(table, T.StructType.fromDDL("t TIMESTAMP_NTZ"))
    with pytest.raises(LoadError):
        house.copy_into(table, files(tmp_path, "t\n2024-01-01T10:00:00+05:00\n"), "headed")


def test_packed_files_and_odd_names(house, tmp_path, table):
    import gzip

    house.create_table(table, AB)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a b%20.csv.gz").write_bytes(gzip.compress(b"b,a\nx,1\n"))
    assert house.copy_into(table, str(folder), "headed") == 1
    assert content(house, table) == [(1, "x")]


def test_nested_json_names_are_checked(house, tmp_path, table):
    target = "s STRUCT<k: INT, l: ARRAY<STRUCT<q: INT>>>, m MAP<STRING, STRUCT<v: INT>>"
    house.create_table(table, T.StructType.fromDDL(target))
    good = '{"s": {"k": 1, "l": [{"q": 2}]}, "m": {"any": {"v": 3}}}\n'
    assert house.copy_into(table, files(tmp_path, good), "lines") == 1
    for i, bad in enumerate(
        ['{"s": {"k": 1, "z": 2}}', '{"s": {"l": [{"p": 1}]}}', '{"m": {"any": {"w": 3}}}']
    ):
        (tmp_path / str(i)).mkdir()
        with pytest.raises(SchemaError, match="has no column"):
            house.copy_into(table, files(tmp_path / str(i), bad), "lines")
    assert len(content(house, table)) == 1
