"""Properties over generated inputs: names, layouts, and slices that must cover every row once."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from stagehouse import Distribution
from stagehouse.functions import quote_name, split_name
from stagehouse.functions.names import quote_part
from stagehouse.sources.jdbc_extract import KeyColumn, KeySlices

hypothesis = pytest.importorskip("hypothesis")
duckdb = pytest.importorskip("duckdb")
given, st = hypothesis.given, hypothesis.strategies
few = hypothesis.settings(max_examples=60, deadline=None)


@few
@given(st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=3))
def test_any_name_survives_quoting(parts):
    name = ".".join(quote_part(p) for p in parts)
    assert split_name(name) == parts and quote_name(name) == name


@few
@given(
    st.lists(st.from_regex(r"[A-Za-z_][A-Za-z0-9_ ]{0,5}", fullmatch=True).map(str.strip), min_size=1, max_size=3),
    st.sampled_from(["{}", "[{}]", '"{}"', "`{}`"]),
    st.sampled_from(["HASH(%s)", "hash (%s)", "HEAP, DISTRIBUTION = HASH(%s)"]),
)
def test_any_column_list_is_parsed(columns, quote, form):
    text = form % ", ".join(quote.format(c) for c in columns)
    assert Distribution.parse(text).columns == tuple(columns)


class DuckSlices(KeySlices):
    """The same slices, asked of an in-process engine; date escapes spelled its way."""

    def __init__(self, connection, columns):
        super().__init__(None, {}, "t", columns)
        self.connection = connection

    def _ask(self, select):
        return self.connection.execute(spell(select)).fetchall()


def spell(sql):
    plain = sql.replace("{d ", "DATE ").replace("{ts ", "TIMESTAMP ").replace("{fn ", "")
    return plain.replace("}", "")


keys = st.one_of(
    st.integers(-(10**12), 10**12), st.integers(0, 20), st.just(7), st.none()
)


@few
@given(st.lists(st.tuples(keys, keys), max_size=200), st.integers(1, 12))
def test_integer_slices_cover_every_row_once(rows, count):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (k BIGINT, j BIGINT)")
    if rows:
        connection.executemany("INSERT INTO t VALUES (?, ?)", rows)
    columns = tuple(KeyColumn(f'"{n}"', T.LongType()) for n in "kj")
    check(connection, columns, rows, count)


@few
@given(
    st.lists(
        st.tuples(
            st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)),
            st.dates(dt.date(1900, 1, 1), dt.date(2100, 1, 1)),
            st.decimals(-9999, 9999, places=2),
        ),
        max_size=80,
    ),
    st.integers(1, 6),
    st.permutations(range(3)),
)
def test_other_key_types_cover_every_row_once(rows, count, order):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (a TIMESTAMP, b DATE, c DECIMAL(8,2))")
    if rows:
        connection.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    kinds = [("a", T.TimestampNTZType()), ("b", T.DateType()), ("c", T.DecimalType(8, 2))]
    columns = tuple(KeyColumn(f'"{kinds[i][0]}"', kinds[i][1]) for i in order)
    check(connection, columns, rows, count)


def check(connection, columns, rows, count):
    slices = DuckSlices(connection, columns).predicates(count)
    sizes = [
        connection.execute(f"SELECT count(*) FROM t WHERE {spell(p)}").fetchone()[0] for p in slices
    ]
    either = " OR ".join(f"({spell(p)})" for p in slices)
    covered = connection.execute(f"SELECT count(*) FROM t WHERE {either}").fetchone()[0]
    assert sum(sizes) == covered == len(rows)
    names = ", ".join(c.name for c in columns)
    same = connection.execute(
        f"SELECT coalesce(max(n), 0) FROM (SELECT count(*) n FROM t GROUP BY {names})"
    ).fetchone()[0]
    target = -(-len(rows) // count)
    assert len(slices) <= count and max(sizes) <= target + max(target, same)


@pytest.mark.parametrize(
    "kind, value, text",
    [
        (T.LongType(), -5, "-5"),
        (T.DecimalType(20, 3), Decimal("-1.250"), "-1.250"),
        (T.DecimalType(38, 3), Decimal("12345678901234567890123456789012345.678"),
         "12345678901234567890123456789012345.678"),
        (T.DateType(), dt.date(1969, 12, 31), "{d '1969-12-31'}"),
        (T.TimestampNTZType(), dt.datetime(2024, 2, 29, 1, 2, 3), "{ts '2024-02-29 01:02:03.000000'}"),
    ],
)
def test_key_literals(kind, value, text):
    key = KeyColumn("k", kind)
    assert key.literal(key.number(value)) == text
