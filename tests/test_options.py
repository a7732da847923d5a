import pytest

import stagehouse
from stagehouse import OptionError, Options, StagedTransferError

# The option matrix: url, staging directory, named location.

_JDBC = {"url": "jdbc:x:y", "user": "u", "password": "p"}
_S = {"stagingdir": "/s"}
_L = {"externaldatasource": "lake"}

CASES_READ = [
    ({**_JDBC, **_S}, None),
    ({**_JDBC, **_L}, None),
    ({**_JDBC}, "stagingdir or externaldatasource must be specified"),
    ({**_S}, None),
    ({**_JDBC, **_S, **_L}, "not both"),
    ({**_L}, None),
    ({**_S, **_L}, "not both"),
    ({}, "stagingdir or externaldatasource must be specified"),
    ({"url": "catalog", **_S}, None),
    ({"url": "ftp://x", **_S}, "url must be"),
]

CASES_WRITE = [
    ({**_JDBC, **_S}, None),
    ({**_JDBC, **_S, **_L}, "externaldatasource is not supported in write"),
    ({**_L}, "externaldatasource is not supported in write"),
    ({**_JDBC}, "stagingdir must be specified for write"),
    ({**_S}, None),
    ({}, "stagingdir must be specified for write"),
    ({**_S, "query": "select 1"}, "query is not supported in write"),
]


@pytest.mark.parametrize("given, problem", CASES_READ)
def test_read_matrix(given, problem):
    options = Options.of({"dbtable": "t", **given})
    if problem is None:
        assert options.check_read() is options
    else:
        with pytest.raises(OptionError, match=problem):
            options.check_read()


@pytest.mark.parametrize("given, problem", CASES_WRITE)
def test_write_matrix(given, problem):
    options = Options.of({"dbtable": "t", "root": "/r", **given})
    if problem is None:
        assert options.check_write() is options
    else:
        with pytest.raises(OptionError, match=problem):
            options.check_write()


@pytest.mark.parametrize(
    "given, problem",
    [
        ({"dbtable": "t"}, None),
        ({"query": "select 1"}, None),
        ({"dbtable": "t", "query": "select 1"}, "not both"),
        ({}, "dbtable or query must be specified"),
    ],
)
def test_source_choice(given, problem):
    options = Options.of({"stagingdir": "/s", **given})
    if problem is None:
        options.check_read()
    else:
        with pytest.raises(OptionError, match=problem):
            options.check_read()


def test_all_problems_are_reported_at_once():
    with pytest.raises(OptionError) as error:
        Options.of({"url": "odd:x"}).check_write()
    for part in ("url", "stagingdir", "dbtable", "root"):
        assert part in str(error.value)


def test_names_ignore_case_and_keyword_spelling():
    upper = Options.of({"URL": "catalog", "StagingDir": "/s", "DbTable": "t"})
    lower = Options.of({"url": "catalog", "staging_dir": "/s", "table": "t"})
    assert upper == lower
    with pytest.raises(OptionError, match="twice"):
        Options.of({"dbtable": "t", "table": "u"})


LOGIN = {"url": "jdbc:x:y", "stagingdir": "/s", "dbtable": "t"}


@pytest.mark.parametrize(
    "given, problem",
    [
        ({"user": "u", "password": "p"}, None),
        ({"accesstoken": "a"}, None),
        ({"user": "u"}, "user and password must be specified together"),
        ({"password": "p"}, "user and password must be specified together"),
        ({}, "authentication must be specified"),
        ({"clientid": "c", "user": "u", "password": "p"}, "specified together"),
        ({"clientid": "c", "clientsecret": "s", "authendpoint": "e"}, "accesstoken"),
        ({"user": "u", "accesstoken": "a"}, "user and password"),
    ],
)
def test_login_groups(given, problem):
    options = Options.of({**LOGIN, **given})
    if problem is None:
        options.check_read()
    else:
        with pytest.raises(OptionError, match=problem):
            options.check_read()


def test_number_of_partitions():
    for bad in ("0", "many", "-1"):
        with pytest.raises(OptionError, match="numpartitions"):
            Options.of({**LOGIN, "accesstoken": "a", "numPartitions": bad}).check_read()


def test_secrets_are_not_printed():
    text = repr(Options.of({**LOGIN, "user": "u", "password": "hidden", "accesstoken": "secret"}))
    assert "hidden" not in text and "secret" not in text


def test_unknown_options_only_go_to_a_database():
    assert Options.of({**LOGIN, "fetchsize": 100}).connection == {"fetchsize": "100"}
    with pytest.raises(OptionError, match="fetchsize"):
        Options.of({"stagingdir": "/s", "dbtable": "t", "fetchsize": 100}).check_read()


def test_read_and_write_by_options(spark, orders, table, tmp_path):
    options = {
        "url": "catalog",
        "dbtable": table,
        "stagingdir": str(tmp_path / "s"),
        "root": str(tmp_path / "r"),
        "tableoptions": "HEAP, DISTRIBUTION = HASH([o_custkey])",
    }
    stagehouse.write(orders, options)
    back = stagehouse.read(spark, {"dbtable": table, "stagingdir": str(tmp_path / "s")})
    assert back.count() == orders.count()
    stagehouse.write(orders.limit(10), options, "append")
    counted = stagehouse.read(
        spark,
        {"query": f"SELECT count(*) AS n FROM {table}", "externaldatasource": "lake"},
        locations={"lake": str(tmp_path / "lake")},
    )
    assert counted.first()["n"] == orders.count() + 10
    assert (tmp_path / "lake").exists()
    with pytest.raises(OptionError, match="unknown location"):
        stagehouse.read(spark, {"dbtable": table, "externaldatasource": "nowhere"})


def test_one_error_class_with_cause():
    cause = RuntimeError("why")
    error = StagedTransferError("what", cause)
    assert (error.message, error.cause, error.__cause__) == ("what", cause, cause)
    assert StagedTransferError("what").cause is None
    assert issubclass(OptionError, StagedTransferError) and issubclass(OptionError, ValueError)
