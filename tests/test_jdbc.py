import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from support import SF, same_rows

from stagehouse import Distribution, JdbcWarehouse, LoadError, OptionError, SchemaError
from stagehouse.operators import jdbc as jdbc_module
from stagehouse.sources.jdbc_extract import KeyColumn, KeySlices

BLOB = {T.BinaryType: "blob"}


@pytest.fixture(scope="module")
def url():
    return f"jdbc:derby:memory:test_{uuid.uuid4().hex};create=true"


@pytest.fixture
def database(spark, url, tmp_path):
    return JdbcWarehouse(
        spark,
        url,
        str(tmp_path / "staging"),
        user="app",
        password="app",
        type_overrides=BLOB,
        num_partitions=4,
    )


def tables_left(database):
    listed = "(SELECT tablename FROM sys.systables WHERE tabletype = 'T') t"
    reader = database.spark.read.format("jdbc").options(**database.options, dbtable=listed)
    return {r[0] for r in reader.load().collect()}


def test_round_trip_in_slices(database, orders, table):
    out = database.write(orders, table)
    assert same_rows(out, orders)
    back = database.read(table=table, partition_columns=["o_orderkey"])
    assert back.dtypes == orders.dtypes and same_rows(back, orders)
    live = database.source(table=table, partition_columns=["o_orderkey"])
    assert live.rdd.getNumPartitions() >= 4
    assert not [t for t in tables_left(database) if t.startswith("LANDING")]


def test_query_and_pushdown(database, orders, table):
    database.type_overrides[T.StringType] = "varchar(20)"  # Derby compares no long text
    database.write(orders, table)
    query = f'SELECT "o_orderkey", "o_custkey" FROM {table} WHERE "o_orderstatus" = \'F\''
    back = database.read(query=query, partition_columns=["o_orderkey"])
    assert same_rows(back, orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"))
    plan = database.table(table).where("o_custkey = 7")._jdf.queryExecution().toString()
    assert "EqualTo(o_custkey,7)" in plan


@pytest.mark.parametrize("key", ["o_orderdate", "day", "price", "o_custkey"])
def test_key_types(database, orders, table, key):
    rows = orders.withColumn("day", F.col("o_orderdate").cast("date")).withColumn(
        "price", (F.col("o_totalprice") - 200000).cast("decimal(12,2)")
    )
    database.write(rows, table)
    live = database.source(table=table, partition_columns=[key])
    assert 4 <= live.rdd.getNumPartitions() <= 8 and same_rows(live, rows)
    sizes = [len(p) for p in live.select(key).rdd.glom().collect()]
    assert max(sizes) <= 1.1 * orders.count() / 4
    with pytest.raises(OptionError, match="partition column o_totalprice is double"):
        database.source(table=table, partition_columns=["o_totalprice"])


def test_skewed_key_is_cut_by_rows_then_by_the_next_key(spark, database, table):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1500, 77).when(F.col("id") < 1600, None)
        .otherwise(F.col("id") * F.col("id")).cast("bigint").alias("k"),
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"),
    )
    database.write(rows, table)
    k, i = (KeyColumn(f'"{n}"', T.LongType()) for n in ("k", "id"))
    slices = KeySlices(spark, database.options, table, (k, i)).predicates(10)
    login = {"user": "app", "password": "app"}
    counts = [
        spark.read.jdbc(database.url, table, predicates=[p], properties=login).count()
        for p in slices
    ]
    assert sum(counts) == 3000 and max(counts) <= 500 and len(slices) >= 9
    out = database.source(table=table, partition_columns=["k", "id"], num_partitions=10)
    assert same_rows(out, rows)
    alone = KeySlices(spark, database.options, table, (k,)).predicates(10)
    assert len(alone) >= 5
    nulls = rows.select(F.lit(None).cast("bigint").alias("k"))
    database.write(nulls, f"{table}_n")
    assert database.read(table=f"{table}_n", partition_columns=["k"]).count() == 3000


def test_modes(database, orders, customer, table):
    with pytest.raises(OptionError, match="does not exist"):
        database.write(orders, table, mode="append")
    database.write(orders, table)
    with pytest.raises(OptionError, match="exists already"):
        database.write(orders, table)
    assert same_rows(database.write(customer, table, mode="ignore"), orders)
    assert database.write(orders, table, mode="append").count() == 2 * orders.count()
    assert same_rows(database.write(customer, table, mode="overwrite"), customer)
    own = database.table(table).where("c_nationkey = 1")
    expected = customer.where("c_nationkey = 1")
    assert same_rows(database.write(own, table, mode="overwrite"), expected)
    database.drop_table(table)
    database.drop_table(table)
    assert not database.exists(table)


def test_landing_table_is_renamed(database, orders, customer, table, monkeypatch):
    database.rename = "RENAME TABLE {old} TO {new}"
    ran, run_batch = [], database.run_batch

    def watched(statements):
        ran.extend(statements)
        run_batch(statements)

    monkeypatch.setattr(database, "run_batch", watched)
    assert same_rows(database.write(orders, f"app.{table}"), orders)
    assert same_rows(database.write(customer, table, mode="overwrite"), customer)
    assert same_rows(database.write(customer, table, mode="append"), customer.unionAll(customer))
    assert sum(s.startswith("RENAME") for s in ran) == 2
    assert sum(s.startswith("INSERT") for s in ran) == 1
    database.rename = "NO {old} {new}"
    with pytest.raises(LoadError):
        database.write(orders, table, mode="overwrite")
    assert database.table(table).columns == customer.columns
    assert not [t for t in tables_left(database) if t.startswith("LANDING")]


def test_failed_batch_keeps_the_old_table(database, orders, customer, table, monkeypatch):
    database.write(orders, table)
    monkeypatch.setattr(database, "_move_text", lambda *a: "INSERT INTO nosuch SELECT 1 FROM nosuch")
    with pytest.raises(LoadError, match="batch undone"):
        database.write(customer, table, mode="overwrite")
    assert same_rows(database.table(table), orders)
    assert not [t for t in tables_left(database) if t.startswith("LANDING")]
    assert len(database.area) == 0


def test_only_wrong_slices_are_loaded_again(spark, database, orders, table, monkeypatch, tmp_path):
    """The first load doubles one slice and loses half of another one."""
    path = str(tmp_path / "many")
    orders.repartition(6).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    write, loads, hit = database._write_slices, [], []

    def faulty(sliced, ledger, only, landing):
        loads.append(only)
        write(sliced, ledger, only, landing)
        if only is None:
            hit[:] = sorted(r[0] for r in sliced.select(ledger).distinct().collect())[1:3]
            write(sliced, ledger, hit[:1], landing)
            some = f'"{ledger}" = {hit[1]} AND mod("o_orderkey", 2) = 0'
            database.run_batch([f"DELETE FROM {landing} WHERE {some}"])

    monkeypatch.setattr(database, "_write_slices", faulty)
    try:
        assert same_rows(database.write(spark.read.parquet(path), table), orders)
        assert len(hit) == 2 and loads == [None, hit]
        database.rename = "RENAME TABLE {old} TO {new}"
        assert same_rows(database.write(spark.read.parquet(path), table, mode="overwrite"), orders)
        assert database.table(table).columns == orders.columns
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_slices_that_stay_wrong_are_an_error(database, orders, table, monkeypatch):
    database.write(orders, table)
    monkeypatch.setattr(database, "_slice_counts", lambda landing, column: {0: -1})
    with pytest.raises(LoadError, match="slices stay wrong"):
        database.write(orders, table, mode="append")
    assert same_rows(database.table(table), orders)
    assert not [t for t in tables_left(database) if t.startswith("LANDING")]


def test_bulk_load_is_counted_in_its_transaction(database, orders, table):
    """``INSERT ... SELECT`` stands for a load of the database's own; one loses a row."""
    database.write(orders, table)
    database.bulk_load = f"INSERT INTO {{table}} SELECT * FROM {table}"
    n = orders.count()
    assert database.write(orders, table, mode="append").count() == 2 * n
    with pytest.raises(LoadError, match=f"got {2 * n} rows, not {n}"):
        database.write(orders, table, mode="append")
    assert database.table(table).count() == 2 * n
    with pytest.raises(LoadError, match="got 0 rows"):  # dropped, made again and not filled
        database.write(orders, table, mode="overwrite")
    assert database.table(table).count() == 2 * n


def test_not_null(spark, database, table):
    schema = T.StructType.fromDDL("a BIGINT NOT NULL, b STRING")
    database.create_table(table, schema)
    database.create_table(table, schema)
    assert database.schema_of(table=table).json() == schema.json()
    bad = spark.createDataFrame([(None, "x")], "a BIGINT, b STRING")
    with pytest.raises(LoadError) as error:
        database.write(bad, table, mode="append")
    assert "null in column a" in str(error.value.cause)
    with pytest.raises(SchemaError, match="lacks NOT NULL"):
        database.write(bad.select("b"), table, mode="append")


def test_copy_into(database, orders, table):
    database.create_table(table, orders.schema)
    staged = database.unload(orders.select(*reversed(orders.columns)))
    assert database.copy_into(table, staged.path) == orders.count()
    assert same_rows(database.table(table), orders)
    with pytest.raises(OptionError, match="does not exist"):
        database.copy_into(f"{table}_x", staged.path)


def test_spark_types_through_the_database(spark, database, table):
    rows = spark.sql(
        "SELECT true AS a, 1Y AS b, 2S AS c, 3 AS d, 4L AS e, CAST(1.5 AS FLOAT) AS f, 2.5D AS g, "
        "CAST(12.34 AS DECIMAL(10,2)) AS h, 'x' AS i, X'00FF' AS j, DATE'2024-02-29' AS k, "
        "TIMESTAMP_NTZ'2024-02-29 12:34:56.123456' AS l"
    )
    out = database.read(table=database.write(rows, table) and table)
    assert dict(out.dtypes) == {**dict(rows.dtypes), "b": "int", "c": "int"}
    assert out.first().asDict() == rows.first().asDict()


WORDS = [
    ("char(3)", "string"),
    ("varchar(5)", "string"),
    ("long varchar", "string"),
    ("clob", "string"),
    ("blob", "binary"),
    ("char(3) for bit data", "binary"),
    ("varchar(4) for bit data", "binary"),
    ("smallint", "int"),
    ("integer", "int"),
    ("bigint", "bigint"),
    ("real", "float"),
    ("double", "double"),
    ("float", "double"),
    ("decimal", "decimal(5,0)"),
    ("numeric(7,3)", "decimal(7,3)"),
    ("date", "date"),
    ("time", "timestamp_ntz"),
    ("timestamp", "timestamp_ntz"),
    ("boolean", "boolean"),
]


def test_database_types(database, table):
    columns = ", ".join(f"c{i} {w}" for i, (w, _) in enumerate(WORDS))
    database.run_batch([f"CREATE TABLE {table} ({columns})"])
    found = [f.dataType.simpleString() for f in database.schema_of(table=table).fields]
    assert found == [t for _, t in WORDS]


def test_errors_name_the_trouble(database, orders, table):
    database.run_batch([f"CREATE TABLE {table} (a int, doc xml)"])
    with pytest.raises(SchemaError, match="XML"):
        database.schema_of(table=table)
    with pytest.raises(SchemaError, match="(?i)nosuch"):
        database.read(table="nosuch")
    with pytest.raises(SchemaError, match="'o_orderkey': array<bigint>"):
        database.write(orders.select(F.array("o_orderkey").alias("o_orderkey")), f"{table}_a")
    with pytest.raises(SchemaError, match="distribution column"):
        database.write(orders, f"{table}_a", distribution=Distribution.hash("zzz"))
    with pytest.raises(OptionError, match="partition column not in"):
        database.read(query="SELECT 1 AS x FROM sysibm.sysdummy1", partition_columns=["y"])
    assert not database.exists(f"{table}_a")


def test_batch_is_all_or_nothing(database, table):
    with pytest.raises(LoadError):
        database.run_batch([f"CREATE TABLE {table} (a int)", "NOT SQL"])
    assert not database.exists(table)


def test_options_reach_the_database(spark, url, tmp_path, table):
    import stagehouse

    nation = spark.read.parquet(f"{SF}/nation.parquet")
    options = {
        "url": url,
        "user": "app",
        "password": "app",
        "dbtable": table,
        "stagingdir": str(tmp_path / "s"),
    }
    stagehouse.write(nation, options)
    back = stagehouse.read(spark, {**options, "partitionColumn": "n_nationkey", "numPartitions": 2})
    assert same_rows(back, nation)


def test_no_connection_is_an_error(spark, tmp_path):
    lost = JdbcWarehouse(spark, "jdbc:derby:memory:absent", str(tmp_path), user="a", password="b")
    with pytest.raises(LoadError, match="cannot connect"):
        lost.exists("t")


def test_bulk_load_by_the_database(database, orders, table, monkeypatch):
    """Derby cannot read Parquet, so the statement is only watched; it comes after drop and create."""
    ran = []
    database.write(orders.limit(1), table)
    watched = lambda texts: ran.extend(x for x in texts if isinstance(x, str))
    monkeypatch.setattr(database, "run_batch", watched)
    database.bulk_load = "COPY INTO {table} ({columns}) FROM '{path}'"
    database.write(orders, table, mode="overwrite")
    drop, create, copy = ran
    assert drop == f"DROP TABLE {table}" and create.startswith(f"CREATE TABLE {table} (")
    assert copy.startswith(f'COPY INTO {table} ("o_orderkey", ') and database.area.base in copy
    assert len(database.area) == 0
    ran.clear()
    database.type_overrides = {}
    staged = database.stage(orders)
    assert database.copy_into(table, staged.path) == orders.count()
    assert ran[0].endswith(f"FROM '{staged.path}'") and len(ran) == 1
    turned = database.stage(orders.select(*reversed(orders.columns)))
    assert database.copy_into(table, turned.path) == orders.count()
    assert not ran[1].endswith(f"FROM '{turned.path}'")
    assert len(database.area) == 2


def test_bulk_unload_by_the_database(spark, database, orders, table, monkeypatch):
    database.write(orders, table)
    run_batch, ran = database.run_batch, []

    def with_files(statements):
        """Stands for a database that writes the Parquet files."""
        path = statements[0].rsplit("|", 1)[1]
        ran.extend(statements)
        orders.select("o_custkey", "o_orderkey").write.mode("append").parquet(path)

    monkeypatch.setattr(database, "run_batch", with_files)
    database.bulk_unload = ["UNLOAD {query} AS {name} |{path}", "DROP {name}"]
    back = database.read(table=table, schema=T.StructType.fromDDL("o_orderkey BIGINT"))
    assert same_rows(back, orders.select("o_orderkey"))
    assert ran[0].startswith(f"UNLOAD SELECT * FROM {table} AS unload_")
    assert ran[1] == "DROP " + ran[0].split()[6]
    monkeypatch.setattr(database, "run_batch", lambda statements: None)
    assert database.unload("SELECT 1 AS x FROM sysibm.sysdummy1").rows == 0
    database.bulk_unload = "NOT SQL"
    monkeypatch.setattr(database, "run_batch", run_batch)
    left = len(database.area)
    with pytest.raises(LoadError):
        database.read(table=table)
    assert len(database.area) == left


def test_layout_text_of_a_database():
    schema = T.StructType.fromDDL("a INT, b STRING")
    made = JdbcWarehouse.__new__(JdbcWarehouse)
    made.type_overrides = {}
    made.lengths = (4000, 8000)
    made.dialect = "tsql"
    text = lambda layout: made._create_text("dbo.t", schema, Distribution.parse(layout))
    columns = "CREATE TABLE dbo.t ([a] int, [b] nvarchar(4000))"
    assert text(None) == f"{columns} WITH (HEAP, DISTRIBUTION = ROUND_ROBIN)"
    assert text("HASH([a])") == f"{columns} WITH (HEAP, DISTRIBUTION = HASH([a]))"
    assert text("CLUSTERED COLUMNSTORE INDEX, REPLICATE") == (
        f"{columns} WITH (CLUSTERED COLUMNSTORE INDEX, DISTRIBUTION = REPLICATE)"
    )
    made.dialect = "ansi"
    assert text("HASH(a)") == 'CREATE TABLE dbo.t ("a" int, "b" varchar(4000))'


def test_odd_names(database, orders):
    database.run_batch(['CREATE SCHEMA "odd schema"'])
    name = "`odd schema`.`t-1`"
    assert same_rows(database.write(orders, name), orders)
    assert same_rows(database.write(orders, name, mode="append"), orders.unionAll(orders))
    odd = orders.select(F.col("o_orderkey").alias('a "b'), F.col("o_custkey").alias("c.d"))
    database.rename = "RENAME TABLE {old} TO {new}"
    assert same_rows(database.write(odd, name, mode="overwrite"), odd)
    back = database.read(table=name, partition_columns=["c.d"])
    assert same_rows(back, odd)
    assert not [t for t in tables_left(database) if t.startswith("LANDING")]
    database.drop_table(name)


def test_long_text_and_bytes_without_overrides(spark, url, tmp_path, table):
    plain = JdbcWarehouse(spark, url, str(tmp_path / "s"), user="app", password="app")
    rows = spark.range(4).selectExpr(
        "id", "repeat('long é ', CAST(id * 3000 AS INT)) AS t",
        "encode(repeat('x', CAST(id * 9000 AS INT)), 'utf-8') AS b", "nullif(id, 2) AS n",
    )
    assert same_rows(plain.write(rows, table), rows)
    assert same_rows(plain.read(table=table, partition_columns=["n", "id"]), rows)


def test_words_of_the_url():
    from pyspark.sql import SparkSession

    from stagehouse.functions.ddl import ddl_for, quote_column
    from stagehouse.functions.dialects import UrlDialect

    spark = SparkSession.getActiveSession()
    schema = T.StructType.fromDDL(
        "a STRING, b BINARY, c TIMESTAMP_NTZ, d DOUBLE, e TINYINT, f DECIMAL(38,10)"
    )
    of = lambda url: UrlDialect.of(spark, url)
    assert ddl_for(schema, of("jdbc:sqlserver://h")) == (
        '"a" NVARCHAR(MAX), "b" VARBINARY(MAX), "c" DATETIME2, "d" DOUBLE PRECISION, '
        '"e" SMALLINT, "f" DECIMAL(38,10)'
    )
    assert ddl_for(schema, of("jdbc:oracle:thin:@h")) == (
        '"a" CLOB, "b" BLOB, "c" TIMESTAMP, "d" BINARY_DOUBLE, "e" NUMBER(3), "f" DECIMAL(38,10)'
    )
    assert "`c` DATETIME(6)" in ddl_for(schema, of("jdbc:mysql://h"))
    assert quote_column("a`b", of("jdbc:mysql://h")) == "`a``b`"
    assert of("jdbc:nobody:h") == "ansi"
    with pytest.raises(SchemaError, match="does not fit into the database"):
        ddl_for(schema, of("jdbc:derby:h"))
    words = {T.DecimalType: "varchar(40)"}
    assert ddl_for(schema, of("jdbc:derby:h"), overrides=words).endswith('"f" varchar(40)')
    with pytest.raises(SchemaError, match="array<int> has no database type"):
        ddl_for(T.StructType.fromDDL("a ARRAY<INT>"), of("jdbc:derby:h"))


def sliced(spark, database, table, names, count):
    """Rows of each slice, and the number of counting queries."""
    keys = tuple(KeyColumn(f'"{n}"', T.LongType()) for n in names)
    slices = KeySlices(spark, database.options, table, keys)
    made = slices.predicates(count)
    login = {"user": "app", "password": "app"}
    rows = spark.read.jdbc(database.url, table, predicates=made, properties=login)
    sizes = [len(p) for p in rows.select(*[f"`{n}`" for n in names]).rdd.glom().collect()]
    return sizes, slices.rounds, rows


SHAPES = {
    "even": "id",
    "far outliers": "if(id % 400 = 0, id * id * 1000000, id)",
    "clusters": "if(id < 6000, id % 40, id * 100000)",
    "powers": "CAST(pow(2, id % 60) AS BIGINT)",
    "hot": "if(id < 3000, 7, id)",
    "mostly null": "if(id < 6000, null, id)",
    "null": "CAST(null AS BIGINT)",
    "negative": "-id * 1000 - 5",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_slices_of_equal_depth(spark, database, table, shape):
    key = f"nullif(CAST({SHAPES[shape]} AS BIGINT), -1) AS k"
    rows = spark.range(8000).selectExpr(key, "id")
    database.write(rows, table)
    count = 100 if shape in ("even", "mostly null") else 25
    sizes, rounds, back = sliced(spark, database, table, ["k", "id"], count)
    assert same_rows(back, rows)
    assert rounds <= (10 if shape == "powers" else 4)  # the bits of the range, ten or so a round
    assert 0.9 * count <= len(sizes) <= count and max(sizes) <= 1.3 * 8000 / count
    more = spark.range(3).selectExpr("CAST(null AS BIGINT) AS k", "-id * 77 AS id")
    database.write(more, table, mode="append")  # rows that came after the counting are in a slice too
    assert back.count() == 8003


def test_three_keys_with_nulls_and_a_key_that_cannot_be_cut(spark, database, table, caplog):
    rows = spark.range(6000).selectExpr(
        "CAST(nullif(id % 3, 1) AS BIGINT) AS a", "CAST(nullif(id % 5, 2) AS BIGINT) AS b",
        "if(id % 7 = 0, null, id) AS c",
    )
    database.write(rows, table)
    sizes, rounds, back = sliced(spark, database, table, ["a", "b", "c"], 50)
    assert same_rows(back, rows) and rounds <= 4 and max(sizes) <= 200
    sizes, _, back = sliced(spark, database, table, ["a"], 50)
    assert same_rows(back, rows) and sorted(sizes) == [2000, 2000, 2000]
    assert "share the key" in caplog.text


def test_empty_table_is_one_slice(spark, database, table):
    database.write(spark.range(0).selectExpr("id AS k"), table)
    assert sliced(spark, database, table, ["k"], 10)[0] == [0]


def test_primary_key_cuts_without_being_asked(spark, url, tmp_path, table):
    database = JdbcWarehouse(
        spark, url, str(tmp_path / "s"), user="app", password="app", num_partitions=4
    )
    columns = "name varchar(9), a int not null, b bigint not null"
    database.run_batch([f"CREATE TABLE {table} ({columns}, PRIMARY KEY (b, a))"])
    rows = spark.range(400).selectExpr("'n' AS NAME", "CAST(id AS INT) AS A", "id % 2 AS B")
    database.write(rows, table, mode="append")
    live = database.source(table=table)
    assert live.rdd.getNumPartitions() == 4 and same_rows(live, rows)
    assert database.source(table=table, partition_columns=[]).rdd.getNumPartitions() == 1
    database.run_batch([f"CREATE TABLE {table}_s (a varchar(3) not null primary key)"])
    assert database.source(table=f"{table}_s").rdd.getNumPartitions() == 1
