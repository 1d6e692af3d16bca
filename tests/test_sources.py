"""Sources: query text, JDBC options, SQLite folders."""

import math
import random
import sqlite3
from functools import reduce

import pytest
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F, types as T

from rowferry import Engine
from rowferry.operators.normalise import describe, normalise
from rowferry.sinks import jdbctable
from rowferry.sources.jdbc import JdbcSource, read_jdbc
from rowferry.sources.jdbc_splits import even_predicates
from rowferry.sources.query import query_text, register_tables, scratch_path
from rowferry.sources import sqlite as fleet
from rowferry.sources.sqlite import count_sqlite, find_cuts, read_sqlite, storage_classes
from rowferry.sources.sqlite_filters import normalised, spark_filter, to_text

DERBY = JdbcSource(url="jdbc:derby:memory:sources;create=true",
                   driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


@pytest.fixture
def engine(spark):
    return Engine(spark)


def test_query_text(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("select 1 as a\n-- note\n")
    assert query_text(spark, sql_file=str(path)).startswith("select 1 as a\n")
    assert query_text(spark, "select 2", str(path)) == "select 2"
    with pytest.raises(ValueError, match="no query"):
        query_text(spark)


def test_failing_init_shows_the_statement(engine):
    with pytest.raises(RuntimeError, match="select nope"):
        engine.query("select 1", init=["select nope"])


def test_register_tables(spark):
    assert "lineitem" in register_tables(spark, "/root/testdata/sf0.001")
    assert register_tables(spark, "/root/testdata/sf0.001/", ["nation"]) == ["nation"]


def test_scratch_path_is_in_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_path(spark, "x")


def test_server_options():
    options = JdbcSource.server("mysql", "db", timeout=3, user="u", init=("set x=1", "set y=2")).options()
    assert options["url"] == "jdbc:mysql://localhost:3306/db"
    assert options["connectTimeout"] == "3000" and options["queryTimeout"] == "3"
    assert options["sessionInitStatement"] == "set x=1, y=2" and options["fetchsize"] == "500"
    options = JdbcSource.server("postgres", "db", host="h", timeout=3).options()
    assert options["url"] == "jdbc:postgresql://h:5432/db" and options["socketTimeout"] == "3"


def test_jdbc_partitions_and_pushdown(spark, engine):
    rows = spark.range(1000).selectExpr("id as k", "id % 7 as g", "cast(id as double) as x")
    engine.export(rows, "table", url=DERBY.url, table="t1", properties={"driver": DERBY.driver})
    sql = 'select "k" as k, "g" as g, "x" as x from t1;'
    df = read_jdbc(spark, DERBY, sql, partition_column="k", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 1000
    plan = df.where("K > 990").select("G")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(K), *GreaterThan(K,990)]" in plan and "ReadSchema: struct<G:bigint>" in plan
    empty = read_jdbc(spark, DERBY, sql.replace(";", " where 1 = 0"), partition_column="k", partitions=4)
    assert empty.count() == 0 and empty.columns == ["K", "G", "X"]
    assert engine.count(source=DERBY, sql=sql).first()[0] == 1000


def test_jdbc_types(spark):
    """What a database gives, brought to the common types."""
    sql = """select cast('10:11:12' as time) as t, cast('2020-01-02 03:04:05.678' as timestamp) as ts,
             cast(1 as smallint) as s, cast(1.5 as real) as r, cast('1.25' as decimal(8,2)) as d
             from sysibm.sysdummy1"""
    rows = normalise(read_jdbc(spark, DERBY, sql), "mysql")
    assert [t for _, t in rows.dtypes] == ["time(6)", "timestamp_ntz", "bigint", "double", "decimal(8,2)"]
    row = rows.select(F.col("T").cast("string"), F.col("TS").cast("string")).first()
    assert tuple(row) == ("10:11:12", "2020-01-02 03:04:05")
    spark.conf.set("spark.sql.timeType.enabled", "false")
    try:
        assert normalise(read_jdbc(spark, DERBY, sql), "postgres").first()["T"] == "10:11:12"
    finally:
        spark.conf.set("spark.sql.timeType.enabled", "true")


def test_mysql_reads_with_a_cursor():
    options = JdbcSource.server("mysql", properties={"tinyInt1isBit": "true"}).options()
    assert options["useCursorFetch"] == "true" and options["tinyInt1isBit"] == "true"


def test_jdbc_init_runs_in_each_session(spark, engine):
    """A statement before the read; its failure is the read's failure."""
    sql = "select schemaname as name from sys.sysschemas"
    good = JdbcSource(url=DERBY.url, driver=DERBY.driver, init=("set schema sys",))
    assert engine.read("jdbc", sql, source=good).count() > 5
    bad = JdbcSource(url=DERBY.url, driver=DERBY.driver, init=("set schema nowhere",))
    with pytest.raises(Exception, match="NOWHERE"):
        engine.read("jdbc", sql, source=bad).collect()


def test_read_kinds(engine):
    with pytest.raises(ValueError, match="unknown source kind"):
        engine.read("oracle", "select 1")
    assert engine.read("spark", "select 1 as a").first().a == 1


def make_db(path, script):
    db = sqlite3.connect(path)
    db.executescript(script)
    db.close()


def test_sqlite_mixed_types(spark, tmp_path):
    make_db(tmp_path / "a.sqlite", """create table t(c1, c2, c3, c4, c5);
        insert into t values (1, 1, 'x', x'ff', x'6162'), (2, 2.5, 3, x'00', null);""")
    make_db(tmp_path / "b.sqlite", """create table t(c1, c2, c3, c4, c5);
        insert into t values (null, 7, null, null, x'c3a9');""")
    found = {r.column_name: r.spark_type for r in storage_classes(spark, str(tmp_path), table="t").collect()}
    assert found == {"c1": "bigint", "c2": "double", "c3": "string", "c4": "binary", "c5": "string"}
    rows = sorted(read_sqlite(spark, str(tmp_path), table="t").collect(), key=lambda r: r.c2)
    assert [tuple(r) for r in rows] == [
        (1, 1.0, "x", bytearray(b"\xff"), "ab"), (2, 2.5, "3", bytearray(b"\x00"), None),
        (None, 7.0, None, None, "é")]


def test_sqlite_split_covers_every_row_once(spark, tmp_path):
    make_db(tmp_path / "a.sqlite", """create table t(k integer primary key, v text);
        with recursive n(i) as (select 1 union all select i + 1 from n where i < 5000)
        insert into t select i * i, 'value ' || i from n;""")
    df = read_sqlite(spark, str(tmp_path), table="t", split_bytes=10_000)
    assert df.rdd.getNumPartitions() > 5
    assert df.count() == 5000 and df.agg(F.countDistinct("k")).first()[0] == 5000
    make_db(tmp_path / "b.sqlite", "create table t(k integer primary key, v text) without rowid;"
            + "".join(f"insert into t values ({-i}, 'x' || {i});" for i in range(1, 2000)))
    df = read_sqlite(spark, str(tmp_path), table="t", split_bytes=10_000)
    assert df.count() == 6999 == count_sqlite(spark, str(tmp_path), table="t", split_bytes=10_000).first()[0]


def test_sqlite_query_and_errors(spark, engine, tmp_path):
    make_db(tmp_path / "a.sqlite", "create table t(a int); insert into t values (1), (2);")
    rows = engine.read("sqlite", "select a * 2 as b from t where a > 1", path=str(tmp_path))
    assert [tuple(r) for r in rows.collect()] == [(4,)] and rows.dtypes == [("b", "bigint")]
    with pytest.raises(ValueError, match="either table or query"):
        read_sqlite(spark, str(tmp_path))
    with pytest.raises(Exception, match="no column z"):
        read_sqlite(spark, str(tmp_path), table="t", schema="z bigint").collect()
    make_db(tmp_path / "b.sqlite", "create table t(a int); insert into t values ('word');")
    with pytest.raises(Exception, match="b.sqlite, column a"):
        read_sqlite(spark, str(tmp_path), table="t", schema="a bigint").collect()


def test_sqlite_init(spark, tmp_path):
    make_db(tmp_path / "a.sqlite", "create table t(a int); insert into t values (1), (2);")
    init = ["create temp view v as select a + 10 as a from t"]
    rows = read_sqlite(spark, str(tmp_path), query="select * from v", init=init)
    assert sorted(r.a for r in rows.collect()) == [11, 12]


def test_sqlite_catalog(engine, tmp_path):
    make_db(tmp_path / "a.sqlite",
            "create table t(a int not null, b text, primary key (a, b)); create table s(z blob);")
    rows = engine.catalog("sqlite", path=str(tmp_path)).orderBy("table_name", "ordinal").collect()
    assert [(r.table_name, r.column_name, r.description) for r in rows] == [
        ("s", "z", "(BLOB)"), ("t", "a", "(INT NOT NULL PRIMARY KEY)"), ("t", "b", "(TEXT PRIMARY KEY)")]


def test_describe_empty_result(spark):
    rows = describe(spark.createDataFrame([], "a bigint, b array<int>")).collect()
    assert [(r.name, r.unified_type, r.sql_type) for r in rows] == [
        ("a", "I64", "integer"), ("b", "Custom(array<int>)", None)]


def test_normalise_time_and_unknown_dialect(spark):
    df = spark.sql("select time'10:11:12.75' as t, timestamp_ntz'2020-01-01 00:00:00.9' as d, 1Y as i")
    row = normalise(df, "mysql").select(F.col("t").cast("string"), F.col("d").cast("string"), "i").first()
    assert tuple(row) == ("10:11:12", "2020-01-01 00:00:00", 1)
    with pytest.raises(ValueError, match="unknown dialect"):
        normalise(df, "oracle")


def many_rows(path, create, rows):
    db = sqlite3.connect(path)
    for statement in create:
        db.execute(statement)
    db.executemany(f"insert into t values ({', '.join('?' * len(rows[0]))})", rows)
    db.commit()
    db.close()


@pytest.mark.parametrize("create, rows, table", [
    (["create table t (k integer, v text)", "create view w as select k, v from t"],
     [(i, "x" * 40) for i in range(2000)], "w"),
    (["create table t (rowid integer, v text)"],
     [(None if i % 10 == 0 else i, "x" * 40) for i in range(2000)], "t"),
    (["create table t (rowid text, _rowid_ text, oid text)"], [("a", "b", "x" * 40)] * 2000, "t"),
    (["create table t (k integer primary key, v text) without rowid"],
     [(i, "x" * 40) for i in range(2000)], "t"),
    (["create table t (k integer primary key, v text)"],
     [(i if i < 1999 else 10**12, "x" * 40) for i in range(2000)], "t"),
])
def test_sqlite_split_of_odd_tables(spark, tmp_path, create, rows, table):
    many_rows(tmp_path / "a.db", create, rows)
    (tmp_path / "a.db-wal").write_bytes(b"")
    whole = read_sqlite(spark, str(tmp_path), table=table)
    split = read_sqlite(spark, str(tmp_path), table=table, split_bytes=16384)
    cut = table == "t" and "rowid text" not in create[0] and "without rowid" not in create[0]
    assert (split.rdd.getNumPartitions() > 3) == cut  # what has no row ids is read by one task
    assert split.count() == 2000 == count_sqlite(spark, str(tmp_path), table=table, split_bytes=16384).first()[0]
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_sqlite_parts_are_even_however_far_the_ids(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer primary key, v text)"],
              [(i if i < 1999 else 10**12, "x" * 40) for i in range(2000)])
    rows = read_sqlite(spark, str(tmp_path), table="t", split_bytes=16384)
    sizes = [len(p) for p in rows.rdd.glom().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_sqlite_reads_only_the_columns_asked_for(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer, v text)"], [(1, "x"), (2, "y")])
    rows = read_sqlite(spark, str(tmp_path), table="t", schema="k bigint, v string", columns=["v"], suffix=".db")
    assert rows.columns == ["v"] and sorted(r.v for r in rows.collect()) == ["x", "y"]


def test_failing_sqlite_init_is_named(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer)"], [(1,)])
    with pytest.raises(Exception, match="select nope"):
        read_sqlite(spark, str(tmp_path), table="t", init=["select 1", "select nope"]).count()


def test_partition_column_needs_a_number(spark):
    with pytest.raises(ValueError, match="partitions"):
        read_jdbc(spark, DERBY, "select 1 as a from sysibm.sysdummy1", partition_column="a")


def test_postgres_catalog_connects_to_its_database(engine, monkeypatch):
    seen = []

    def stop(spark, source, text, **splits):
        seen.append(source.url)
        raise LookupError

    monkeypatch.setattr("rowferry.sources.jdbc.read_jdbc", stop)
    with pytest.raises(LookupError):
        engine.catalog("postgres", database="shop", user="u")
    assert seen == ["jdbc:postgresql://localhost:5432/shop"]


ODD_CELLS = [None, 0, 3, -7, 2**53 + 1, 1.5, -0.0, 3.0, 1e300, float("inf"), "", "abc", "ABC", "abcd", "b", "é", "\U0001f600", "\uffee",
             "3", "1.5", "3.0", b"abc", b"", b"3"]


def odd_fleet(tmp_path):
    """Every kind of cell in columns of every affinity."""
    number = [c for c in ODD_CELLS if c is None or isinstance(c, (int, float))]
    whole = [c for c in ODD_CELLS if c is None or isinstance(c, int)]
    rows = [(i, whole[i % len(whole)], number[i % len(number)], ODD_CELLS[i % len(ODD_CELLS)], ODD_CELLS[i * 7 % len(ODD_CELLS)])
            for i in range(240)]
    for name, encoding in (("a.db", "UTF-8"), ("b.db", "UTF-16le")):
        many_rows(tmp_path / name, [
            f"pragma encoding = '{encoding}'", "create table t (id integer primary key, k, d real, s, n text collate nocase)",
            "create index i on t (k)", "create index j on t (s)"], rows)
    return "id bigint, k bigint, d double, s string, n string"


FILTERS = [
    ("k", ">", 0), ("k", "<=", 3), ("k", "=", 3), ("k", "<>", 3), ("k", "<=>", 3), ("k", "<=>", None), ("k", "in", [0, 3, 9]),
    ("k", "not in", [0, 3]), ("k", "is null"), ("k", "is not null"), ("k", ">", 1.5), ("d", ">", 1.5), ("d", ">=", 1.5),
    ("d", "<", 2**53 + 1), ("d", "=", 3), ("d", "<>", 3), ("d", "in", [1.5, 0.0]), ("d", "=", 0.0), ("d", ">", float("inf")),
    ("d", "=", float("inf")), ("d", "not in", [1.5]), ("s", "=", "abc"), ("s", "=", "3"), ("s", "=", "3.0"), ("s", "<>", "abc"),
    ("s", "in", ["abc", "1.5"]), ("s", "in", ["abc", "é"]), ("s", "not in", ["abc"]), ("s", ">", "abc"), ("s", "<=", "3"),
    ("s", ">", "\uffee"), ("s", "<", "\U0001f600"), ("s", "starts with", "ab"), ("s", "ends with", "c"), ("s", "contains", "b"),
    ("s", "contains", ""), ("s", "is null"), ("s", "<=>", "abc"), ("n", "=", "abc"), ("n", "<>", "abc"), ("n", ">", "a"),
    ("n", "in", ["ABC", "b"]), ("n", "starts with", "A"),
]


def test_filters_inside_sqlite_change_no_result(spark, tmp_path):
    schema = odd_fleet(tmp_path)
    read = lambda *filters: read_sqlite(spark, str(tmp_path), table="t", schema=schema, split_bytes=4096, filters=filters)
    plain = spark.createDataFrame(read().collect(), schema)
    assert read().rdd.getNumPartitions() > 3
    whole = lambda wanted: read_sqlite(spark, str(tmp_path), table="t", schema=schema, filters=[wanted])
    found, want = (
        reduce(DataFrame.union, [rows(w).withColumn("filter", F.lit(str(w))) for w in FILTERS]).collect()
        for rows in (whole, lambda w: plain.where(spark_filter(normalised([w])[0]))))
    assert sorted(map(str, found)) == sorted(map(str, want))
    three = read(("k", ">=", 0), ("s", "=", "abc"), ("d", "<", 2.0))
    assert sorted(map(str, three.collect())) == sorted(map(str, plain.where("k >= 0 and s = 'abc' and d < 2").collect()))
    assert three.union(read(("k", "=", 3))).count() == three.count() + plain.where("k = 3").count()  # a frame keeps its own
    with pytest.raises(ValueError, match="unknown operator"):
        read(("k", "like", "x"))


def test_filters_on_columns_that_are_not_read(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer, v text, b blob)"], [(i, f"n{i % 3}", b"x%d" % i) for i in range(30)])
    rows = read_sqlite(spark, str(tmp_path), table="t", schema="k bigint, v string, b binary", columns=["k"],
                       filters=[("v", "=", "n1"), ("k", "<", 9), ("b", "in", [b"x1", b"x4"])])
    assert rows.columns == ["k"] and sorted(r.k for r in rows.collect()) == [1, 4]
    query = read_sqlite(spark, str(tmp_path), query="select k * 2 as d from t;", filters=[("d", ">", 50)])
    assert sorted(r.d for r in query.collect()) == [52, 54, 56, 58]


def read_here(path, schema, filters=(), **options):
    """Rows per part that a reader in this process takes out of SQLite."""
    reader = fleet.FleetReader({"path": str(path), "table": "t", "filters": to_text(normalised(filters)), **options},
                               T._parse_datatype_string(schema))
    return [sum(b.num_rows for b in reader.read(p)) for p in reader.partitions()]


def test_only_matching_rows_leave_sqlite(tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer primary key, v text)"], [(i, f"name {i % 10}") for i in range(5000)])
    kind = "k bigint, v string"
    assert read_here(tmp_path, kind) == [5000]
    assert read_here(tmp_path, kind, [("k", "<", 50), ("k", "is not null")]) == [50]
    assert read_here(tmp_path, kind, [("k", "<", 50), ("v", "=", "name 3")]) == [5]
    assert read_here(tmp_path, kind, [("k", "in", list(range(2000)))]) == [5000]  # too long a list, left to Spark
    plans = []
    for filters in ([], [("k", "=", 7)]):
        reader = fleet.FleetReader({"path": str(tmp_path), "table": "t", "filters": to_text(filters)}, T._parse_datatype_string(kind))
        db = sqlite3.connect(tmp_path / "a.db")
        text, args = reader._select(db, reader.partitions()[0])
        plans.append(" ".join(str(r) for r in db.execute(f"explain query plan {text}", args)))
    assert "SCAN t" in plans[0] and "SEARCH t USING INTEGER PRIMARY KEY" in plans[1]


def test_a_file_is_counted_once_however_many_parts(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (k integer, v text)"], [(i, "x" * 60) for i in range(20_000)])
    reader = fleet.FleetReader({"path": str(tmp_path), "table": "t", "kind": "cuts"}, None)
    work = {}
    for split in (1 << 20, 1 << 14):
        reader.split, seen, ticks = split, [], []
        db = sqlite3.connect(tmp_path / "a.db")
        db.set_trace_callback(seen.append)
        db.set_progress_handler(lambda: ticks.append(1), 1000)
        parts = list(reader._cuts(db, fleet.FilePart(str(tmp_path / "a.db")), fleet.pafs.LocalFileSystem()))
        assert sum("count(*)" in s for s in seen) == 1
        work[len(parts)] = len(ticks)
    few, many = sorted(work)
    assert many > 50 * few / 2 and work[many] < 1.5 * work[few]
    cuts = find_cuts(spark, str(tmp_path), "t", 1 << 14)
    reader = fleet.FleetReader({"path": str(tmp_path), "table": "t", "cuts": cuts}, T._parse_datatype_string("k bigint"))
    seen = []
    db = sqlite3.connect(tmp_path / "a.db")
    db.set_trace_callback(seen.append)
    assert len(reader.partitions()) == many
    for part in reader.partitions():
        reader._select(db, part)
    assert not any("count(" in s or "offset" in s for s in seen)


def test_a_file_of_a_store_is_fetched_once(tmp_path, monkeypatch):
    many_rows(tmp_path / "a.db", ["create table t (k integer, v text)"], [(i, "x" * 60) for i in range(2000)])
    many_rows(tmp_path / "b.db", ["create table t (k integer, v text)"], [(i, "x" * 60) for i in range(3000)])
    opened = []

    remote = pafs.SubTreeFileSystem("/", pafs.LocalFileSystem())
    plain = fleet.connect
    monkeypatch.setattr(fleet, "open_path", lambda p: (remote, p))
    monkeypatch.setattr(fleet, "connect", lambda fs, p: (opened.append(p), plain(fs, p))[1])
    monkeypatch.setattr(fleet, "list_files", lambda p, s: [(str(f), f.stat().st_size) for f in sorted(tmp_path.glob("*.db"))])
    assert read_here(tmp_path, "k bigint", splitbytes="4096") == [2000, 3000]
    assert len(opened) == 2
    with pytest.raises(ValueError, match="limit is 1000"):
        read_here(tmp_path, "k bigint", fetchbytes="1000")


def test_text_check_by_batch(spark, tmp_path):
    many_rows(tmp_path / "a.db", ["create table t (a, b, c)"],
              [("é", b"\xc3\xa9", 1)] * 9000 + [("x", b"\xff", "y")] + [(None, None, b"\xe2\x82\xac")])
    found = {r.column_name: (r.texts, r.blobs, r.undecodable, r.spark_type) for r in storage_classes(spark, str(tmp_path), "t").collect()}
    assert found == {"a": (True, False, False, "string"), "b": (False, True, True, "binary"), "c": (True, True, False, "string")}


def fill(engine, spark, table, rows, **options):
    return engine.export(rows, "table", url=DERBY.url, table=table, properties={"driver": DERBY.driver}, **options)


def sizes_of(df):
    return df.select(F.spark_partition_id().alias("p")).groupBy("p").count().select("count").collect()


def test_partitions_alone_split_evenly(spark, engine):
    """Nine tenths of the rows share one key, some have none, and the others lie far apart."""
    rows = spark.range(4000).selectExpr(
        "case when id % 10 < 9 then 7 when id % 50 = 9 then null when id % 30 = 19 then -id * id * 1000000000 else id * id end as k",
        "if(id % 97 = 0, null, id) as g", "'x' as v")
    fill(engine, spark, "skewed", rows)
    sql = 'select "k" as k, "g" as g, "v" as v from skewed'
    df = read_jdbc(spark, DERBY, sql, partitions=8)
    sizes = [r[0] for r in sizes_of(df)]
    assert sum(sizes) == 4000 and 8 <= df.rdd.getNumPartitions() <= 12
    assert max(sizes) <= 1.25 * 500, sizes
    assert sorted(map(str, df.collect())) == sorted(map(str, read_jdbc(spark, DERBY, sql).collect()))
    by_g = read_jdbc(spark, DERBY, sql, partitions=4, split_by=["G"])
    assert max(r[0] for r in sizes_of(by_g)) <= 1250 and by_g.count() == 4000
    assert read_jdbc(spark, DERBY, sql + " where 1 = 0", partitions=4).count() == 0
    assert read_jdbc(spark, DERBY, sql + ' where "k" is null', partitions=4).count() == rows.where("k is null").count()
    with pytest.raises(ValueError, match="whole-number column"):
        read_jdbc(spark, DERBY, "select v from (" + sql + ") z", partitions=4)


def test_split_counts_cover_every_value_once():
    """The same against a database in this process, over the whole range of 64 bits."""
    rng = random.Random(3)
    for case in range(12):
        keys = [rng.choice([None, 5, 6, rng.randrange(-2**63, 2**63), rng.randrange(100), -2**63, 2**63 - 1]) for _ in range(600)]
        if case % 3 == 0:
            keys = [k if k is None else k % 50 for k in keys]
        db = sqlite3.connect(":memory:")
        db.create_function("floor", 1, lambda x: None if x is None else math.floor(x))
        db.create_function("mod", 2, lambda a, b: None if a is None else int(math.fmod(a, b)))
        db.execute("create table t (k integer, g integer)")
        db.executemany("insert into t values (?, ?)", [(k, i) for i, k in enumerate(keys)])
        found = even_predicates(lambda q: db.execute(q.replace("{rows}", "t")).fetchall(), ["k", "g"], 6)
        seen = [g for p in found for (g,) in db.execute(f"select g from t where {p}")]
        assert sorted(seen) == list(range(600))
        assert max(db.execute(f"select count(*) from t where {p}").fetchone()[0] for p in found) <= 130


def test_a_repeated_task_inserts_its_rows_once(spark, engine):
    """A task that has committed its insert and is then lost runs again."""
    rows = spark.range(100).repartition(4)
    plain = jdbctable.marked

    def twice(df):
        """As if every partition had run two attempts, both committed."""
        found, part, attempt = plain(df)
        again = found.withColumn(part, F.col(part) - 4)  # the second half of a union has numbers from 4 on
        return found.unionByName(again), part, attempt

    jdbctable.marked = twice
    try:
        assert fill(engine, spark, "once", rows).rows >= 100
    finally:
        jdbctable.marked = plain
    assert sorted(r[0] for r in read_jdbc(spark, DERBY, 'select "id" as id from once').collect()) == list(range(100))
    fill(engine, spark, "once", spark.range(100, 103), mode="append")
    assert read_jdbc(spark, DERBY, "select * from once").count() == 103
    left = read_jdbc(spark, DERBY, "select tablename as t from sys.systables where tablename like '%STAGING%'")
    assert left.count() == 0


def test_a_failed_write_leaves_the_table_as_it_was(spark, engine):
    fill(engine, spark, "kept", spark.range(5))
    bad = spark.range(50).repartition(4).selectExpr("if(id = 49, raise_error('boom'), id) as id")
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="boom"):
            fill(engine, spark, "kept", bad, mode=mode)
        assert read_jdbc(spark, DERBY, "select * from kept").count() == 5


def test_jdbc_init_statements_run_in_turn_and_are_named(spark, engine):
    fill(engine, spark, "logged", spark.range(1))
    sql = 'select "id" as id from logged'
    good = JdbcSource(url=DERBY.url, driver=DERBY.driver, init=(
        'insert into logged values (10)', 'insert into logged values (20)', "set schema app"))
    source = JdbcSource(url=DERBY.url, driver=DERBY.driver, init=(
        'insert into logged values (30)', 'insert into nowhere values (1)', "set schema app"))
    with pytest.raises(RuntimeError, match="failed:\ninsert into nowhere") as error:
        read_jdbc(spark, source, sql)
    assert "NOWHERE" in str(error.value)
    rows = read_jdbc(spark, good, sql, partitions=3)
    assert sorted(r[0] for r in rows.collect()) == [0, 10, 20, 30]  # each ran once, however many sessions read
    with pytest.raises(RuntimeError, match="set schema nosuch"):
        read_jdbc(spark, JdbcSource(url=DERBY.url, driver=DERBY.driver, init=("set schema app", "set schema nosuch")[1:]), sql)


def test_session_statements():
    two = ("set @a = 1", "set session sql_mode = 'ANSI'; ", "insert into t values (1)")
    options = JdbcSource.server("mysql", init=two).options()
    assert options["sessionInitStatement"] == "set @a = 1, session sql_mode = 'ANSI'" and "allowMultiQueries" not in options
    assert JdbcSource.server("postgres", init=two).options()["sessionInitStatement"].count(";") == 1
    assert "sessionInitStatement" not in JdbcSource.server("postgres", init=two[2:]).options()
    for source in (JdbcSource(url=DERBY.url, init=two), JdbcSource.server("mysql", init=("set names utf8", "use shop"))):
        with pytest.raises(ValueError, match="takes one statement"):
            source.options()


def test_unix_sockets():
    options = JdbcSource.server("mysql", "shop", socket="/run/mysqld.sock").options()
    assert options["junixsocket.file"] == "/run/mysqld.sock" and "socketFactory" in options
    assert JdbcSource.server("postgres", socket="/run/pg").options()["socketFactoryArg"] == "/run/pg"


def test_a_query_timeout_acts(spark, engine):
    """Derby looks at the clock between rows, so a join of many rows is cut off."""
    fill(engine, spark, "slow", spark.range(3000))
    slow = 'select count(*) as n from slow a join slow b on a."id" <> b."id" join slow c on b."id" <> c."id"'
    with pytest.raises(Exception, match="(?i)timeout|timed out|XCL52"):
        read_jdbc(spark, JdbcSource(url=DERBY.url, driver=DERBY.driver, timeout=1), slow).collect()
