"""Sources over whole tables: query text, JDBC, folders of SQLite files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.engine import Engine
from rowferry.operators.catalog import sqlite_catalog_described
from rowferry.plans.tables import load
from rowferry.sinks.export import export
from rowferry.sources.jdbc import JdbcSource
from rowferry.sources.query import scratch_path
from rowferry.sources.sqlite import count_sqlite, read_sqlite, sqlite_catalog, storage_classes

FILE_SQL = """
select n_name, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by n_name
"""


def src_query_file(spark, sf):
    engine = Engine(spark)
    engine.register_tables(sf, ("orders", "customer", "nation"))
    path = scratch_path(spark, "query")
    spark.createDataFrame([(FILE_SQL,)], "value string").coalesce(1).write.text(path)
    return engine.query(sql_file=path)


def src_init(spark, sf):
    engine = Engine(spark)
    engine.register_tables(sf, ("events",))
    init = ["create or replace temporary view clicks as select * from events where event_type = 'click'"]
    return engine.query("select user_id, count(*) as clicks from clicks group by user_id", init=init)


def src_count(spark, sf):
    return Engine(spark).count(load(spark, sf, "lineitem"))


def database(spark) -> JdbcSource:
    """The database for the JDBC queries: ``spark.rowferry.jdbc.url``, else one in memory.

    A database in the memory of this process is out of reach for executors elsewhere, so it
    serves local sessions only.
    """
    url = spark.conf.get("spark.rowferry.jdbc.url", None)
    if url is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.rowferry.jdbc.url to a database all executors reach")
        url = "jdbc:derby:memory:rowferry;create=true"
    # other sources than Derby name their driver by their URL
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver" if ":derby:" in url else None
    return JdbcSource(url=url, driver=driver)


def _load_table(spark, sf, name, table, **options):
    source = database(spark)
    properties = {"driver": source.driver} if source.driver else {}
    rows = load(spark, sf, name)
    export(rows, "table", url=source.url, table=table, properties=properties, **options)
    return source


ORDERS_SQL = (
    'select "o_orderkey" as orderkey, "o_custkey" as custkey, "o_totalprice" as totalprice, '
    '"o_orderdate" as orderdate, "o_orderstatus" as orderstatus from orders_in'
)


def src_jdbc_partitioned(spark, sf):
    source = _load_table(spark, sf, "orders", "orders_in")
    rows = Engine(spark).read(
        "jdbc", ORDERS_SQL, source=source, partition_column="orderkey", partitions=4)
    return rows.toDF(*[c.lower() for c in rows.columns])


def src_jdbc_predicates(spark, sf):
    """Split by a modulus of the key, for keys that ranges would split unevenly."""
    source = _load_table(spark, sf, "customer", "customer_in")
    sql = 'select "c_custkey" as custkey, "c_name" as name, "c_acctbal" as acctbal from customer_in'
    predicates = [f"mod(custkey, 4) = {i}" for i in range(4)]
    rows = Engine(spark).read("jdbc", sql, source=source, predicates=predicates)
    return rows.toDF(*[c.lower() for c in rows.columns])


def src_jdbc_count(spark, sf):
    source = _load_table(spark, sf, "supplier", "supplier_in")
    rows = Engine(spark).count(source=source, sql='select * from supplier_in')
    return rows.toDF("n")


def _fleet(spark, sf, name, columns=("*",)):
    path = scratch_path(spark, "fleet")
    export(load(spark, sf, name).select(*columns), "sqlite", path, max_rows_per_file=5000)
    return path


def src_sqlite_fleet(spark, sf):
    return read_sqlite(spark, _fleet(spark, sf, "orders"), table="data")


def src_sqlite_split(spark, sf):
    """Every file read by several tasks, by row id."""
    return read_sqlite(spark, _fleet(spark, sf, "customer"), table="data", split_bytes=8192)


def src_sqlite_view(spark, sf):
    """A view has no row ids, so however large the file is, one task reads it."""
    view = "create temp view rich as select c_custkey, c_name, c_acctbal from data where c_acctbal > 0"
    return read_sqlite(spark, _fleet(spark, sf, "customer"), table="rich", init=[view], split_bytes=8192)


def src_sqlite_filter(spark, sf):
    """Filters that SQLite evaluates, on the parts of files cut by row id."""
    filters = [("o_custkey", ">", 10), ("o_orderstatus", "in", ["F", "O"]), ("o_totalprice", "<", 150000.0),
               ("o_orderpriority", "starts with", "1"), ("o_orderdate", "is not null")]
    return read_sqlite(spark, _fleet(spark, sf, "orders"), table="data", split_bytes=65536, filters=filters)


def src_sqlite_count(spark, sf):
    return count_sqlite(spark, _fleet(spark, sf, "orders"), table="data", split_bytes=65536)


def src_sqlite_query(spark, sf):
    sql = "select event_id, upper(event_type) as kind, value from data where value > 20"
    return Engine(spark).read("sqlite", sql, path=_fleet(spark, sf, "events"))


def typ_sqlite_infer(spark, sf):
    """Files that disagree about a column's storage class: the fleet's type fits all."""
    events = load(spark, sf, "events")
    path = scratch_path(spark, "mixed")
    whole = events.where("event_type = 'click'").select(
        "event_id", F.floor("value").alias("amount"), F.col("user_id").alias("label"),
        F.encode("event_type", "UTF-8").alias("raw"), F.unhex(F.lit("FF")).alias("bytes"))
    real = events.where("event_type <> 'click'").select(
        "event_id", F.col("value").alias("amount"), F.col("event_type").alias("label"),
        F.encode("event_type", "UTF-8").alias("raw"), F.encode("props", "UTF-8").alias("bytes"))
    export(whole, "sqlite", path)
    export(real, "sqlite", path, mode="append")
    found = storage_classes(spark, path, table="data").select("column_name", "spark_type")
    rows = read_sqlite(spark, path, table="data")
    seen = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    counts = seen.unpivot([], rows.columns, "column_name", "n")
    return found.join(counts, "column_name")


def cat_sqlite(spark, sf):
    rows = sqlite_catalog_described(sqlite_catalog(spark, _fleet(spark, sf, "lineitem")))
    return rows.select("table_name", "ordinal", "column_name", "description").distinct()


QUERIES = {
    f.__name__: f
    for f in (
        src_query_file, src_init, src_count, src_jdbc_partitioned, src_jdbc_predicates,
        src_jdbc_count, src_sqlite_fleet, src_sqlite_split, src_sqlite_filter, src_sqlite_view, src_sqlite_count,
        src_sqlite_query, typ_sqlite_infer,
        cat_sqlite,
    )
}

ORACLES = {
    "src_query_file": FILE_SQL,
    "src_init": """
        select user_id, count(*) as clicks from events where event_type = 'click'
        group by user_id""",
    "src_count": "select count(*) as n from lineitem",
    "src_jdbc_partitioned": """
        select o_orderkey as orderkey, o_custkey as custkey, o_totalprice as totalprice,
               o_orderdate as orderdate, o_orderstatus as orderstatus from orders""",
    "src_jdbc_predicates": """
        select c_custkey as custkey, c_name as name, c_acctbal as acctbal from customer""",
    "src_jdbc_count": "select count(*) as n from supplier",
    "src_sqlite_fleet": """
        select * replace (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate) from orders""",
    "src_sqlite_split": "select * replace (c_nationkey::bigint as c_nationkey) from customer",
    "src_sqlite_filter": """
        select * replace (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate) from orders
        where o_custkey > 10 and o_orderstatus in ('F', 'O') and o_totalprice < 150000 and o_orderpriority like '1%'""",
    "src_sqlite_view": "select c_custkey, c_name, c_acctbal from customer where c_acctbal > 0",
    "src_sqlite_count": "select count(*) as n from orders",
    "src_sqlite_query": """
        select event_id, upper(event_type) as kind, value from events where value > 20""",
    "typ_sqlite_infer": """
        select column_name, spark_type, (select count(*) from events) as n from (values
          ('event_id', 'bigint'), ('amount', 'double'), ('label', 'string'), ('raw', 'string'),
          ('bytes', 'binary')) t(column_name, spark_type)""",
    "cat_sqlite": """
        select 'data' as table_name, ordinal, column_name, '(' || kind || ')' as description
        from (values (0, 'l_orderkey', 'INTEGER'), (1, 'l_partkey', 'INTEGER'),
          (2, 'l_suppkey', 'INTEGER'), (3, 'l_linenumber', 'INTEGER'), (4, 'l_quantity', 'float'),
          (5, 'l_extendedprice', 'float'), (6, 'l_discount', 'float'), (7, 'l_tax', 'float'),
          (8, 'l_returnflag', 'TEXT'), (9, 'l_linestatus', 'TEXT'), (10, 'l_shipdate', 'datetime'))
          t(ordinal, column_name, kind)""",
}
