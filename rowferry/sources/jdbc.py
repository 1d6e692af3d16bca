"""Databases over JDBC, read by many sessions at once.

The SQL text goes to the database unchanged, as a subquery; Spark adds the filters, the
pruned columns and one part of the rows per task. N partitions are N database
snapshots, and an ORDER BY inside the query does not survive; export with ``order_by``.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from rowferry.sources.jdbc_splits import even_predicates

# Default ports of the two servers, rows per fetch, driver settings. Without a
# cursor the MySQL driver would hold a whole partition in memory; the other two settings keep
# small integers and years numeric.
PORTS = {"mysql": 3306, "postgres": 5432}
FETCH_ROWS = 500
DRIVER_SETTINGS = {
    "mysql": {"useCursorFetch": "true", "tinyInt1isBit": "false", "yearIsDateType": "false"},
    "postgres": {},
}
# Socket factories of the junixsocket library, which must be on the class path.
SOCKETS = {
    "mysql": lambda path: {"socketFactory": "org.newsclub.net.mysql.AFUNIXDatabaseSocketFactory", "junixsocket.file": path},
    "postgres": lambda path: {"socketFactory": "org.newsclub.net.unix.AFUNIXSocketFactory$FactoryArg", "socketFactoryArg": path},
}
# Statements that act on their session alone; others act on the database and run once.
SESSION = re.compile(r"\s*(set|use|pragma|alter\s+session|create\s+(local\s+)?(temp|temporary)|declare\s+global\s+temporary)\b", re.I)
ASSIGNMENT = re.compile(r"\s*set\s+((?:session\s+)?[@\w.]+\s*:?=.*)", re.I | re.S)


@dataclass(frozen=True)
class JdbcSource:
    """How to reach one database, and the statements to run before reading.

    Of ``init`` those that act on a session (``set``, temporary tables and the like) run in every session of the
    read, the others once, before it. All are run in turn on a connection of the driver first, so one
    that fails is named before any task starts.
    """

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    init: tuple[str, ...] = ()
    timeout: int | None = None
    fetch_size: int = FETCH_ROWS
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def server(
        cls, kind: str, database: str = "", host: str = "localhost", port: int | None = None,
        timeout: int | None = None, socket: str | None = None, **rest,
    ) -> JdbcSource:
        """A MySQL or PostgreSQL server, over TCP or a Unix ``socket``; its driver jar must be on the class path."""
        scheme = {"mysql": "mysql", "postgres": "postgresql"}[kind]
        properties = {**DRIVER_SETTINGS[kind], **rest.pop("properties", {})}
        if socket is not None:
            properties = {**SOCKETS[kind](socket), **properties}
        if timeout is not None:
            limits = (
                {"connectTimeout": timeout * 1000, "socketTimeout": timeout * 1000}
                if kind == "mysql"
                else {"connectTimeout": timeout, "socketTimeout": timeout}
            )
            properties = {**{k: str(v) for k, v in limits.items()}, **properties}
        url = f"jdbc:{scheme}://{host}:{port or PORTS[kind]}/{database}"
        return cls(url=url, timeout=timeout, properties=properties, **rest)

    def options(self) -> dict[str, str]:
        options = {
            "url": self.url, "fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true",
            **self.properties,
        }
        for name, value in (("user", self.user), ("password", self.password),
                            ("driver", self.driver)):
            if value is not None:
                options[name] = value
        if session := self.session_statement():
            options["sessionInitStatement"] = session
        if self.timeout is not None:
            options["queryTimeout"] = str(self.timeout)
        return options

    def session_statement(self) -> str | None:
        """The statement that opens each session. Spark runs one; several are joined where that is one statement
        for the database, which never means letting the driver take stacked statements."""
        session = [s.strip().rstrip(";") for s in self.init if SESSION.match(s)]
        if len(session) < 2:
            return session[0] if session else None
        if self.url.startswith("jdbc:postgresql:"):  # this driver runs the parts of a statement one by one
            return ";\n".join(session)
        if all(ASSIGNMENT.match(s) for s in session) and self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
            return "set " + ", ".join(ASSIGNMENT.match(s)[1] for s in session)
        raise ValueError(
            "a session of this database takes one statement; put several into a procedure and call it: " + "; ".join(session))


@contextmanager
def connection(spark: SparkSession, options: dict[str, str]):
    """A connection of the driver's JVM with the settings of a read or write."""
    jvm, options = spark._jvm, dict(options)
    url, name = options.pop("url"), options.pop("driver", None)
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, value)
    if name is None:
        opened = jvm.java.sql.DriverManager.getConnection(url, properties)
    else:  # a class from an added jar is known to Spark's class loader only
        kind = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(name)
        none = spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)
        driver = kind.getDeclaredConstructor(none).newInstance(spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0))
        opened = driver.connect(url, properties)
    try:
        yield opened
    finally:
        opened.close()


def execute(opened, text: str, timeout: int | None = None) -> None:
    statement = opened.createStatement()
    try:
        if timeout is not None:
            statement.setQueryTimeout(timeout)
        statement.execute(text)
    finally:
        statement.close()


def run_init(spark: SparkSession, source: JdbcSource) -> None:
    """Run the init statements in turn on one session; the one that fails is named."""
    if not source.init:
        return
    options = {k: v for k, v in source.options().items() if k not in ("sessionInitStatement", "fetchsize", "queryTimeout")}
    with connection(spark, options) as opened:
        for statement in source.init:
            try:
                execute(opened, statement.strip().rstrip(";"), source.timeout)
            except Py4JJavaError as error:
                raise RuntimeError(f"the init statement failed:\n{statement}\n{error.java_exception.getMessage()}") from error


def _reader(spark: SparkSession, source: JdbcSource, text: str, alias: str):
    text = text.strip().rstrip(";")
    options = {k: v for k, v in source.options().items() if v != ""}
    return spark.read.format("jdbc").options(**options).option("dbtable", f"({text}) {alias}")


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    sql: str,
    partition_column: str | None = None,
    partitions: int | None = None,
    bounds: tuple | None = None,
    predicates: list[str] | None = None,
    split_by: list[str] | None = None,
) -> DataFrame:
    """The query's result, read by one task or by several.

    ``partitions`` alone splits into about so many parts of equal row counts: the database counts the rows
    per range of a whole-number column and parts are made from the counts, whatever the values' spread; a value that
    many rows share is split by the modulus of a second column. ``split_by`` names the columns, otherwise the
    result's whole-number columns are taken in order. That costs the database some grouped counts.

    With ``partition_column`` Spark reads equal ranges between ``bounds`` (or the column's minimum and maximum).
    With ``predicates`` each is a task; they must cover every row once. With none of these one task reads all.
    """
    run_init(spark, source)
    text = sql.strip().rstrip(";")
    if partitions and partitions > 1 and not partition_column and not predicates:
        predicates = _even(spark, source, text, partitions, split_by)
    if predicates:
        options = {k: v for k, v in source.options().items() if v != ""}
        url = options.pop("url")
        return spark.read.jdbc(url, f"({text}) q", predicates=predicates, properties=options)
    if partition_column and partitions is None:
        raise ValueError("partition_column needs partitions, the number of ranges")
    reader = _reader(spark, source, sql, "q")
    if partition_column and partitions > 1:
        if bounds is None:
            limits = f"select min({partition_column}) as lo, max({partition_column}) as hi"
            bounds = tuple(_reader(spark, source, f"{limits} from ({text}) q", "b").load().first())
        if None not in bounds:  # an empty result has no bounds and needs no split
            reader = reader.options(
                partitionColumn=partition_column, lowerBound=str(bounds[0]),
                upperBound=str(bounds[1]), numPartitions=str(partitions),
            )
    return reader.load()


def _even(spark, source: JdbcSource, text: str, partitions: int, split_by) -> list[str] | None:
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(source.url).quoteIdentifier
    columns = split_by
    if columns is None:
        kinds = ("bigint", "int", "smallint", "tinyint")
        columns = [name for name, kind in _reader(spark, source, text, "q").load().dtypes if kind in kinds]
    if not columns:
        raise ValueError("no whole-number column to split by: give partition_column, predicates or split_by")

    def ask(select: str) -> list[tuple]:
        return [tuple(row) for row in _reader(spark, source, select.replace("{rows}", f"({text})"), "h").load().collect()]

    return even_predicates(ask, [quote(c) for c in columns], partitions)


def count_jdbc(spark: SparkSession, source: JdbcSource, sql: str) -> DataFrame:
    """Row count of the query, counted by the database."""
    run_init(spark, source)
    text = sql.strip().rstrip(";")
    return _reader(spark, source, f"select count(*) as n from ({text}) q", "c").load()
