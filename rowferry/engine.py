"""The one object a user holds: read, describe, count, search and export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowferry.operators import catalog as cat
from rowferry.operators import hierarchy
from rowferry.operators.normalise import describe, normalise, text_if_utf8
from rowferry.sinks.export import ExportReport, export
from rowferry.sinks.files import result_files
from rowferry.sources import jdbc, query, sqlite


def _lower_names(df: DataFrame) -> DataFrame:
    """MySQL 8 names its catalog columns in upper case."""
    return df.toDF(*[name.lower() for name in df.columns])


class Engine:
    """Facade over one Spark session."""

    KINDS = ("spark", "sqlite", "jdbc", "mysql", "postgres")

    def __init__(self, spark: SparkSession):
        """Sets ``spark.sql.codegen.hugeMethodLimit`` of the session to 8000, the JVM's own limit for
        compiling a method: longer ones, as rendering many columns makes, would run interpreted."""
        self.spark = spark
        if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")

    # --- sources ----------------------------------------------------------------------------

    def register_tables(self, folder: str, names: Iterable[str] | None = None) -> list[str]:
        return query.register_tables(self.spark, folder, names)

    def query(self, sql=None, sql_file=None, init: Iterable[str] = ()) -> DataFrame:
        return query.run_query(self.spark, sql, sql_file, init)

    def read(self, kind: str, sql: str | None = None, sql_file: str | None = None, **options):
        """Result of a query in any kind of source, brought to the common types.

        ``jdbc``, ``mysql`` and ``postgres`` take ``source`` (a JdbcSource) or the arguments of
        ``JdbcSource``/``JdbcSource.server``, and the splitting arguments of ``read_jdbc``. With
        ``utf8_text`` binary columns whose every value is UTF-8 become text, at the cost of a first pass.
        ``sqlite`` takes ``path`` and the arguments of ``read_sqlite``.
        """
        if kind not in self.KINDS:
            raise ValueError(f"unknown source kind {kind!r}; known: {', '.join(self.KINDS)}")
        if kind == "spark":
            return self.query(sql, sql_file, options.get("init", ()))
        if kind == "sqlite":
            if "table" not in options:
                options["query"] = query.query_text(self.spark, sql, sql_file)
            return normalise(sqlite.read_sqlite(self.spark, **options), "sqlite")
        text = query.query_text(self.spark, sql, sql_file)
        splits = {
            name: options.pop(name)
            for name in ("partition_column", "partitions", "bounds", "predicates", "split_by")
            if name in options
        }
        utf8_text = options.pop("utf8_text", False)
        rows = jdbc.read_jdbc(self.spark, self._source(kind, options), text, **splits)
        rows = rows if kind == "jdbc" else normalise(rows, kind)
        return text_if_utf8(rows, rows.columns) if utf8_text else rows

    def _source(self, kind: str, options: dict) -> jdbc.JdbcSource:
        if "source" in options:
            return options["source"]
        if kind == "jdbc":
            return jdbc.JdbcSource(**options)
        return jdbc.JdbcSource.server(kind, **options)

    def count(self, df: DataFrame | None = None, source: jdbc.JdbcSource | None = None,
              sql: str | None = None) -> DataFrame:
        """One row ``n``: counted by the database for a JDBC source, by Spark otherwise."""
        if source is not None:
            return jdbc.count_jdbc(self.spark, source, query.query_text(self.spark, sql))
        rows = df if df is not None else self.query(sql)
        return rows.agg(F.count(F.lit(1)).alias("n"))

    def describe(self, df: DataFrame) -> DataFrame:
        return describe(df)

    # --- sinks ------------------------------------------------------------------------------

    def export(self, df: DataFrame, fmt: str, path: str | None = None, **options) -> ExportReport:
        return export(df, fmt, path, **options)

    def files(self, path: str) -> list[str]:
        """The files of an export, for Spark's readers while other jobs write into the folder."""
        return result_files(self.spark, path)

    # --- catalogs and hierarchies -------------------------------------------------------------

    def catalog(self, kind: str = "spark", **options) -> DataFrame:
        """Tables and columns: of this session, of SQLite files, or of catalog frames."""
        if kind == "spark":
            return cat.spark_catalog(self.spark, options.get("database"))
        if kind == "sqlite":
            return cat.sqlite_catalog_described(sqlite.sqlite_catalog(self.spark, options["path"]))
        if kind not in ("mysql", "postgres"):
            raise ValueError(f"unknown catalog kind {kind!r}")
        # a PostgreSQL session sees the catalog of its own database only
        source = self._source(kind, {k: v for k, v in options.items() if k != "database" or kind == "postgres"})
        tables, columns = (
            _lower_names(jdbc.read_jdbc(self.spark, source, f"select * from information_schema.{t}"))
            for t in ("tables", "columns")
        )
        build = cat.mysql_catalog if kind == "mysql" else cat.postgres_catalog
        return build(tables, columns, options.get("database"))

    def tree(self, df: DataFrame, levels: list[hierarchy.Level], query: str | None = None,
             regex: bool = False, upper: DataFrame | None = None) -> DataFrame:
        """Nodes of the hierarchy, all or those matching with their ancestors."""
        if query is None:
            return hierarchy.build_tree(df, levels, upper)
        return hierarchy.search_tree(df, levels, query, regex, upper)

    def listing(self, nodes: DataFrame) -> DataFrame:
        return hierarchy.list_tree(nodes)
