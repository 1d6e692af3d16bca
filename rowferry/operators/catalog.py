"""Database catalogs as frames: tables and their columns, ready for the hierarchy operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowferry.operators.hierarchy import Level
from rowferry.operators.joins import left_join_all

CATALOG_KEYS = ["table_schema", "table_name"]


def column_description(kind: Column, nullable: Column | None = None, key: Column | None = None) -> Column:
    """``(type[ NOT NULL][ PRIMARY KEY])``."""
    empty = F.lit("")
    required = empty if nullable is None else F.when(nullable, "").otherwise(" NOT NULL")
    primary = empty if key is None else F.when(key, " PRIMARY KEY").otherwise("")
    return F.concat(F.lit("("), kind, required, primary, F.lit(")"))


def _described(rows: DataFrame) -> DataFrame:
    nullable = F.col("is_nullable") != "NO"
    description = F.when(
        F.col("column_name").isNotNull(),
        column_description(F.col("column_type"), F.coalesce(nullable, F.lit(True))),
    )
    return rows.withColumn("description", description)


def mysql_catalog(tables: DataFrame, columns: DataFrame, database: str | None = None) -> DataFrame:
    """(table_schema, table_name, column_name, column_type, is_nullable, description).

    A table without columns has one row with nulls in their place.
    """
    if database is not None:
        tables = tables.where(F.col("table_schema") == database)
    rows = left_join_all(
        tables.select(*CATALOG_KEYS),
        columns.select(*CATALOG_KEYS, "column_name", "column_type", "is_nullable"),
        CATALOG_KEYS,
    )
    return _described(rows)


def postgres_catalog(
    tables: DataFrame, columns: DataFrame, database: str | None = None, schema: str = "public"
) -> DataFrame:
    """As ``mysql_catalog`` of one schema, led by table_catalog."""
    tables = tables.where(F.col("table_schema") == schema)
    if database is not None:
        tables = tables.where(F.col("table_catalog") == database)
    rows = left_join_all(
        tables.select("table_catalog", *CATALOG_KEYS),
        columns.select(*CATALOG_KEYS, "column_name", F.col("data_type").alias("column_type"),
                       "is_nullable"),
        CATALOG_KEYS,
    )
    return _described(rows)


def sqlite_catalog_described(rows: DataFrame) -> DataFrame:
    """Rows of ``sources.sqlite.sqlite_catalog`` with the description of each column."""
    description = column_description(
        F.col("column_type"), F.col("not_null") == 0, F.col("pk") >= 1
    )
    return rows.withColumn("description", description)


def spark_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and columns of the session's catalog in the layout of ``mysql_catalog``.

    Metadata only: its size is the number of columns of the registered tables.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        schema = ".".join(table.namespace or []) or "temporary"
        name = table.name if table.isTemporary else f"{schema}.{table.name}"
        for column in spark.catalog.listColumns(name):
            flag = "YES" if column.nullable else "NO"
            rows.append((schema, table.name, column.name, column.dataType, flag))
    kinds = ", ".join(f"{n} string" for n in (*CATALOG_KEYS, "column_name", "column_type", "is_nullable"))
    return _described(spark.createDataFrame(rows, kinds))


def schema_levels() -> list[Level]:
    """Levels of the MySQL layout."""
    return [Level("table_schema"), Level("table_name"), Level("column_name", "description")]


def database_levels() -> list[Level]:
    """Levels of the PostgreSQL layout."""
    return [Level("table_catalog"), *schema_levels()[1:]]


def file_levels() -> list[Level]:
    """Levels of the SQLite layout, columns in declared order."""
    return [Level("file"), Level("table_name"), Level("column_name", "description", "ordinal")]
