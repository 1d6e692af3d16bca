"""A database table over JDBC that holds every row once, whatever tasks are repeated.

Spark inserts a partition in one transaction, but a task whose commit went through and whose report was lost is run
again and would insert again. So tasks fill a staging table, each row marked with its partition and the attempt
that wrote it. Every attempt that can be seen there is whole, and the statement that fills the table takes
one attempt of each partition. It is one transaction: the table gets all rows or none.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from rowferry.sinks.columns import free_name
from rowferry.sources.jdbc import connection, execute


def _mark(batches, names: list[str]):
    context = TaskContext.get()
    for batch in batches:
        size = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.repeat(pa.scalar(context.partitionId(), pa.int32()), size),
             pa.repeat(pa.scalar(context.taskAttemptId(), pa.int64()), size)], names=names)


def marked(rows: DataFrame) -> tuple[DataFrame, str, str]:
    """``rows`` with the partition and attempt that computed each, and the names of these columns."""
    part, attempt = free_name(rows, "part_no"), free_name(rows, "attempt_no")
    schema = StructType([*rows.schema.fields, StructField(part, IntegerType()), StructField(attempt, LongType())])
    names = schema.names

    def run(batches):
        return _mark(batches, names)

    return rows.mapInArrow(run, schema), part, attempt


def write_table(rows: DataFrame, table: str, options: dict[str, str], mode: str, column_types: str | None = None,
                connections: int | None = None) -> None:
    """Write ``rows``; ``overwrite`` replaces the table, ``append`` adds to it or creates it."""
    spark = rows.sparkSession
    staging = _beside(table, f"_staging_{uuid.uuid4().hex[:8]}")
    types = {"createTableColumnTypes": column_types} if column_types else {}
    if connections:
        rows = rows.coalesce(connections)
    staged, part, attempt = marked(rows)
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(options["url"]).quoteIdentifier
    columns = ", ".join(quote(f) for f in rows.columns)
    wanted = ", ".join(f"s.{quote(f)}" for f in rows.columns)
    one = f"select {quote(part)} as p, min({quote(attempt)}) as a from {staging} group by {quote(part)}"
    login = {k: v for k, v in options.items() if k not in ("batchsize", "isolationLevel")}
    try:
        staged.write.format("jdbc").mode("overwrite").options(dbtable=staging, **options, **types).save()
        # Spark makes the table, as only it knows the database's types; the rows stay inside the database
        empty = spark.createDataFrame([], rows.schema)
        empty.write.format("jdbc").mode(mode).options(dbtable=table, **options, **types).save()
        with connection(spark, login) as opened:
            opened.setAutoCommit(False)
            try:
                execute(opened, f"insert into {table} ({columns}) select {wanted} from {staging} s "
                                f"join ({one}) k on s.{quote(part)} = k.p and s.{quote(attempt)} = k.a")
                opened.commit()
            except BaseException:
                opened.rollback()
                raise
    finally:
        _drop(spark, login, staging)


def _beside(table: str, ending: str) -> str:
    """A name in the same schema; the last part may be quoted."""
    return table[:-1] + ending + table[-1] if table[-1] in "\"`]" else table + ending


def _drop(spark, login: dict[str, str], table: str) -> None:
    try:
        with connection(spark, login) as opened:
            execute(opened, f"drop table {table}")
    except Exception:
        # the export's own error is the one to show, and the table may never have been made
        pass
