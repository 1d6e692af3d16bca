"""Query text, registered tables and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from rowferry.sinks.files import list_files, open_path, qualify


def query_text(spark: SparkSession, sql: str | None = None, sql_file: str | None = None) -> str:
    """The inline text if given, else the file's; the file may lie on any Hadoop path."""
    if sql is not None:
        return sql
    if sql_file is None:
        raise ValueError("no query: give sql or sql_file")
    return spark.read.text(sql_file, wholetext=True).first()[0]


def run_query(
    spark: SparkSession,
    sql: str | None = None,
    sql_file: str | None = None,
    init: Iterable[str] = (),
) -> DataFrame:
    """Run the init statements, then the query, over registered tables."""
    text = query_text(spark, sql, sql_file)
    for statement in init:
        try:
            spark.sql(statement)
        except Exception as error:
            raise RuntimeError(f"the init statement failed:\n{statement}\n{error}") from error
    return spark.sql(text)


def register_tables(
    spark: SparkSession, folder: str, names: Iterable[str] | None = None
) -> list[str]:
    """A temporary view per Parquet table below ``folder``."""
    if names is None:
        full = qualify(spark, folder)
        names = sorted({
            inside.split("/")[0].removesuffix(".parquet")
            for path, _ in list_files(full)
            if ".parquet" in (inside := path[len(open_path(full)[1].rstrip("/")):].strip("/"))
        })
    names = list(names)
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return names


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a session without that setting and without executors of its own uses a temporary
    folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="rowferry-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")
