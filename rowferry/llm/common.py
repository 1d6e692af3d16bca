"""Shared by the operators: word patterns, cutting lineage, binding a value in an expression."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowferry.sources.query import scratch_path

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def settle(df: DataFrame, label: str, large: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, safe from lost executors.

    After a ``large`` step the driver is asked to collect its garbage: Spark deletes shuffle files once
    no plan refers to them any more, but only notices then.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, label)
    df.write.parquet(path)
    if large:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underlined until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def discard(settled: DataFrame) -> None:
    """Delete the files of a settled table that no later step reads."""
    spark = settled.sparkSession
    files = settled.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spaced(text: Column) -> Column:
    """The text with every ASCII white space character as a space; plain replacing, no pattern."""
    for code in range(0x09, 0x0E):
        text = F.replace(text, F.lit(chr(code)), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    words = F.filter(F.split(spaced(text), " "), lambda word: word != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def fold(doc_id) -> Column:
    """The remainder that tells held-out rows (0) from the rows to learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
