"""Frames with safe column names, so that any header text can be exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

Field = tuple[str, Column, T.DataType]


def fields_of(df: DataFrame) -> tuple[DataFrame, list[Field]]:
    """The frame with positional names, and (original name, column, type) per column."""
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    fields = [(f.name, F.col(f"c{i}"), f.dataType) for i, f in enumerate(df.schema.fields)]
    return safe, fields


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in name order, as one projection."""
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return safe.select(*[F.col(f"c{i}") for i in order]).toDF(*[df.columns[i] for i in order])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underlined until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"{name}_"
    return name
