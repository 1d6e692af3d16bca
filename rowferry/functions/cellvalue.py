"""One cell of any supported type as text: the rule shared by the text-like sinks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowferry.functions.binary import escape_binary
from rowferry.functions.numbers import boolean_text, float_text, integer_text
from rowferry.functions.temporal import date_text, datetime_text, epoch_text, time_text
from rowferry.functions.text import truncate_with_note


def is_time(dtype: T.DataType) -> bool:
    return dtype.typeName() == "time"


def nullable_text(c: Column, dtype: T.DataType, truncate: int | None = None) -> Column:
    """Text of a cell, null staying null. Only strings are truncated."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return truncate_with_note(c, truncate)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return integer_text(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float_text(c, single=isinstance(dtype, T.FloatType))
    if isinstance(dtype, T.BooleanType):
        return boolean_text(c)
    if isinstance(dtype, T.BinaryType):
        return escape_binary(c)
    if isinstance(dtype, T.DateType):
        return date_text(c)
    if isinstance(dtype, T.TimestampNTZType):
        return datetime_text(c)
    if isinstance(dtype, T.TimestampType):
        return epoch_text(c)
    if is_time(dtype):
        return time_text(c)
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    raise TypeError(f"unsupported column type: {dtype.simpleString()}")


def cell_text(c: Column, dtype: T.DataType, truncate: int | None = None) -> Column:
    """Text of a cell, empty for null."""
    return F.coalesce(nullable_text(c, dtype, truncate), F.lit(""))
