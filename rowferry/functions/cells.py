"""Spreadsheet cells: a kind, a number and a text per value."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F, types as T

from rowferry.functions.cellvalue import is_time, nullable_text
from rowferry.functions.numbers import float_text
from rowferry.functions.temporal import epoch_seconds, time_text
from rowferry.functions.text import truncate_with_note

# Fixed values of the sheet formats: days from 1899-12-30 to 1970-01-01, the largest
# integer a double holds exactly, the longest text of one cell.
EPOCH_SERIAL = 25569
EXACT_INTEGER = 2**53
LONGEST_TEXT = 32767


class Choice(NamedTuple):
    """One way to write a cell; the first whose condition holds (or that has none) applies."""

    condition: Column | None
    kind: str
    number: Column | None
    text: Column
    digits: bool = False  # the text holds nothing to escape


class Staged(NamedTuple):
    """A cell's value brought to a number, a boolean or text, and what it stands for."""

    value: Column
    dtype: T.DataType
    kind: str


STRING, DOUBLE = T.StringType(), T.DoubleType()
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DoubleType, T.FloatType)


def _serial(days: Column) -> Column:
    """Serial numbers count a 29 February 1900 that never was, and begin with 1 January 1900."""
    early = F.raise_error(F.lit("a workbook holds no dates before 1900"))
    return F.when(days < 2, early).when(days < 61, days - 1).otherwise(days)


def stage_xlsx(c: Column, dtype: T.DataType, truncate: int | None = None) -> Staged:
    """Cell of a workbook whose dates and times are serial day numbers."""
    if isinstance(dtype, T.BinaryType):
        return Staged(truncate_with_note(nullable_text(c, dtype), truncate), STRING, "text")
    if isinstance(dtype, T.DateType):
        return Staged(_serial(F.unix_date(c) + EPOCH_SERIAL), T.IntegerType(), "date")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        zoned = isinstance(dtype, T.TimestampType)
        seconds = F.unix_seconds(c) if zoned else epoch_seconds(c)
        return Staged(_serial(seconds / F.lit(86400.0) + EPOCH_SERIAL), DOUBLE, "datetime")
    if is_time(dtype):
        clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))
        return Staged(clock / F.lit(86400.0), DOUBLE, "time")
    return _stage(c, dtype, truncate)


def stage_ods(c: Column, dtype: T.DataType, truncate: int | None = None) -> Staged:
    """Cell of an open document sheet: dates are midnights, times of day are text."""
    if isinstance(dtype, T.BinaryType):
        return Staged(nullable_text(c, dtype), STRING, "text")
    if isinstance(dtype, T.DateType):
        return Staged(F.concat(c.cast("string"), F.lit("T00:00:00")), STRING, "datetime")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        if isinstance(dtype, T.TimestampType):
            zero = F.lit(0)
            since = F.make_dt_interval(zero, zero, zero, F.unix_seconds(c))
            c = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + since
        stamp = F.replace(F.substring_index(c.cast("string"), ".", 1), F.lit(" "), F.lit("T"))
        return Staged(stamp, STRING, "datetime")
    if is_time(dtype):
        return Staged(time_text(c), STRING, "text")
    return _stage(c, dtype, truncate)


def _stage(c: Column, dtype: T.DataType, truncate: int | None) -> Staged:
    if isinstance(dtype, NUMBERS):
        return Staged(c, dtype, "number")
    if isinstance(dtype, T.BooleanType):
        return Staged(c, dtype, "boolean")
    if isinstance(dtype, T.StringType):
        return Staged(truncate_with_note(c, truncate), STRING, "text")
    if isinstance(dtype, T.NullType):
        return Staged(c.cast("string"), STRING, "text")
    raise TypeError(f"unsupported column type: {dtype.simpleString()}")


def choices_of(c: Column, dtype: T.DataType, kind: str) -> list[Choice]:
    """The ways to write a staged value; what a double cannot hold becomes text."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        number = c.cast("double")
        finite = ~F.isnan(c) & (F.abs(c) < float("inf"))
        word = F.replace(c.cast("string"), F.lit("Infinity"), F.lit("inf"))
        return [
            Choice(finite, kind, number, float_text(number), True),
            Choice(None, "text", None, word, True),
        ]
    if isinstance(dtype, (T.LongType, T.DecimalType)):
        fits, text = c.between(-EXACT_INTEGER, EXACT_INTEGER), c.cast("string")
        return [
            Choice(fits, kind, c.cast("double"), text, True), Choice(None, "text", None, text, True)
        ]
    if isinstance(dtype, T.BooleanType):
        return [Choice(None, kind, c.cast("int").cast("double"), c.cast("string"), True)]
    if isinstance(dtype, T.StringType):
        return [Choice(None, kind, None, c)]
    return [Choice(None, kind, c.cast("double"), c.cast("string"), True)]


def choose(c: Column, choices: list[Choice], write, empty: Column) -> Column:
    """``write(choice)`` of the choice that applies, ``empty`` for null."""
    result = F.when(c.isNull(), empty)
    for choice in choices[:-1]:
        result = result.when(choice.condition, write(choice))
    return result.otherwise(write(choices[-1]))


def _struct(kind: str, number: Column | None, text: Column | None) -> Column:
    number = F.lit(None).cast("double") if number is None else number
    text = F.lit(None).cast("string") if text is None else text
    return F.struct(F.lit(kind).alias("kind"), number.alias("num"), text.alias("text"))


def _cell(staged: Staged) -> Column:
    def write(choice: Choice) -> Column:
        text = choice.text if choice.number is None else None
        return _struct(choice.kind, choice.number, text)

    return choose(staged.value, choices_of(*staged), write, _struct("text", None, F.lit("")))


def xlsx_cell(c: Column, dtype: T.DataType, truncate: int | None = None) -> Column:
    """(kind, num, text) of an XLSX cell."""
    return _cell(stage_xlsx(c, dtype, truncate))


def ods_cell(c: Column, dtype: T.DataType, truncate: int | None = None) -> Column:
    """(kind, num, text) of an ODS cell."""
    return _cell(stage_ods(c, dtype, truncate))
