"""Type normalisation: one projection of casts per source or sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowferry.functions.cellvalue import is_time, nullable_text
from rowferry.functions.debug import UNSIGNED_64, unified_type
from rowferry.functions.temporal import to_second
from rowferry.functions.text import truncate_with_note

SMALL_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)
LARGEST_SIGNED = 2**63 - 1

# Column types of a created SQL table, per common type name.
TABLE_TYPES = {
    "U64": "integer", "I64": "integer", "I32": "integer", "I16": "integer", "I8": "integer",
    "String": "text", "Bytes": "blob", "F64": "float", "F32": "float", "Bool": "bool",
    "DateTime": "datetime", "Date": "date", "Time": "time", "Decimal": "numeric",
    "Timestamp": "datetime", "None": "text",
}


def _each(df: DataFrame, change) -> DataFrame:
    """Apply ``change(column, field)`` to all columns in one projection, names kept."""
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    cells = [change(F.col(f"c{i}"), f) for i, f in enumerate(df.schema.fields)]
    return safe.select(*[c.alias(f.name) for c, f in zip(cells, df.schema.fields)])


def normalise(df: DataFrame, dialect: str) -> DataFrame:
    """Bring a database's result to the common types.

    ``mysql``: every integer is 64 bit (unsigned 64 bit a decimal(20,0)), single floats are
    widened, datetimes and timestamps lose zone and fraction. ``postgres`` keeps widths.
    ``sqlite`` knows only 64 bit numbers. JDBC brings a time of day as a timestamp; it becomes
    a time where the session has that type, else text.
    """
    if dialect not in ("mysql", "postgres", "sqlite"):
        raise ValueError(f"unknown dialect {dialect!r}")
    wide = dialect in ("mysql", "sqlite")
    has_times = df.sparkSession.conf.get("spark.sql.timeType.enabled", "false") == "true"

    def change(c: Column, field: T.StructField) -> Column:
        dtype = field.dataType
        if field.metadata.get("logical_time_type"):
            return _time_of_day(c, has_times)
        if isinstance(dtype, SMALL_INTEGERS) and wide:
            return c.cast("bigint")
        if isinstance(dtype, T.FloatType) and wide:
            return c.cast("double")
        if isinstance(dtype, T.TimestampType):
            return to_second(c.cast("timestamp_ntz"))
        if isinstance(dtype, T.TimestampNTZType):
            return to_second(c)
        if is_time(dtype):
            return F.time_trunc(F.lit("SECOND"), c)
        if isinstance(dtype, T.NullType):
            return c.cast("string")
        return c

    return _each(df, change)


def _time_of_day(c: Column, has_times: bool) -> Column:
    c = c.cast("timestamp_ntz")
    if has_times:
        return F.make_time(F.hour(c), F.minute(c), F.floor(F.second(c)).cast("decimal(16,6)"))
    return F.substring(c.cast("string"), 12, 8)


def text_if_utf8(df: DataFrame, columns: list[str]) -> DataFrame:
    """Binary columns whose every value is valid UTF-8 become strings; the others stay.

    One aggregate row decides, as a column has one type.
    """
    names = [n for n in columns if isinstance(df.schema[n].dataType, T.BinaryType)]
    if not names:
        return df
    valid = [
        F.bool_and(F.is_valid_utf8(F.col(f"`{n}`").cast("string"))).alias(f"v{i}")
        for i, n in enumerate(names)
    ]
    found = df.select(*names).agg(*valid).first()
    texts = {n for n, ok in zip(names, found) if ok is not False}
    return df.withColumns({n: F.col(f"`{n}`").cast("string") for n in texts})


def utf8_text(c: Column) -> Column:
    """A binary cell as text, null where it is not valid UTF-8."""
    return F.try_validate_utf8(c.cast("string"))


def to_signed(c: Column) -> Column:
    """An unsigned 64 bit value as signed; what does not fit fails the job."""
    message = F.concat(F.lit("integer does not fit 64 signed bits: "), c.cast("string"))
    over = F.raise_error(message).cast("bigint")
    return F.when(F.abs(c) > LARGEST_SIGNED, over).otherwise(c.cast("bigint"))


def table_columns(
    df: DataFrame, truncate: int | None = None, temporal_text: bool = False
) -> DataFrame:
    """Columns as a SQL table takes them: integers signed, booleans 0 or 1, floats double.

    ``temporal_text`` writes dates and times as text, for files without such types.
    """

    def change(c: Column, field: T.StructField) -> Column:
        dtype = field.dataType
        if dtype == UNSIGNED_64:
            return to_signed(c)
        if isinstance(dtype, (*SMALL_INTEGERS, T.LongType)):
            return c.cast("bigint")
        if isinstance(dtype, T.BooleanType):
            return c.cast("int")
        if isinstance(dtype, T.FloatType):
            return c.cast("double")
        if isinstance(dtype, T.StringType):
            return truncate_with_note(c, truncate)
        if isinstance(dtype, T.NullType):
            return c.cast("string")
        if temporal_text and isinstance(dtype, T.DecimalType):
            return c.cast("string")
        if temporal_text and isinstance(dtype, T.TimestampType):
            return nullable_text(to_second(c.cast("timestamp_ntz")), T.TimestampNTZType())
        if temporal_text and (is_time(dtype) or isinstance(dtype, (T.DateType, T.TimestampNTZType))):
            return nullable_text(c, dtype)
        return c

    return _each(df, change)


def to_parquet_columns(df: DataFrame, truncate: int | None = None) -> DataFrame:
    """Columns as the Parquet sink stores them: strings cut, untyped nulls as strings."""

    def change(c: Column, field: T.StructField) -> Column:
        dtype = field.dataType
        if isinstance(dtype, T.StringType):
            return truncate_with_note(c, truncate)
        if isinstance(dtype, T.NullType):
            return c.cast("string")
        return c

    return _each(df, change)


def ddl_types(df: DataFrame) -> dict[str, str]:
    """SQL column type per column name."""
    types = {}
    for f in df.schema.fields:
        kind = unified_type(f.dataType)
        if kind not in TABLE_TYPES:
            raise TypeError(f"unsupported column type: {f.dataType.simpleString()}")
        types[f.name] = TABLE_TYPES[kind]
    return types


def describe(df: DataFrame) -> DataFrame:
    """(ordinal, name, unified_type, sql_type, nullable) per column; known before any job."""
    kinds = [unified_type(f.dataType) for f in df.schema.fields]
    rows = [
        (i, f.name, kind, TABLE_TYPES.get(kind), f.nullable)
        for i, (f, kind) in enumerate(zip(df.schema.fields, kinds), 1)
    ]
    schema = "ordinal int, name string, unified_type string, sql_type string, nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)
