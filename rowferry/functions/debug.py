"""Typed debug text of a cell, such as ``I64(5)`` or ``String("x")``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowferry.functions.cellvalue import is_time
from rowferry.functions.numbers import float_text
from rowferry.functions.temporal import epoch_text, time_text

UNSIGNED_64 = T.DecimalType(20, 0)

# Escapes inside a quoted string, backslash first.
QUOTED_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\t", "\\t"),
    ("\r", "\\r"),
    ("\n", "\\n"),
    ("\x00", "\\0"),
)


def unified_type(dtype: T.DataType) -> str:
    """Name of a Spark type in the common type set of all sources and sinks."""
    # The common type names.
    names = {
        T.LongType: "I64", T.IntegerType: "I32", T.ShortType: "I16", T.ByteType: "I8",
        T.DoubleType: "F64", T.FloatType: "F32", T.StringType: "String", T.CharType: "String",
        T.VarcharType: "String", T.BinaryType: "Bytes", T.BooleanType: "Bool",
        T.DateType: "Date", T.TimestampNTZType: "DateTime", T.TimestampType: "Timestamp",
        T.NullType: "None",
    }
    if dtype == UNSIGNED_64:
        return "U64"
    if isinstance(dtype, T.DecimalType):
        return "Decimal"
    if is_time(dtype):
        return "Time"
    name = names.get(type(dtype))
    return name if name else f"Custom({dtype.simpleString()})"


def debug_text(c: Column, dtype: T.DataType, plain: Column | None = None) -> Column:
    """``plain`` may give the ``float_text`` of a float column, if there is one already."""
    tag = unified_type(dtype)
    if tag == "None":
        return F.lit("None")
    if tag.startswith("Custom"):
        raise TypeError(f"unsupported column type: {dtype.simpleString()}")
    inner = F.concat(F.lit(tag + "("), _inner(c, dtype, tag, plain), F.lit(")"))
    return F.coalesce(inner, F.lit("None"))


def _inner(c: Column, dtype: T.DataType, tag: str, plain: Column | None) -> Column:
    if tag == "String":
        return _quoted(c)
    if tag in ("F64", "F32"):
        plain = float_text(c, single=tag == "F32") if plain is None else plain
        return _float_debug(c, plain)
    if tag == "Bytes":
        pairs = F.regexp_extract_all(F.hex(c), F.lit("(..)"), F.lit(1))
        numbers = F.transform(pairs, lambda h: F.conv(h, 16, 10))
        return F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]"))
    if tag == "DateTime":
        return F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
    if tag == "Timestamp":
        return epoch_text(c)
    if tag == "Time":
        return time_text(c)
    return c.cast("string")


def _float_debug(c: Column, plain: Column) -> Column:
    """Like ``float_text`` but whole numbers keep ``.0`` and far magnitudes an exponent."""
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    bare = F.ltrim(plain, F.lit("-"))
    large_digits = F.rtrim(bare, F.lit("0"))
    small_digits = F.ltrim(F.replace(bare, F.lit("0.")), F.lit("0"))

    def scientific(digits: Column, exponent: Column) -> Column:
        rest = F.substr(digits, F.lit(2))
        tail = F.when(F.length(digits) > 1, F.concat(F.lit("."), rest)).otherwise(F.lit(""))
        return F.concat(sign, F.left(digits, F.lit(1)), tail, F.lit("e"), exponent.cast("string"))

    small_exponent = F.length(small_digits) - F.length(bare) + 1
    return (
        F.when(F.isnan(c) | (F.abs(c) == float("inf")), plain)
        .when(F.abs(c) >= 1e16, scientific(large_digits, F.length(bare) - 1))
        .when((c != 0) & (F.abs(c) < 1e-5), scientific(small_digits, small_exponent))
        .when(F.contains(plain, F.lit(".")), plain)
        .otherwise(F.concat(plain, F.lit(".0")))
    )


def _quoted(c: Column) -> Column:
    text = c
    for char, escape in QUOTED_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(escape))
    # Unprintable characters, and a combining mark at the very start, become \u{hex}.
    unprintable = r"[\p{Cc}\p{Cf}\p{Cn}\p{Co}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"
    leading = r"^\p{M}"
    pieces = F.regexp_extract_all(
        text, F.lit(rf"(?:(?!{leading}|{unprintable})(?s:.))+|(?s:.)"), F.lit(0)
    )
    escaped = F.transform(
        pieces,
        lambda p, i: F.when(
            p.rlike(rf"^{unprintable}$") | ((i == 0) & p.rlike(rf"{leading}$")),
            F.concat(
                F.lit("\\u{"),
                F.lower(F.ltrim(F.hex(F.encode(p, "UTF-32")), F.lit("0"))),
                F.lit("}"),
            ),
        ).otherwise(p),
    )
    # plain ASCII, the usual case, skips the slow Unicode classes
    ascii_only = (F.octet_length(text) == F.length(text)) & ~text.rlike(r"[\x00-\x1f\x7f]")
    odd = ~ascii_only & text.rlike(f"{leading}|{unprintable}")
    text = F.when(odd, F.array_join(escaped, "")).otherwise(text)
    return F.concat(F.lit('"'), text, F.lit('"'))
