"""JSON values and objects as text."""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F, types as T

from rowferry.functions.cellvalue import nullable_text

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.TimestampType)


def json_value(c: Column, dtype: T.DataType, truncate: int | None = None) -> Column:
    """One cell as JSON: numbers and booleans bare, everything else a string, null ``null``."""
    text = nullable_text(c, dtype, truncate)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        finite = F.abs(c) < float("inf")
        return F.coalesce(F.when(finite & ~F.isnan(c), text), F.lit("null"))
    if isinstance(dtype, (*NUMBERS, T.BooleanType)):
        return F.coalesce(text, F.lit("null"))
    # to_json quotes a string only inside an array; the brackets come off again.
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


def json_object(
    fields: list[tuple[str, Column, T.DataType]],
    truncate: int | None = None,
    compact: bool = False,
    indent: int = 4,
) -> Column:
    """A flat record as one JSON object."""
    names = [name for name, _, _ in fields]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"JSON needs distinct column names; rename: {', '.join(twice)}")
    lead, colon, between = ("", ":", ",") if compact else (" " * indent, ": ", ",\n")
    parts = [
        F.concat(
            F.lit(lead + json.dumps(name, ensure_ascii=False) + colon),
            json_value(c, dtype, truncate),
        )
        for name, c, dtype in fields
    ]
    if not parts:
        return F.lit("{}")
    body = F.concat_ws(between, *parts)
    if compact:
        return F.concat(F.lit("{"), body, F.lit("}"))
    return F.concat(F.lit("{\n"), body, F.lit("\n}"))
