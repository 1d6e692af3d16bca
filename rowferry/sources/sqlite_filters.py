"""Filters as conditions inside SQLite files, with Spark's meaning.

A filter is (column, operator, value), a list of them holds where all do. A cell of any storage class may sit in any
SQLite column, so a condition is exact only where the column's Spark type leaves no doubt: integers, and tests for
null. For texts, doubles and blobs the condition keeps every cell that the filter could keep once the cell is
converted, and Spark filters the rows again.

Filters are given with the read and not taken from ``where`` on its result. Spark 4.1 has a hook for the latter
(``DataSourceReader.pushFilters``), but it keeps the filters of the query planned last for every query
of the same frame: after ``df.where("k = 3").count()`` a ``df.count()`` counts the rows with k = 3.
"""

from __future__ import annotations

import base64
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, datasource as ds, functions as F, types as T

from rowferry.sinks.sqlitefile import quote

MOST_VALUES = 1000  # SQLite bounds the values of a statement; longer lists stay with Spark
COMPARISONS = {ds.EqualTo: "=", ds.EqualNullSafe: "is", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=",
               ds.LessThan: "<", ds.LessThanOrEqual: "<="}


@dataclass(frozen=True)
class Condition:
    """SQL with bound values, and whether it says just what the filter says.

    ``order`` marks comparisons by byte order, which only files in UTF-8 share with Spark."""

    sql: str
    values: tuple = ()
    exact: bool = False
    order: bool = False


# What a filter may say: the operators by name, and Spark's expression for each.
OPERATORS = {
    "=": (ds.EqualTo, lambda c, v: c == v), ">": (ds.GreaterThan, lambda c, v: c > v), "<": (ds.LessThan, lambda c, v: c < v),
    ">=": (ds.GreaterThanOrEqual, lambda c, v: c >= v), "<=": (ds.LessThanOrEqual, lambda c, v: c <= v),
    "<=>": (ds.EqualNullSafe, lambda c, v: c.eqNullSafe(v)), "in": (ds.In, lambda c, v: c.isin(*v)),
    "starts with": (ds.StringStartsWith, lambda c, v: c.startswith(v)),
    "ends with": (ds.StringEndsWith, lambda c, v: c.endswith(v)), "contains": (ds.StringContains, lambda c, v: c.contains(v)),
    "<>": (lambda c, v: ds.Not(ds.EqualTo(c, v)), lambda c, v: c != v),
    "not in": (lambda c, v: ds.Not(ds.In(c, v)), lambda c, v: ~c.isin(*v)),
    "is null": (lambda c, v: ds.IsNull(c), lambda c, v: c.isNull()),
    "is not null": (lambda c, v: ds.IsNotNull(c), lambda c, v: c.isNotNull()),
}


def normalised(filters) -> list[tuple]:
    """Filters as (column, operator, value), lists as tuples; unknown operators are refused."""
    out = []
    for column, operator, *value in filters:
        operator = operator.strip().lower()
        if operator not in OPERATORS:
            raise ValueError(f"unknown operator {operator!r}; known: {', '.join(OPERATORS)}")
        value = value[0] if value else None
        out.append((column, operator, tuple(value) if operator in ("in", "not in") else value))
    return out


def to_text(filters: list[tuple]) -> str:
    """Filters as an option of a read."""
    def plain(v):
        return {"bytes": base64.b64encode(v).decode()} if isinstance(v, (bytes, bytearray)) else v

    return json.dumps([(c, o, list(map(plain, v)) if isinstance(v, tuple) else plain(v)) for c, o, v in filters])


def from_text(text: str) -> list[tuple]:
    def value(v):
        return base64.b64decode(v["bytes"]) if isinstance(v, dict) else v

    return [(c, o, tuple(map(value, v)) if isinstance(v, list) else value(v)) for c, o, v in json.loads(text)]


def conditions(filters: list[tuple], schema: T.StructType) -> list[Condition | None]:
    return [condition(OPERATORS[o][0]((c,), v), schema) for c, o, v in filters]


def spark_filter(wanted: tuple) -> Column:
    column, operator, value = wanted
    return OPERATORS[operator][1](F.col(f"`{column.replace('`', '``')}`"), value)


def condition(wanted: ds.Filter, schema: T.StructType) -> Condition | None:
    """The condition for a filter, None where there is none."""
    inner = wanted.child if isinstance(wanted, ds.Not) else wanted
    found = _column(inner, schema)
    if found is None:
        return None
    name, dtype = found
    if isinstance(inner, ds.IsNull):
        return Condition(f"{name} is null", exact=True)
    if isinstance(inner, ds.IsNotNull):
        return Condition(f"{name} is not null", exact=True)
    negated = inner is not wanted
    if isinstance(dtype, T.LongType):
        return _integers(inner, name, negated)
    if isinstance(dtype, T.DoubleType):
        return _doubles(inner, name, negated)
    if isinstance(dtype, T.StringType):
        return _texts(inner, name, negated)
    if isinstance(dtype, T.BinaryType):
        return _blobs(inner, name, negated)
    return None


def _column(inner: ds.Filter, schema: T.StructType):
    path = getattr(inner, "attribute", ())
    known = {f.name: f.dataType for f in schema.fields}
    return (quote(path[0]), known[path[0]]) if len(path) == 1 and path[0] in known else None


def _values(inner: ds.Filter, kind) -> tuple | None:
    """The literals of a filter if all are of one kind; nulls in lists match nothing and are left out."""
    if isinstance(inner, ds.In):
        values = tuple(v for v in inner.value if v is not None)
        if len(values) < len(inner.value) and not values:
            return None
    else:
        values = (inner.value,)
    good = len(values) <= MOST_VALUES and all(
        isinstance(v, kind) and not isinstance(v, bool) and not (isinstance(v, int) and abs(v) >> 63) for v in values)
    return values if good else None


def _marks(values) -> str:
    return ", ".join("?" for _ in values)


def _integers(inner, name, negated):
    if isinstance(inner, ds.EqualNullSafe) and inner.value is None:
        return Condition(f"{name} is null", exact=True)
    values = _values(inner, int)
    if values is None:
        return None
    if isinstance(inner, ds.In):
        if negated and len(values) < len(inner.value):
            return None  # not in a list with a null is never true
        return Condition(f"{name} {'not ' if negated else ''}in ({_marks(values)})", values, exact=True)
    if type(inner) not in COMPARISONS:
        return None
    return Condition(f"{name} {'<>' if negated else COMPARISONS[type(inner)]} ?", values, exact=True)


def _doubles(inner, name, negated):
    """Integers beyond 2^53 and numbers written as text are converted before Spark compares them, so a
    comparison is made on the converted value and cells of other classes pass."""
    values = _values(inner, (int, float))
    if values is None or any(math.isnan(v) for v in values) or isinstance(inner, ds.EqualNullSafe):
        return None
    values = tuple(map(float, values))
    others = f"typeof({name}) in ('text', 'blob')"
    real = f"cast({name} as real)"
    if isinstance(inner, ds.In):
        if negated:
            return None
        return Condition(f"({real} in ({_marks(values)}) or {others})", values)
    if type(inner) not in COMPARISONS:
        return None
    # Spark counts a NaN above every number; SQLite holds none but in texts, which pass
    return Condition(f"({real} {'<>' if negated else COMPARISONS[type(inner)]} ? or {others})", values)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def _texts(inner, name, negated):
    if isinstance(inner, ds.EqualNullSafe):
        return None
    values = _values(inner, str)
    if values is None or any("\0" in v or not _encodes(v) for v in values):
        return None
    others = f"typeof({name}) <> 'text'"
    if isinstance(inner, (ds.EqualTo, ds.In)):
        if negated:
            return None if isinstance(inner, ds.In) else Condition(
                f"({name} <> ? collate binary or {others})", values)
        # A blob of the same bytes is the same text. Only texts that read as numbers can equal a numeric cell;
        # without these an index of the column can be used.
        both = (*values, *(v.encode() for v in values))
        equal = f"{name} collate binary in ({_marks(both)})"
        return Condition(f"({equal} or {others})" if any(map(_is_number, values)) else equal, both)
    if type(inner) in COMPARISONS:
        return Condition(f"({name} {COMPARISONS[type(inner)]} ? collate binary or {others})", values, order=True)
    if isinstance(inner, ds.StringStartsWith):
        return Condition(f"(instr({name}, ?) = 1 or {others})", values)
    if isinstance(inner, (ds.StringContains, ds.StringEndsWith)):
        return Condition(f"(instr({name}, ?) > 0 or {others})", values)
    return None


def _encodes(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


def _blobs(inner, name, negated):
    if negated or not isinstance(inner, (ds.EqualTo, ds.In)):
        return None
    values = _values(inner, (bytes, bytearray))
    if values is None:
        return None
    return Condition(f"({name} in ({_marks(values)}) or typeof({name}) <> 'blob')", tuple(map(bytes, values)))
