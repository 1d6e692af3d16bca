"""Dates and times. Zone-less timestamps never pass through the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _without_fraction(c: Column) -> Column:
    return F.substring_index(c.cast("string"), ".", 1)


def date_text(c: Column) -> Column:
    return c.cast("string")


def datetime_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a ``timestamp_ntz``, fraction dropped."""
    return _without_fraction(c)


def time_text(c: Column) -> Column:
    """``HH:mm:ss`` of a time of day, fraction dropped."""
    return _without_fraction(c)


def epoch_text(c: Column) -> Column:
    """Seconds since the epoch of a ``timestamp``, as text."""
    return F.unix_seconds(c).cast("string")


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970-01-01 00:00:00 of a ``timestamp_ntz`` on its own clock."""
    clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_date(F.to_date(c)).cast("bigint") * 86400 + clock


def to_second(c: Column) -> Column:
    """A ``timestamp_ntz`` with its fraction of a second dropped."""
    fraction = F.extract(F.lit("SECOND"), c) % F.lit(1)
    zero = F.lit(0)
    return c - F.make_dt_interval(zero, zero, zero, fraction)
