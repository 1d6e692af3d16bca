"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_all(few: DataFrame, many: DataFrame, keys: list[str]) -> DataFrame:
    """``few`` left join ``many``: every row of ``few``, also one without a partner.

    Matched and lonely rows are found apart. A hot key of ``many`` would go to one task of a
    left outer join, which cannot be split on that side. The inner join can: Spark broadcasts
    ``few`` if it is small enough and otherwise splits skewed partitions. The lonely rows need
    only the distinct keys of ``many``, which are folded before they are exchanged.
    """
    matched = few.join(many, keys)
    lonely = few.join(many.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)
