"""Hierarchies over any ordered level columns: build, search, list.

A row is a path from the top level down. Its last level stays a row of its own, so building a tree
never shuffles the bulk of the data; only the few distinct upper nodes are grouped, and partial
aggregation folds them before they travel. A hot upper node is folded the same way. A search reads its
input once: what it finds, leaves and ancestors, goes through one such grouping together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

INDENT = 4


@dataclass(frozen=True)
class Level:
    """One level: the node's name, optionally its description and its rank among siblings."""

    name: str | Column
    description: str | Column | None = None
    order: str | Column | None = None


def _column(value: str | Column | None, kind: str) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    return (F.col(value) if isinstance(value, str) else value).cast(kind)


def _paths(df: DataFrame, levels: list[Level], kept: Column) -> DataFrame:
    """One array of nodes per row, and how many of its levels to keep."""
    steps = [
        F.struct(
            _column(level.order, "bigint").alias("rank"),
            _column(level.name, "string").alias("name"),
        )
        for level in levels
    ]
    notes = [_column(level.description, "string") for level in levels]
    paths = df.select(
        F.array(*steps).alias("steps"), F.array(*notes).alias("notes"), kept.alias("kept")
    )
    return paths.where("kept > 0")


def _present(levels: list[Level]) -> list[Column]:
    """Per level whether the row reaches it: no name missing down to there."""
    reached, found = F.lit(True), []
    for level in levels:
        reached = reached & _column(level.name, "string").isNotNull()
        found.append(reached)
    return found


def _deepest(flags: list[Column]) -> Column:
    """Number of the last level whose flag is true, 0 for none."""
    return F.greatest(F.lit(0), *[F.when(flag, i).otherwise(0) for i, flag in enumerate(flags, 1)])


def _nodes(paths: DataFrame, levels: list[Level]) -> DataFrame:
    """The nodes of the first ``kept`` levels of every row: (path, depth, name, description)."""
    size = len(levels)
    leaves = paths.where(F.col("kept") == size).select(
        F.col("steps").alias("path"), F.get("notes", F.lit(size - 1)).alias("description")
    )
    upper_levels = F.least(F.col("kept"), F.lit(size - 1))
    # Rows are folded to their distinct chains of upper nodes first; only those few are then
    # taken apart into single nodes.
    chains = (
        paths.where(upper_levels > 0)
        .select(
            F.slice("steps", F.lit(1), upper_levels).alias("steps"),
            F.slice("notes", F.lit(1), upper_levels).alias("notes"),
        )
        .distinct()
    )
    upper = (
        chains.select(
            "steps", "notes", F.explode(F.sequence(F.lit(1), F.size("steps"))).alias("level")
        )
        .select(
            F.slice("steps", F.lit(1), F.col("level")).alias("path"),
            F.get("notes", F.col("level") - 1).alias("description"),
        )
        .distinct()
    )
    if any(level.description is not None for level in levels[:-1]):
        # Distinct hashes and leaves a few rows per node; taking the minimum of a string
        # right away would sort every input row.
        upper = upper.groupBy("path").agg(F.min("description").alias("description"))
    nodes = upper.unionByName(leaves) if size > 1 else leaves
    return nodes.select(
        "path", F.size("path").alias("depth"),
        F.element_at("path", -1)["name"].alias("name"), "description",
    )


def build_tree(df: DataFrame, levels: list[Level], upper: DataFrame | None = None) -> DataFrame:
    """All nodes: (path, depth, name, description), the path an array of (rank, name).

    Where the upper levels have a table of their own, give it as ``upper`` (with the columns of all levels but the
    last): then ``df`` is read once, for the last level only, and no upper node is sought in it.
    """
    if upper is None:
        return _nodes(_paths(df, levels, _deepest(_present(levels))), levels)
    above = build_tree(upper, levels[:-1])
    size = F.lit(len(levels))
    leaves = _paths(df, levels, F.when(_present(levels)[-1], size).otherwise(0)).select(
        F.col("steps").alias("path"), F.get("notes", size - 1).alias("description"))
    return above.unionByName(leaves.select(
        "path", F.size("path").alias("depth"), F.element_at("path", -1)["name"].alias("name"), "description"))


def matches(name: Column, query: str, regex: bool = False) -> Column:
    """Case-insensitive: the name contains the text, or the pattern is found in it."""
    if regex:
        return name.rlike("(?iU)" + query)
    return F.contains(F.lower(name), F.lit(query.lower()))


def _found(df: DataFrame, levels: list[Level], hits: list[Column], size: int) -> DataFrame:
    """The nodes down to each row's deepest hit: path, description, and for leaves of ``size`` levels the row."""
    paths = _paths(df, levels, _deepest(hits)).withColumn("row", F.monotonically_increasing_id())
    return paths.select(
        "steps", "notes", "row", F.explode(F.sequence(F.lit(1), F.col("kept"))).alias("level")
    ).select(
        F.slice("steps", F.lit(1), F.col("level")).alias("path"), F.get("notes", F.col("level") - 1).alias("description"),
        F.when(F.col("level") == size, F.col("row")).alias("row"))


def search_tree(
    df: DataFrame, levels: list[Level], query: str, regex: bool = False, upper: DataFrame | None = None
) -> DataFrame:
    """The nodes whose name matches, with their ancestors.

    On each row everything down to its deepest match is kept, so ancestors need no join, and ``df`` is read once. Where
    the upper levels have a table of their own, give it as ``upper`` (with the columns of all levels but the last):
    then only leaves are sought in ``df``, and its filter reaches the scan.
    """
    def hits(some: list[Level]) -> list[Column]:
        return [present & matches(_column(level.name, "string"), query, regex)
                for present, level in zip(_present(some), some)]

    size = len(levels)
    if upper is None:
        nodes = _found(df, levels, hits(levels), size)
    else:
        leaf = hits(levels)[-1]
        nodes = _found(df.where(leaf), levels, [F.lit(False)] * (size - 1) + [leaf], size).unionByName(
            _found(upper, levels[:-1], hits(levels[:-1]), size))
    # equal upper nodes fold, a leaf is told apart by its row
    nodes = nodes.distinct()
    if any(level.description is not None for level in levels[:-1]):
        nodes = nodes.groupBy("path", "row").agg(F.min("description").alias("description"))
    return nodes.select(
        "path", F.size("path").alias("depth"), F.element_at("path", -1)["name"].alias("name"), "description")


def list_tree(nodes: DataFrame) -> DataFrame:
    """(path, line) in tree order: four blanks per level below the top, name, description."""
    note = F.coalesce(F.concat(F.lit(" "), F.col("description")), F.lit(""))
    line = F.concat(F.repeat(F.lit(" "), INDENT * (F.col("depth") - 1)), F.col("name"), note)
    return nodes.select("path", line.alias("line")).orderBy("path")


def path_text(path: Column, separator: str = "/") -> Column:
    return F.array_join(F.transform(path, lambda step: step["name"]), separator)
