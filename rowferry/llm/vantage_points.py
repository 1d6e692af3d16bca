"""Nearest neighbours by inner product with vantage-point trees, one per shard.

A vantage-point tree needs a metric. With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a
query q becomes (q, 0); then nearer in Euclid's sense is the same as a larger inner product.

Vectors fall into shards by a hash, and each shard's tree is built in its task. A query goes to every
shard. A branch is left out if the query's distance to its shell is more than ``factor`` times the distance
of the worst neighbour so far. Factor one is the triangle inequality, and gives exact results; less
leaves out more. The first bound is the query's distance to its neighbours in a bounded sample,
which also holds for the whole. Every row is indexed, whatever the sample is.

Equal vectors are one point of a tree, with as many of their least ids as a result can need, so a
vector that a third of all rows share costs one point.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another
dimension than most, take no part, as query or as candidate; rows repeated whole count once; ties go to the
smaller id; a query without candidates has no rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowferry.llm.common import settle

FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class TreeSettings:
    """``shard_rows`` is the least size of a shard; shards grow with the root of the table (ten times it), so
    that neither they nor the copies of the queries and their answers grow in proportion to it."""

    neighbours: int = 20
    factor: float = 0.17
    leaf: int = 256
    shard_rows: int = 1024
    sample_rows: int = 2048


class Tree:
    """A vantage-point tree over augmented vectors."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points, leaf
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        # of a few candidates, the one whose distances differ most; chosen by place, so every run is alike
        some = rows[:: max(1, len(rows) // 128)]
        spread = [np.var(self._distances(v, some)) for v in some[:8]]
        vantage = some[int(np.argmax(spread))]
        away = self._distances(vantage, rows)
        shell = float(np.median(away))
        inner, outer = rows[away < shell], rows[away >= shell]
        if not len(inner):
            return rows
        return vantage, shell, self._build(inner), self._build(outer)

    def _distances(self, vantage: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[vantage]) ** 2).sum(axis=1))

    def search(self, queries: np.ndarray, bounds: np.ndarray, size: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the nearest points, -1 where there are fewer. ``bounds``: beyond them nothing
        is wanted."""
        norms, own = (queries ** 2).sum(axis=1), (self.points ** 2).sum(axis=1)
        best = np.full((len(queries), size), np.inf)
        found = np.full((len(queries), size), -1)
        bounds = bounds.copy()

        def away(active, rows):
            return np.sqrt(np.maximum(norms[active, None] + own[rows] - 2 * queries[active] @ self.points[rows].T, 0))

        def visit(node, active):
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                near = away(active, node)
                some = (near <= bounds[active, None] * (1 + 1e-9)).any(axis=1)
                active, near = active[some], near[some]
                if not len(active):
                    return
                near = np.concatenate((best[active], near), axis=1)
                rows = np.concatenate((found[active], np.broadcast_to(node, (len(active), len(node)))), axis=1)
                kept = np.argpartition(near, size - 1, axis=1)[:, :size]
                best[active] = np.take_along_axis(near, kept, axis=1)
                found[active] = np.take_along_axis(rows, kept, axis=1)
                bounds[active] = np.minimum(bounds[active], best[active].max(axis=1))
                return
            vantage, shell, inner, outer = node
            gap = away(active, np.array([vantage]))[:, 0] - shell
            within, beyond = active[gap < 0], active[gap >= 0]
            visit(inner, within)
            visit(outer, beyond)
            visit(outer, within[-gap[gap < 0] <= factor * bounds[within]])
            visit(inner, beyond[gap[gap >= 0] <= factor * bounds[beyond]])

        if len(self.points):
            visit(self.root, np.arange(len(queries)))
        return found, best


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def valid_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = F.col(embedding)
    fine = F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(fine & F.col("vec_id").isNotNull())
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (common["d"] if common else 0)).distinct()


def _bounded(batches, sample: np.ndarray, ids: np.ndarray, reach: float, size: int):
    """Queries with the distance to their ``size``-th neighbour within the sample."""
    for batch in batches:
        queries, own = _matrix(batch.column(1)), np.asarray(batch.column(0))
        bounds = np.full(len(queries), np.inf)
        if len(sample) > size:
            near = queries @ sample.T
            near[own[:, None] == ids] = -np.inf
            worst = -np.partition(-near, size - 1, axis=1)[:, size - 1]
            bounds = np.sqrt(np.maximum((queries ** 2).sum(axis=1) + reach ** 2 - 2 * worst, 0))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bounds)], names=["id", "v", "bound"])


def _search(batches, settings: TreeSettings, reach: float):
    """Rows come by shard, a shard's points before its queries."""
    size = settings.neighbours
    shard, points, ids, tree, plain = None, [], [], None, None

    def answer(queries, own, bounds):
        # one more than wanted, as a query may find itself
        rows, _ = tree.search(np.concatenate((queries, np.zeros((len(queries), 1))), axis=1), bounds, size + 1, settings.factor)
        out = []
        for q, query, near in zip(own.tolist(), queries, rows):
            near = near[near >= 0]
            scores = (plain[near] * query).sum(axis=1)
            hits = [(-s, i) for r, s in zip(near.tolist(), scores.tolist()) for i in ids[r] if i != q]
            hits.sort()
            out += [(q, i, -s) for s, i in hits[:size]]
        return out

    for batch in batches:
        found, at = [], 0
        shards, kinds = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
        for end in [*cuts.tolist(), len(shards)]:
            part, (this, kind) = batch.slice(at, end - at), (int(shards[at]), int(kinds[at]))
            at = end
            if this != shard:
                shard, points, ids, tree = this, [], [], None
            if kind == 0:
                points.append(_matrix(part.column(3)))
                ids += part.column(4).to_pylist()
                continue
            if not points:
                continue
            if tree is None:
                plain = np.concatenate(points)
                last = np.sqrt(np.maximum(reach ** 2 - (plain ** 2).sum(axis=1), 0))
                tree = Tree(np.concatenate((plain, last[:, None]), axis=1), settings.leaf)
            found += answer(_matrix(part.column(3)), np.asarray(part.column(2)), np.asarray(part.column(5)))
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                names=["query_id", "vec_id", "score"])


def nearest(df: DataFrame, queries, settings: TreeSettings = TreeSettings(), vec_id="vec_id", embedding="embedding") -> DataFrame:
    """Per query its nearest rows: query_id, rank (from 1), vec_id, score.

    ``queries``: a condition on the column ``vec_id`` that tells the rows to take as queries.
    """
    spark, size = df.sparkSession, settings.neighbours
    rows = settle(valid_vectors(df, vec_id, embedding), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, square = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    reach = math.sqrt(square or 0.0) * (1 + 1e-9)
    # the window's limit is also applied before its shuffle, so a common vector sends few rows per task
    least = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(
        F.col("place") <= size + 1)
    points = least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    shards = max(1, math.ceil(n / max(settings.shard_rows, 10 * math.isqrt(n))))
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    some = rows.where(hashed < max(1, min(1 << 30, settings.sample_rows * (1 << 30) // max(n, 1)))).collect()
    sample = np.array([r["v"] for r in some], dtype=np.float64)
    sample_ids = np.array([r["vec_id"] for r in some], dtype=np.int64)

    def bounded(batches):
        return _bounded(batches, sample, sample_ids, reach, size)

    def search(batches):
        return _search(batches, settings, reach)

    kind = rows.schema["v"].dataType.simpleString()
    asked = rows.where(queries).select("vec_id", "v").mapInArrow(bounded, f"id long, v {kind}, bound double")
    layout = ["shard", "kind", "id", "v", "ids", "bound"]
    index = points.select(
        F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("id"), "v", "ids",
        F.lit(0.0).alias("bound"))
    sent = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "id", "v",
        F.array().cast("array<bigint>").alias("ids"), "bound")
    found = (
        index.select(layout).union(sent.select(layout)).repartition("shard").sortWithinPartitions("shard", "kind")
        .mapInArrow(search, FOUND)
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= size).select("query_id", "rank", "vec_id", "score")
