"""Ranked lexical search with hashed max-sketches.

A document folds into a sketch: its terms are hashed to a fixed number of coordinates, and each coordinate
keeps the largest impact of the terms that fall on it. Looking a query's terms up in the sketch and weighing
them gives an upper bound of the document's score, for a batch of documents and a query at a time. Documents
are then rescored exactly in the order of falling bounds until no bound reaches the worst of the best ten.

An impact is the score's share of term frequency and length; the weight of a term, which depends on the whole
table, is applied at lookup, so a sketch holds for every query. Document count, length and the frequencies of
the queries' terms are summed over the whole table in a first pass. Each task keeps its own best ten per
query; theirs are ranked in two steps, so no task holds more than the best of a bounded number of others.
Queries are taken in blocks of bounded size, each against all rows.

Defined results: null and empty texts have no terms and never score. Repeated rows each rank, equal scores
by ascending id, rows without an id last. Texts of one item are one query; an item of no known term has no
rows. An empty table of documents or items gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowferry.llm.common import settle

# ASCII other than letters and digits separates terms; letters A-Z are lower-cased, nothing else.
FOLDED = bytes((c | 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


@dataclass(frozen=True)
class SketchSettings:
    """``slice_documents`` sketches are held at once; a block of queries has at most ``block_terms`` terms."""

    best: int = 10
    coordinates: int = 4096
    slice_documents: int = 256
    slice_bytes: int = 16 << 20
    block_terms: int = 50_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split()


@dataclass
class Queries:
    """A block of queries: per item its distinct terms as places in ``terms``."""

    items: list
    lists: list[np.ndarray]
    terms: list[bytes]


def _blocks(items: DataFrame, settings: SketchSettings, item_id: str, text: str):
    """Queries in blocks of bounded size. Rows of one item come together, in item order."""
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).orderBy("item").toLocalIterator()
    pending: list[tuple[object, set[bytes]]] = []

    def block():
        terms = sorted(set().union(*(t for _, t in pending)))
        place = {t: k for k, t in enumerate(terms)}
        return Queries([i for i, _ in pending],
                       [np.array(sorted(place[x] for x in t), np.int64) for _, t in pending], terms)

    held = 0
    for row in rows:
        found = set(terms_of(row["text"]))
        if pending and pending[-1][0] == row["item"]:
            held += len(found - pending[-1][1])
            pending[-1][1].update(found)
            continue
        if pending and held + len(found) > settings.block_terms:
            yield block()
            pending, held = [], 0
        pending.append((row["item"], found))
        held += len(found)
    if pending:
        yield block()


def _count(batches, terms: list[bytes]):
    """Per task: documents with a term, their terms, and documents per wanted term (place -2, -1, 0...)."""
    place = {t: k for k, t in enumerate(terms)}
    known, documents, length = place.keys(), 0, 0
    held = np.zeros(len(terms), np.int64)
    for batch in batches:
        for text in batch.column(0):
            found = terms_of(text.as_py())
            documents += bool(found)
            length += len(found)
            at = [place[t] for t in known & set(found)]
            held[at] += 1
    some = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-2, -1, *some.tolist()], pa.int32()), pa.array([documents, length, *held[some].tolist()], pa.int64())],
        names=["place", "n"])


def term_weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequencies], np.int64)


def impact(tf, m):
    """The share of term frequency and length, rounded down; never falls as ``tf`` grows."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def coordinate(term: bytes, size: int) -> int:
    return zlib.crc32(term) % size


def sketch(counts: list[Counter], norms: np.ndarray, size: int) -> np.ndarray:
    """The largest impact on each coordinate (rows) of each document (columns)."""
    out = np.zeros((size, len(counts)), np.int64)
    for row, found in enumerate(counts):
        at = np.fromiter((coordinate(t, size) for t in found), np.int64, len(found))
        tf = np.fromiter(found.values(), np.int64, len(found))
        np.maximum.at(out[:, row], at, impact(tf, norms[row]))
    return out


class Best:
    """The best documents of each query seen so far in a task."""

    def __init__(self, queries: Queries, weights: np.ndarray, settings: SketchSettings):
        self.queries, self.settings = queries, settings
        self.weights = [weights[x] for x in queries.lists]
        self.coordinates = [np.array([coordinate(queries.terms[k], settings.coordinates) for k in x], np.int64)
                            for x in queries.lists]
        self.heaps: list[list[tuple]] = [[] for _ in queries.items]

    def add(self, ids: list, counts: list[Counter], norms: np.ndarray):
        sketches = sketch(counts, norms, self.settings.coordinates)
        for q, heap in enumerate(self.heaps):
            bounds = self.weights[q] @ sketches[self.coordinates[q]]
            full = len(heap) == self.settings.best
            at = np.flatnonzero(bounds >= max(heap[0][0] if full else 1, 1))
            terms = [self.queries.terms[k] for k in self.queries.lists[q]]
            for row in at[np.argsort(-bounds[at], kind="stable")].tolist():
                if len(heap) == self.settings.best and bounds[row] < heap[0][0]:
                    break  # bounds fall from here on
                score = self._score(terms, self.weights[q], counts[row], int(norms[row]))
                entry = (score, ids[row] is not None, -(ids[row] or 0), ids[row])
                if score > 0 and len(heap) < self.settings.best:
                    heapq.heappush(heap, entry)
                elif score > 0 and entry[:3] > heap[0][:3]:
                    heapq.heapreplace(heap, entry)

    @staticmethod
    def _score(terms, weights, counts: Counter, m: int) -> int:
        return sum(int(w) * impact(tf, m) for t, w in zip(terms, weights) if (tf := counts.get(t)))

    def rows(self) -> pa.RecordBatch:
        found = [(q, i, score) for q, heap in enumerate(self.heaps) for score, _, _, i in heap]
        columns = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
            names=["query", "doc_id", "score"])


def _search(batches, queries: Queries, weights: np.ndarray, documents: int, length: int, settings: SketchSettings):
    best = Best(queries, weights, settings)
    ids, counts, sizes, held = [], [], [], 0

    def flush():
        norms = np.array([10 + (90 * n * documents) // length for n in sizes], np.int64)
        best.add(ids, counts, norms)

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            found = terms_of(text.as_py())
            if not found:
                continue
            ids.append(doc.as_py())
            counts.append(Counter(found))
            sizes.append(len(found))
            held += 100 * len(counts[-1])
            if len(ids) >= settings.slice_documents or held >= settings.slice_bytes:
                flush()
                ids, counts, sizes, held = [], [], [], 0
    if ids:
        flush()
    yield best.rows()


def search(docs: DataFrame, items: DataFrame, settings: SketchSettings = SketchSettings(), doc_id="doc_id", text="text",
           item_id="item_id", item_text="text") -> DataFrame:
    """Per item its best documents: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)[item_id]
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _blocks(items, settings, item_id, item_text):
        sums = dict(plain.select("text").mapInArrow(partial(_count, terms=block.terms), "place int, n long")
                    .groupBy("place").agg(F.sum("n")).collect())
        documents, length = sums.get(-2) or 0, sums.get(-1) or 0
        if not documents:
            continue
        weights = term_weights(documents, np.array([sums.get(k, 0) for k in range(len(block.terms))]))
        run = partial(_search, queries=block, weights=weights, documents=documents, length=length, settings=settings)
        per_task = plain.mapInArrow(run, "query int, doc_id long, score long")
        falling = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # first the best within each of some groups of tasks, then of these
        near = Window.partitionBy("query", "part").orderBy(*falling)
        some = per_task.withColumn("part", F.spark_partition_id() % 64).withColumn(
            "rank", F.row_number().over(near)).where(F.col("rank") <= settings.best)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*falling))).where(
            F.col("rank") <= settings.best)
        names = spark.createDataFrame(list(enumerate(block.items)), f"query int, item_id {kind}")
        found = found.unionByName(settle(
            ranked.join(names, "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    return found
