"""How filters over the same documents overlap, by sorted posting lists.

Every filter has a list of the documents that fail it, kept per part of the corpus and per range of ids,
in id order. What a filter removes after others ran is the difference of its list and theirs, what is gone
by then is a union; both come from galloping k-way merges inside one range, and sizes add up over the ranges.
Any order of filters needs only these sizes, so all orders cost no more than all subsets.

A range holds a bounded number of rows of one part, cut from rows that Spark has sorted by (part, id) with
a range partitioning, so a part with a third of all rows is many ranges. Equal rows are folded to one entry
with a multiplicity before anything is sorted.

Defined results: null text counts as empty, a null part as the empty string. Repeated rows each count. A row
without an id is no copy of another and none is a copy of it; it has no labels. Labels of one id in several
rows: one positive row is enough. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowferry.llm.common import settle

CAPITALS = bytes(range(65, 91))
SYMBOLS = re.compile(rb"[#$%&*|]")
COPY = 16  # bit of filter E; A to D are the bits below


@dataclass(frozen=True)
class AuditSettings:
    """``range_rows`` bounds the rows of one id range; the rest are limits of the filters."""

    filters: str = "ABCDE"
    min_words: int = 200
    min_distinct_percent: int = 50
    max_capital_percent: int = 2
    range_rows: int = 65_536


def failing(text: str | None, s: AuditSettings) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only, as wanted
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (len(words) < s.min_words)
        | (100 * len(set(words)) < s.min_distinct_percent * len(words)) << 1
        | (100 * capitals > s.max_capital_percent * len(text or "")) << 2
        | (SYMBOLS.search(raw) is not None) << 3
    )


def _flag(batches, settings: AuditSettings):
    for batch in batches:
        bits = pa.array([failing(t.as_py(), settings) for t in batch.column("text")], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("part", "id", "h")), bits], names=["part", "id", "h", "bits"])


def failing_rows(docs: DataFrame, labels: DataFrame, settings: AuditSettings = AuditSettings(), doc_id="doc_id",
                 text="text", part="source") -> DataFrame:
    """Distinct rows: part, id, h, n (multiplicity), bits (of all five filters), good, toxic."""
    plain = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    flagged = plain.withColumn("h", F.sha2(F.encode("text", "UTF-8"), 256)).mapInArrow(
        partial(_flag, settings=settings), f"part string, id {dict(plain.dtypes)['id']}, h string, bits int")
    rows = settle(flagged.groupBy("part", "id", "h", "bits").agg(F.count(F.lit(1)).alias("n")), "failing")
    # The least id of each text joins by text and id: copies of one text spread over all partitions.
    first = rows.where("id is not null").groupBy("h").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    with_id = rows.where("id is not null").join(first, ["h", "id"], "left").join(known, "id", "left").select(
        "part", "id", "h", "n", F.col("bits").bitwiseOR(F.when(F.col("first"), 0).otherwise(COPY)).alias("bits"),
        F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    return with_id.unionByName(rows.where("id is null").select(
        "part", "id", "h", "n", "bits", no.alias("good"), no.alias("toxic")))


# --- merges inside one id range ---------------------------------------------------------------

BLOCK = 1024


def gallop(entries: np.ndarray, at: int, target: int) -> int:
    """The first place from ``at`` on whose entry is not below ``target``: doubling steps, then bisection."""
    step, low = 1, at
    while at < len(entries) and entries[at] < target:
        low, at, step = at + 1, at + step, 2 * step
    return low + int(np.searchsorted(entries[low: min(at, len(entries))], target))


def difference(entries: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The entries in none of the others (all sorted). The other lists are galloped to each block's
    span of ids, and only that span is searched."""
    cursors, left = [0] * len(others), []
    for at in range(0, len(entries), BLOCK):
        block = entries[at: at + BLOCK]
        for k, other in enumerate(others):
            if not len(block):
                break
            start = gallop(other, cursors[k], block[0])
            end = cursors[k] = gallop(other, start, block[-1] + 1)
            span = other[start:end]
            if len(span):
                places = np.minimum(np.searchsorted(span, block), len(span) - 1)
                block = block[span[places] != block]
        left.append(block)
    return np.concatenate(left) if left else entries


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The sorted union: each list gives what the lists before it lack."""
    found = [difference(entries, lists[:k]) for k, entries in enumerate(lists)]
    return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)


def range_sizes(bits: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int):
    """(filter, mask of filters before it, rows, fails, removed, gone, good, toxic) of one id range.

    A posting is a row's place in the id order of its range; sizes are sums of the rows' multiplicities."""
    lists = [np.flatnonzero(bits >> f & 1) for f in range(filters)]
    total, fails = int(n.sum()), [int(n[entries].sum()) for entries in lists]
    gone = [int(n[union([lists[f] for f in range(filters) if mask >> f & 1])].sum()) for mask in range(1 << filters)]
    for f, entries in enumerate(lists):
        for mask in range(1 << filters):
            if mask >> f & 1:
                continue
            left = difference(entries, [lists[g] for g in range(filters) if mask >> g & 1])
            count = n[left]
            yield (f, mask, total, fails[f], int(count.sum()), gone[mask | 1 << f], int(count[good[left]].sum()),
                   int(count[toxic[left]].sum()))


SIZES = "part string, filter int, before int, rows long, fails long, removed long, gone long, good long, toxic long"


def _ranges(batches, filters: int, size: int):
    """Rows sorted by (part, id) cut into ranges of one part, at most ``size`` rows each."""
    names = SIZES.replace(" string", "").replace(" int", "").replace(" long", "").split(", ")
    held: list[pa.RecordBatch] = []

    def settle_range():
        table = pa.Table.from_batches(held)
        bits, n, good, toxic = (table.column(c).to_numpy() for c in ("bits", "n", "good", "toxic"))
        part = held[0].column("part")[0].as_py()
        found = [(part, *row) for row in range_sizes(bits, n, good, toxic, filters)]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if k == 0 else pa.int32() if k < 3 else pa.int64())
             for k, c in enumerate(zip(*found))], names=names)

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[0].column("part")[0] != batch.column("part")[start]:
                yield settle_range()
                rows = 0
            while start < end:
                piece = batch.slice(start, min(end - start, size - rows))
                held.append(piece)
                rows += piece.num_rows
                start += piece.num_rows
                if rows >= size:
                    yield settle_range()
                    rows = 0
    if held:
        yield settle_range()


def audit(docs: DataFrame, labels: DataFrame, settings: AuditSettings = AuditSettings(), doc_id="doc_id",
          text="text", part="source") -> DataFrame:
    """One row per part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark, letters = docs.sparkSession, settings.filters
    count, every = len(letters), (1 << len(letters)) - 1
    rows = failing_rows(docs, labels, settings, doc_id, text, part)
    ordered = rows.repartitionByRange("part", "id", "h").sortWithinPartitions("part", "id", "h")
    per_range = ordered.select("part", "bits", "n", "good", "toxic").mapInArrow(
        partial(_ranges, filters=count, size=settings.range_rows), SIZES)
    sums = settle(per_range.groupBy("part", "filter", "before").agg(
        *[F.sum(c).alias(c) for c in ("rows", "fails", "removed", "gone", "good", "toxic")]), "sizes")
    # How many orders have exactly these filters before this one.
    size = F.bit_count("before")
    orders = F.element_at(F.array(*[F.lit(factorial(k) * factorial(count - 1 - k)) for k in range(count)]), size + 1)
    alone = sums.groupBy("part", "filter").agg(
        F.max(F.when(size == count - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders).cast("long").alias("shapley"))
    places = {letter: k for k, letter in enumerate(letters)}
    steps = spark.createDataFrame([
        ("".join(order), step, places[order[step - 1]], sum(1 << places[x] for x in order[:step - 1]))
        for order in permutations(letters) for step in range(1, count + 1)
    ], "filter_order string, step int, filter int, before int")
    assert every < 1 << 31
    return sums.join(alone, ["part", "filter"]).join(F.broadcast(steps), ["filter", "before"]).select(
        "part", "filter_order", "step", (F.col("rows") - F.col("gone")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
