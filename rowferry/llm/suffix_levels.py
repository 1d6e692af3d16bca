"""Removing repeated passages with a logarithmic family of sparse suffix arrays.

Any passage of ``length`` bytes holds a landmark: of the 40-byte pieces that start in it, the one
with the least hash. Equal passages have the same landmark at the same place. So a suffix array needs only the
suffixes that start at landmarks, about one in eighty, and their order by the hash of their first bytes
is as good as any to bring equal ones together.

A new batch gets such an array, is scanned against every level of the index by a merge join, and becomes
a level itself; two levels of equal rank are merged into one of the next before the next batch, so a
text is merged about log2(batches) times. Batches are split by a hash of the text, so copies meet in one batch.

What the scans find is then judged exactly on the landmarks that two places share. The passages
around one landmark are a run. Equal runs settle most of them at once, by a 64-bit hash beside that of the
landmark; what is left (the edges of longer matches) is compared passage by passage. Texts that occur
twice as a whole need no landmarks to be judged.

Defined results: null text counts as empty; nothing is removed from texts shorter than ``length`` by themselves; repeated rows
are copies of each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowferry.llm.common import discard, settle

PIECE = 40
SLICE = 1 << 20  # start places looked at together, so memory is bounded however long a text is
ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepeatSettings:
    """``group``: more runs than this around one landmark are compared by a shuffle of their passages."""

    length: int = 200
    batches: int = 4
    group: int = 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hasher:
    """Hashes of all pieces of a text: differences of running sums, brought to a common place."""

    def __init__(self):
        values = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
        self.letters = values * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: bytes) -> np.ndarray:
        if len(self.up) <= len(data):
            size, back = 2 * len(data) + 1, np.uint64(pow(int(ODD), -1, 1 << 64))
            self.up = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, ODD))))
            self.down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, back))))
        terms = self.letters[np.frombuffer(data, np.uint8)] * self.up[: len(data)]
        return np.concatenate(([np.uint64(0)], np.cumsum(terms)))

    def piece(self, sums: np.ndarray, start, end) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.down[start])


_HASHER: list[Hasher] = []


def _hasher() -> Hasher:
    if not _HASHER:
        _HASHER.append(Hasher())
    return _HASHER[0]


def landmarks(data: bytes, length: int):
    """Per landmark: its hash, its run's hash, its place, the first and last start of its run."""
    hasher, width, out = _hasher(), length - PIECE + 1, []
    for low in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[low: low + SLICE + length - 1]
        sums, starts = hasher.sums(part), len(part) - length + 1
        at = np.arange(len(part) - PIECE + 1)
        hashes = hasher.piece(sums, at, at + PIECE)
        # the hash above, the place below: the least is the first of the least
        packed = (hashes & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
        blocks = np.concatenate((packed, np.full(-len(packed) % width, ~np.uint64(0)))).reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[width - 1: width - 1 + starts])
        place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [starts])) - 1
        place = place[first]
        runs = hasher.piece(sums, first, last + length) ^ _mixed(((place - first) * 4096 + last - first).astype(np.uint64))
        out.append((hashes[place].view(np.int64), runs.view(np.int64), place + low, first + low, last + low))
    if not out:
        return (np.empty(0, np.int64),) * 5
    return tuple(np.concatenate(c) for c in zip(*out))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _heads(batches, length: int):
    for batch in batches:
        found = [landmarks(_bytes(t), length)[0] for t in batch.column(0).to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["h"])


def _entries(batches, length: int):
    for batch in batches:
        texts = batch.column(2).to_pylist()
        # the run around a landmark goes as one number: how far before it the first start lies, and the starts
        found = [(h, g, p, (p - a) * (1 << 20) + b - a) for h, g, p, a, b in (landmarks(_bytes(t), length) for t in texts)]
        counts = [len(f[0]) for f in found]
        if sum(counts):
            keys = [pa.array(np.repeat(np.asarray(batch.column(i)), counts)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*keys, *[pa.array(np.concatenate(c)) for c in zip(*found)]], names=["k", "n", "h", "g", "p", "s"])


class SuffixLevels:
    """The index: levels of (h, n), the landmarks of its texts with their counts, in order of h."""

    def __init__(self, spark: SparkSession, length: int):
        self.spark, self.length, self.levels, self.written = spark, length, [], []

    def _array(self, heads: DataFrame) -> DataFrame:
        self.written.append(
            settle(heads.groupBy("h").agg(F.sum("n").alias("n")).sortWithinPartitions("h"), "suffixes", large=True))
        return self.written[-1]

    def drop(self) -> None:
        """Delete the arrays, once what was found by them is settled."""
        for array in self.written:
            discard(array)
        self.levels, self.written = [], []

    def add(self, texts: DataFrame) -> list[DataFrame]:
        """Index a batch (one column of text); gives the landmarks that it shares, with itself or with a level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, one), (_, other) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, self._array(one.union(other))))
        heads = texts.mapInArrow(partial(_heads, length=self.length), "h long").withColumn("n", F.lit(1).cast("long"))
        array = self._array(heads)
        shared = [array.where("n > 1").select("h")]
        shared += [array.join(level, "h").select("h") for _, level in self.levels]
        self.levels.append((0, array))
        return shared


def _covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _kept(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(bytes removed, spans, digest of what is kept)."""
    digest, at = hashlib.sha256(), 0
    for low, high in spans:
        digest.update(data[at:low])
        at = high
    digest.update(data[at:])
    return sum(b - a for a, b in spans), len(spans), digest.hexdigest()


DONE = "doc_id long, k long, n long, done boolean, n_removed long, n_spans long, kept_sha256 string"
RUN = "h long, k long, n long, p long, a long, b long, data binary"


def _first(batches, length: int):
    """Settle every text that needs no comparing; of the others keep the text, the spans so far and the runs."""
    run_type = pa.struct([("h", pa.int64()), ("p", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("data", pa.binary())])
    span_type = pa.struct([("low", pa.int64()), ("high", pa.int64())])
    for batch in batches:
        out = []
        for doc, k, n, text, whole, entries in zip(*(c.to_pylist() for c in batch.columns)):
            data, entries = _bytes(text), entries or []
            needed = [e for e in entries if e["need"]]
            runs = [{**{c: e[c] for c in "hpab"}, "data": data[e["a"]: e["b"] + length]} for e in needed]
            spans = _covered([(e["a"], e["b"] + length) for e in entries if e["dup"]])
            if whole:
                spans = [(0, len(data))]
            open_ = bool(needed) and not whole
            result = (None, None, None) if open_ else _kept(data, spans)
            out.append((doc, k, n, not open_, *result, data if open_ else None,
                        [{"low": a, "high": b} for a, b in spans] if open_ else [], runs))
        columns = list(zip(*out)) if out else [[]] * 10
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                 pa.list_(span_type), pa.list_(run_type)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["doc_id", "k", "n", "done", "n_removed", "n_spans", "kept_sha256", "data", "spans", "runs"])


def _passages(run: tuple, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the landmark in each passage, hash, start) of a run's passages."""
    _, _, _, p, a, b, data = run
    hasher = _hasher()
    sums, at = hasher.sums(data), np.arange(b - a + 1)
    return p - a - at, hasher.piece(sums, at, at + length), at + a


def _compare(batches, length: int):
    """Runs come by landmark. Spans of passages that another run of the landmark has at the same place."""
    group: list[tuple] = []

    def shared():
        if len(group) < 2:
            return []
        parts = [_passages(run, length) for run in group]
        keys = np.concatenate([h ^ _mixed(r.astype(np.uint64)) for r, h, _ in parts])
        _, of, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice, at, out = counts[of] > 1, 0, []
        for run, (_, _, starts) in zip(group, parts):
            own = starts[twice[at: at + len(starts)]]
            at += len(starts)
            if len(own):
                cuts = np.flatnonzero(np.diff(own) > 1)
                for low, high in zip(own[np.concatenate(([0], cuts + 1))], own[np.concatenate((cuts, [len(own) - 1]))]):
                    out.append((run[1], run[2], int(low), int(high) + length))
        return out

    def table(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], names=["k", "n", "low", "high"])

    for batch in batches:
        out = []
        for run in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][0] != run[0]:
                out += shared()
                group.clear()
            group.append(run)
        if out:
            yield table(out)
    if last := shared():
        yield table(last)


def _opened(batches, length: int):
    for batch in batches:
        for run in zip(*(c.to_pylist() for c in batch.columns)):
            places, hashes, starts = _passages(run, length)
            size = len(starts)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.full(size, v, dtype=np.int64)) for v in run[:3]], pa.array(places),
                 pa.array(hashes.view(np.int64)), pa.array(starts)], names=["h", "k", "n", "r", "w", "low"])


def _last(batches):
    for batch in batches:
        out = []
        for doc, n, data, spans, more in zip(*(c.to_pylist() for c in batch.columns)):
            found = _covered([(s["low"], s["high"]) for s in [*spans, *(more or [])]])
            out.append((doc, n, *_kept(data, found)))
        columns = list(zip(*out)) if out else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, settings: RepeatSettings = RepeatSettings(), doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark, length = docs.sparkSession, settings.length
    body = F.coalesce(F.col(text), F.lit(""))
    # a text is known by its hash and its length
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("k"),
                       F.octet_length(body).cast("long").alias("n"), body.alias("text"))
    long = rows.where(F.col("n") >= length)

    index, shared = SuffixLevels(spark, length), []
    for batch in range(settings.batches):
        shared += index.add(long.where(F.pmod("k", F.lit(settings.batches)) == batch).select("text"))
    hits = shared[0]
    for more in shared[1:]:
        hits = hits.union(more)
    hits = settle(hits.distinct(), "shared-landmarks", large=True)
    index.drop()

    entries = long.select("k", "n", "text").mapInArrow(
        partial(_entries, length=length), "k long, n long, h long, g long, p long, s long")
    found = settle(entries.join(hits, "h", "left_semi").distinct(), "landmarks", large=True)
    runs = found.groupBy("h", "g").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("k", "n", "p")).alias("one"))
    marks = runs.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("m").alias("least"))
    known = runs.join(marks, "h").where((F.col("m") > 1) | (F.col("kinds") > 1))
    # compared are single runs whose landmark has others, and one run for each settled kind beside them
    start = F.col("p") - F.shiftright("s", 20)
    judged = found.join(known, ["h", "g"]).withColumn("a", start).withColumn(
        "b", F.col("a") + F.col("s").bitwiseAND(F.lit((1 << 20) - 1))).select(
        "k", "n", F.struct(
            "h", "p", "a", "b", (F.col("m") > 1).alias("dup"),
            ((F.col("kinds") > 1) & (F.col("least") == 1) & (F.struct("k", "n", "p") == F.col("one"))).alias("need")).alias("e"))
    marked = judged.groupBy("k", "n").agg(F.collect_list("e").alias("entries"))
    copies = long.groupBy("k", "n").count().where(F.col("count") > 1).select("k", "n", F.lit(True).alias("whole"))
    known_texts = copies.join(marked, ["k", "n"], "full_outer")
    joined = rows.join(known_texts, ["k", "n"], "left").select("doc_id", "k", "n", "text", "whole", "entries")
    first = settle(joined.mapInArrow(
        partial(_first, length=length),
        DONE + ", data binary, spans array<struct<low:long,high:long>>, "
        "runs array<struct<h:long,p:long,a:long,b:long,data:binary>>"), "first-pass", large=True)

    compared = first.select("k", "n", F.explode("runs").alias("r")).select(
        "r.h", "k", "n", "r.p", "r.a", "r.b", "r.data").dropDuplicates(["h", "k", "n", "p", "a"])
    compared = settle(compared, "runs", large=True)
    crowded = settle(compared.groupBy("h").count().where(F.col("count") > settings.group).select("h"), "crowded")
    spans = (
        compared.join(crowded, "h", "left_anti").select("h", "k", "n", "p", "a", "b", "data")
        .repartition("h").sortWithinPartitions("h")
        .mapInArrow(partial(_compare, length=length), "k long, n long, low long, high long")
    )
    if not crowded.isEmpty():
        opened = settle(compared.join(crowded, "h", "left_semi").select("h", "k", "n", "p", "a", "b", "data").mapInArrow(
            partial(_opened, length=length), "h long, k long, n long, r long, w long, low long"), "passages")
        twice = opened.groupBy("h", "r", "w").count().where(F.col("count") > 1).drop("count")
        spans = spans.union(opened.join(twice, ["h", "r", "w"], "left_semi").select(
            "k", "n", "low", (F.col("low") + length).alias("high")))
    more = spans.groupBy("k", "n").agg(F.collect_list(F.struct("low", "high")).alias("more"))
    last = first.where("not done").select("doc_id", "k", "n", "data", "spans").join(more, ["k", "n"], "left").select(
        "doc_id", "n", "data", "spans", "more").mapInArrow(
        _last, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    done = first.where("done").select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
    return done.union(last)
