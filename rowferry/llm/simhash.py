"""SimHash near-duplicates by multi-index hashing.

A fingerprint is split into segments. Two fingerprints within ``max_distance`` bits differ by a small
number of bits in at least one segment, so each fingerprint enumerates the Hamming ball of that
radius around each of its segments, fetches the fingerprints that hold one of these segment values,
and the whole distance is verified.

Only distinct fingerprints are compared, so copies cost nothing. A segment value that very many
different fingerprints share would give all their pairs; there, fingerprints meet at the values of a
whole-fingerprint ball instead (two of them are within distance 2r exactly if their balls of radius r
share a value), and each links to the least at that value. That is exact and linear.

Defined results: null text counts as empty; a text without words has fingerprint zero and links like
any other; repeated rows get the same fingerprint and component; a component with no non-null id has
a null id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rowferry.llm.common import free_name, settle
from rowferry.llm.components import components

BITS = 64
CHUNK = 1 << 15  # shingles held as bits at once


@dataclass(frozen=True)
class SimHashSettings:
    """``bucket`` fingerprints that share a segment value are compared directly, more meet at balls."""

    words: int = 3
    max_distance: int = 2
    seed: int = 42
    segments: int = 2
    bucket: int = 64


def fingerprint(text: str | None, width: int, seed: int) -> int:
    """The signed 64-bit SimHash of a text's word shingles."""
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and ASCII white space only, as wanted
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    slices = list(map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()))
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(slices), CHUNK):
        part = slices[at: at + CHUNK]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(joined[s], seed) for s in part), dtype=np.uint64, count=len(part))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(counts * 2 > len(slices))
    return int.from_bytes(packed.tobytes(), "big", signed=True)


def _fingerprints(batches, at: int, width: int, seed: int, name: str):
    for batch in batches:
        column = pa.array([fingerprint(t.as_py(), width, seed) for t in batch.column(at)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def with_fingerprint(df: DataFrame, text: str, name: str, settings: SimHashSettings) -> DataFrame:
    """``df`` and a long column of fingerprints."""
    schema = StructType([*df.schema.fields, StructField(name, LongType())])
    run = partial(_fingerprints, at=df.columns.index(text), width=settings.words, seed=settings.seed, name=name)
    return df.mapInArrow(run, schema)


def _ball(value: Column, bits: int, radius: int) -> Column:
    """All values within ``radius`` bits of a value of so many bits."""
    masks = [0] + [sum(1 << b for b in chosen) for r in range(1, radius + 1)
                   for chosen in combinations(range(bits), r)]
    signed = [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]
    # the masks as one literal array, so the expression stays small
    return F.transform(F.expr("array(" + ",".join(f"{m}L" if m != -(1 << 63) else "shiftleft(1L, 63)" for m in signed) + ")"),
                       lambda m: value.bitwiseXOR(m))


def _segments(settings: SimHashSettings) -> list[tuple[int, int, int]]:
    """(shift, bits, radius) of each segment; by pigeonhole the first ones bear the larger radius."""
    radius, extra = divmod(settings.max_distance, settings.segments)
    size, out = BITS // settings.segments, []
    for k in range(settings.segments):
        bits = size if k < settings.segments - 1 else BITS - size * k
        out.append((size * k, bits, radius if k <= extra else radius - 1))
    return [s for s in out if s[2] >= 0]


def links(prints: DataFrame, settings: SimHashSettings) -> DataFrame:
    """(a, b) for distinct fingerprints ``fp``: every pair within the distance that the segments
    fetch, and for crowded segment values a star that connects the same fingerprints."""
    def part(fp, shift, bits):
        return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))

    fp = F.col("fp")
    kinds = _segments(settings)
    table = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("s"), part(fp, shift, bits).alias("v"))
        for k, (shift, bits, _) in enumerate(kinds)])).alias("x")).select("fp", "x.s", "x.v")

    def ball_of(k, shift, bits, radius):
        return F.transform(_ball(part(fp, shift, bits), bits, radius),
                           lambda v: F.struct(F.lit(k).alias("s"), v.alias("v")))

    probes = prints.select("fp", F.explode(F.concat(*[
        ball_of(k, *kind) for k, kind in enumerate(kinds)])).alias("x")).select("fp", "x.s", "x.v")
    crowded = settle(table.groupBy("s", "v").count().where(F.col("count") > settings.bucket).select("s", "v"), "crowded")
    fetched = (
        probes.withColumnRenamed("fp", "a")
        .join(table.join(crowded, ["s", "v"], "left_anti").withColumnRenamed("fp", "b"), ["s", "v"])
        .where((F.col("a") < F.col("b"))
               & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= settings.max_distance))
        .select("a", "b")
    )
    if crowded.isEmpty():
        return fetched.distinct()
    near = probes.join(crowded, ["s", "v"], "left_semi").select("fp").distinct()
    radius = settings.max_distance // 2
    meets = near.select("fp", F.explode(_ball(fp, BITS, radius)).alias("v"))
    if settings.max_distance % 2:  # an odd distance: one side reaches a bit further
        raise ValueError("max_distance must be even where segment values are crowded")
    least = meets.groupBy("v").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = meets.join(least, "v").where(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return fetched.union(stars).distinct()


def grouped(rows: DataFrame, settings: SimHashSettings, doc_id="doc_id") -> DataFrame:
    """Per distinct fingerprint of ``rows`` (settled; columns doc_id, fp): its component's label and
    the component's least document with that document's fingerprint."""
    prints = settle(rows.groupBy("fp").agg(
        F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), "fp")).alias("first")), "prints")
    labels = components(links(prints.select("fp"), settings))
    labelled = prints.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("least"))
    return labelled.select("fp", "label").join(firsts, "label")


def simhash_groups(docs: DataFrame, settings: SimHashSettings = SimHashSettings(), doc_id="doc_id",
                   text="text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable)."""
    rows = settle(
        with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "fp",
                         settings).select("doc_id", "fp"), "fingerprints")
    found = grouped(rows, settings)
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"))


def keep_one(docs: DataFrame, settings: SimHashSettings = SimHashSettings(), doc_id="doc_id",
             text="text") -> DataFrame:
    """The documents without near-duplicates: of each component the row with the least id, all columns."""
    name, least = free_name(docs, "fp"), free_name(docs, "least")
    rows = settle(with_fingerprint(docs, text, name, settings), "fingerprinted")
    found = grouped(rows.select(F.col(doc_id).alias("doc_id"), F.col(name).alias("fp")), settings)
    chosen = found.select(F.col("least").alias(least)).distinct()
    return (
        rows.join(chosen, F.col(doc_id).eqNullSafe(F.col(f"{least}.id")) & (F.col(name) == F.col(f"{least}.fp")), "left_semi")
        .dropDuplicates([doc_id, name]).drop(name)
    )
