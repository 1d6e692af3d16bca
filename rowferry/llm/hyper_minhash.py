"""Near-duplicates of word shingles by HyperMinHash.

A document's distinct shingles are hashed into buckets. A bucket's register keeps the leading-zero count of
its least hash and the mantissa bits after them, 16 bits in all. Empty buckets borrow another's register for
banding (optimal densification), so short documents band as reliably as long ones. A band of four registers
is one 64-bit key.

Documents that share a band are compared by their registers: the share of equal registers, less the equal
ones expected by chance for two sets of these sizes, estimates the similarity. What is not clearly below the
threshold is verified on the full shingle sets. A pair is taken up in the first band it shares, and nowhere else.

No pair is ever a row. Sets are compared inside tasks: those of one band key in blocks of a bounded number of
documents and shingles, a task per pair of blocks. The first round keeps the memberships that have a likely
partner, the second brings the sets of these documents and gives a forest of verified links. So a crowded band
costs comparisons in memory, spread over tasks, and its rows stay in proportion to its members.

With 32 bands of four, a pair of similarity 0.85 shares none with probability 6e-11, more similar ones with less.

Defined results: null texts and texts without words have an empty set, link with nothing and are their own
component. Documents of one set are one class and compared once. A row without an id takes its component's
least id, null if there is none, and is kept only then. Repeated rows share a component and are kept or not
together. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowferry.llm.common import settle
from rowferry.llm.components import components

BUCKETS, BUCKET_BITS, MANTISSA = 128, 7, 10
PER_BAND = 4  # registers of 16 bits in a band's 64-bit key
BANDS = BUCKETS // PER_BAND
REST = 64 - BUCKET_BITS
PROBES = 64
SLICE = 256  # documents prepared at once


@dataclass(frozen=True)
class HyperSettings:
    """Linked at ``percent`` of the union. A block holds about so many documents and shingles.

    Estimates count as clearly below the threshold from ``sigmas`` standard deviations on."""

    words: int = 5
    percent: int = 85
    sigmas: float = 6.0
    seed: int = 42
    block_documents: int = 1024
    block_shingles: int = 4_000_000


def shingle_set(text: str | None, width: int, seed: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and ASCII white space only, as wanted
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(w, seed) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    # a word's place in the shingle turns and mixes its hash, so order matters
    mixed = np.full(count, width, np.uint64)
    for k in range(width):
        mixed = _scramble(mixed + hashes[k: k + count])
    return np.unique(mixed)


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def registers(hashes: np.ndarray) -> np.ndarray:
    """16-bit registers of sorted hashes: 0 for an empty bucket, else (leading zeros + 1, mantissa)."""
    out = np.zeros(BUCKETS, np.uint16)
    buckets = (hashes >> np.uint64(REST)).astype(np.int64)
    first = np.flatnonzero(np.diff(buckets, prepend=-1))  # the least hash of each bucket that has any
    least = hashes[first] & np.uint64((1 << REST) - 1)
    zeros = REST - np.frexp(least.astype(np.float64))[1].astype(np.int64)
    zeros = np.minimum(zeros, REST - 1)
    tail = (least << (zeros + 1).astype(np.uint64)) & np.uint64((1 << REST) - 1)
    mantissa = (tail >> np.uint64(REST - MANTISSA)).astype(np.int64)
    out[buckets[first]] = ((zeros + 1) << MANTISSA | mantissa).astype(np.uint16)
    return out


def _probes(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, BUCKETS, (PROBES, BUCKETS))


def densified(regs: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Every empty register of each row borrows the first occupied one of its own sequence of buckets."""
    out = regs.copy()
    for probe in [*probes, *[(np.arange(BUCKETS) + k) % BUCKETS for k in range(1, BUCKETS)]]:
        empty = out == 0
        rows = empty.any(axis=1) & regs.any(axis=1)
        if not rows.any():
            break
        borrowed = regs[rows][:, probe]
        out[rows] = np.where(empty[rows], borrowed, out[rows])
    return out


def _prepare(batches, settings: HyperSettings, with_set: bool):
    """Per row: id, shingles, and for non-empty sets a digest, band keys and the empty buckets."""
    import xxhash

    probes = _probes(settings.seed)
    for batch in batches:
        texts = batch.column("text")
        for at in range(0, len(texts), SLICE):
            ids, part = batch.column("id").slice(at, SLICE), texts.slice(at, SLICE)
            sizes, digests, regs, raw = [], [], [], []
            for text in part:
                found = shingle_set(text.as_py(), settings.words, settings.seed)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes(), settings.seed) if len(found) else None)
                raw.append(found.tobytes() if with_set else b"")
                regs.append(registers(found))
            if with_set:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], names=["cls", "hashes"])
                continue
            plain = np.array(regs)
            keys = densified(plain, probes).view(np.int64)
            empties = np.packbits(plain == 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys.tolist(), pa.list_(pa.int64())), pa.array([e.tobytes() for e in empties], pa.binary())],
                names=["id", "n", "cls", "keys", "empties"])


# --- comparing what shares a band ---------------------------------------------------------------


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers expected equal by chance for disjoint sets of these sizes.

    A bucket of n of the hashes has a least value of density a*exp(-a*x) with a = n / buckets; two of them
    fall into one cell of width w at x with density w*a*b*exp(-(a+b)*x). Cells of one leading-zero count
    have one width, so the integral over each is a difference of exponentials."""
    a, b = np.asarray(n, float) / BUCKETS, np.asarray(m, float) / BUCKETS
    low = 2.0 ** -np.arange(1.0, REST + 1)[:, None]
    mass = np.exp(-(a + b) * low) - np.exp(-2 * (a + b) * low)
    return BUCKETS * 2.0 ** -MANTISSA * a * b / (a + b) * (low * mass).sum(axis=0)


class Members:
    """Documents of one band key: sizes, band keys, registers, and where known the sets."""

    def __init__(self, batch: pa.Table):
        get = lambda name: batch.column(name)
        self.n = get("n").to_numpy()
        rows = len(self.n)
        self.keys = np.asarray(get("keys").combine_chunks().flatten()).reshape(rows, BANDS)
        empties = np.frombuffer(b"".join(get("empties").to_pylist()), np.uint8).reshape(rows, -1)
        self.occupied = np.unpackbits(empties, axis=1) == 0
        self.registers = np.where(self.occupied, np.ascontiguousarray(self.keys).view(np.uint16), 0)
        self.own = get("own").to_numpy()


def likely_pairs(found: Members, band: int, left: int, right: int, settings: HyperSettings):
    """(a, b, estimate) of the pairs between two blocks (or within one) that share this band first and may
    reach the threshold."""
    a_rows, b_rows = np.flatnonzero(found.own == left), np.flatnonzero(found.own == right)
    step = max(1, (1 << 22) // (BANDS * max(1, len(b_rows))))
    for at in range(0, len(a_rows), step):
        part = a_rows[at: at + step]
        n, m = found.n[part][:, None], found.n[b_rows][None]
        fits = 100 * np.minimum(n, m) >= settings.percent * np.maximum(n, m)
        if left == right:
            fits &= part[:, None] < b_rows[None]
        for earlier in range(band):
            fits &= found.keys[part, earlier][:, None] != found.keys[b_rows, earlier][None]
        x, y = np.nonzero(fits)
        for cut in range(0, len(x), 1 << 13):
            a, b = part[x[cut: cut + (1 << 13)]], b_rows[y[cut: cut + (1 << 13)]]
            either = (found.occupied[a] | found.occupied[b]).sum(axis=1)
            # an empty register is 0 on both sides only where neither set has the bucket
            equal = (found.registers[a] == found.registers[b]).sum(axis=1) - (BUCKETS - either)
            similarity = (equal - chance_matches(found.n[a], found.n[b])) / either
            share = settings.percent / 100
            good = similarity + settings.sigmas * np.sqrt(share * (1 - share) / either) >= share
            yield a[good], b[good], similarity[good]


def verified(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` of their union."""
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _groups(batches):
    """Runs of rows with equal (band, key, left, right), which Spark has brought and sorted together."""
    held, last = [], None
    names = ("band", "key", "left", "right")
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in names]
        changes = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changes |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            group = tuple(int(c[start]) for c in columns)
            if held and group != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = group
    if held:
        yield last, pa.Table.from_batches(held)


GROUP = "band int, key long, left int, right int, own int, cls binary"


def _likely(batches, settings: HyperSettings):
    """Memberships with a likely partner."""
    for (band, key, left, right), table in _groups(batches):
        found = Members(table)
        chosen = np.zeros(len(found.n), bool)
        for a, b, _ in likely_pairs(found, band, left, right, settings):
            chosen[a] = chosen[b] = True
        if chosen.any():
            yield from table.select(["band", "key", "left", "right", "own", "cls"]).filter(pa.array(chosen)).to_batches()


def _forest(batches, settings: HyperSettings):
    """Verified links that join what no link before has joined, the likeliest pairs first."""
    for (band, key, left, right), table in _groups(batches):
        found, names = Members(table), table.column("cls").to_pylist()
        sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        parts = [np.concatenate(c) for c in zip(*likely_pairs(found, band, left, right, settings))]
        if not parts:
            continue
        above = list(range(len(names)))

        def top(x):
            while above[x] != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        links = []
        for k in np.argsort(-parts[2], kind="stable").tolist():
            a, b = int(parts[0][k]), int(parts[1][k])
            x, y = top(a), top(b)
            if x != y and verified(sets[a], sets[b], settings.percent):
                above[x] = y
                links.append((names[a], names[b]))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])


def set_links(docs: DataFrame, classes: DataFrame, settings: HyperSettings) -> DataFrame:
    """(a, b) for classes: a forest of the links in each band. ``docs`` has id and text."""
    spread = lambda df: df.repartition("band", "key", "left", "right").sortWithinPartitions(
        "band", "key", "left", "right")
    sketched = classes.select("cls", "n", "keys", "empties")
    memberships = classes.select("cls", "n", F.posexplode("keys").alias("band", "key"))
    crowds = memberships.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("shingles")).where("c > 1")
    blocks = F.ceil(F.greatest(F.col("c") / settings.block_documents, F.col("shingles") / settings.block_shingles)).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    placed = memberships.join(crowds, ["band", "key"]).withColumn("blocks", blocks).withColumn("own", own).select(
        "cls", "band", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("band", "key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "cls")
    columns = ["band", "key", "left", "right", "own", "cls", "n", "keys", "empties"]
    likely = settle(
        spread(placed.join(sketched, "cls").select(*columns)).mapInArrow(partial(_likely, settings=settings), GROUP), "likely")
    # full sets for the documents with a likely partner only, made from their texts again
    wanted = classes.join(likely.select("cls").distinct(), "cls", "left_semi").select("id").distinct()
    sets = docs.join(wanted, docs["id"].eqNullSafe(wanted["id"]), "left_semi").mapInArrow(
        partial(_prepare, settings=settings, with_set=True), "cls binary, hashes binary")
    full = settle(sets.where("cls is not null").dropDuplicates(["cls"]), "sets")
    return spread(likely.join(sketched, "cls").join(full, "cls").select(*columns, "hashes")).mapInArrow(
        partial(_forest, settings=settings), "a binary, b binary")


def near_duplicates(docs: DataFrame, settings: HyperSettings = HyperSettings(), doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable), kept."""
    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = dict(plain.dtypes)["id"]
    rows = settle(plain.mapInArrow(
        partial(_prepare, settings=settings, with_set=False),
        f"id {kind}, n long, cls binary, keys array<long>, empties binary"), "registers")
    classes = settle(rows.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.first("empties").alias("empties")), "classes")
    labels = components(settle(set_links(plain, classes, settings), "verified"))
    labelled = classes.select("cls", "id").join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "id", F.coalesce("label", "cls").alias("label"))
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    found = labelled.join(least, "label").select("cls", "component_id")
    some = rows.where("cls is not null").join(found, "cls").select("id", "n", "component_id")
    none = rows.where("cls is null").select("id", "n", F.col("id").alias("component_id"))
    return some.unionByName(none).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
