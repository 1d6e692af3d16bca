"""Packing documents into training windows by lexical retrieval.

All documents are tokenised once, and document frequencies and the mean length are those of the whole
table. A document's most telling terms, projected to a few dimensions, lead it down a tree of means,
which a bounded sample of the documents has grown. Documents are put in the order of the tree's leaves,
then of their heaviest terms, then of a hash of id and text; rows alike in both are interchangeable and
follow one another. Shards of bounded size are cut from that order by running sums of bytes, so neither a
leaf of many documents nor a row repeated a million times makes a large shard, and the partitioning of the
input does not matter. What is found is what the shard holds: neighbours that the order parts are missed,
see the README for how many.

Each shard gets a BM25 inverted index over its token ids, weighed by the table's frequencies. A seed
document asks the index, with its most telling terms, for unused neighbours, which fill its window
greedily, best first; the one that does not fit is cut, and its rest opens the next window as that
window's seed. So all windows but a shard's last are full.

Defined results: null text counts as empty (a document of the end token alone); repeated rows are
packed as often as they occur; equal scores go by the shard's order; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import sys
import types
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rowferry.llm.common import discard, settle

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")
TOKENS = "doc_id long, order long, row long, size long, ids binary, held array<long>"
ROUTED = "doc_id long, row long, size long, ids binary, key binary"
SHARDED = "doc_id long, ids binary, key binary, shard long"
LONG_WORD = 64  # longer words are not kept
SPLITTING = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the tokenizer


@dataclass(frozen=True)
class PackSettings:
    """``shard_bytes`` of text share an index; a seed asks with its ``query_terms`` heaviest terms.

    Shards are cut from an order by a tree of means of up to ``branches`` children, over vectors of
    ``dimensions``, then by the ``route_terms`` heaviest terms. The tree comes from a sample of at most about
    ``sample`` documents, at least ``leaf_sample`` a leaf. Up to ``sent_cuts`` cuts go to the tasks; of more,
    rows learn their shards by a join.
    """

    window: int = 2048
    end_id: int = 1
    tokenizer: str | None = None
    shard_bytes: int = 4 << 20
    query_terms: int = 16
    route_terms: int = 8
    sample: int = 32_768
    leaf_sample: int = 8
    sent_cuts: int = 200_000
    dimensions: int = 64
    branches: int = 32
    k1: float = 1.2
    b: float = 0.75
    cached_words: int = 1_000_000


# Latin letters that composing leaves alone and whose lower case is one letter, then ASCII marks but the apostrophe;
# for Python and for Arrow.
PLAIN = ("^(?P<stem>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*)"
         "(?P<marks>[!-&(-/:-@\\[-`{-~]*)$")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else the next free one."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of whole texts, word by word, for lower-casing byte-level tokenizers that split words from
    marks and never join words across white space.

    Arrow splits the texts, finds their different words and parts each into a stem of plain letters, in lower
    case, and the marks after it, a word of their own. Python sees different stems and marks only; their ids
    are kept. A stem goes straight to the merges, any other word and marks through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known = Tokenizer.from_file(path), limit, {}
        self.merges, self.letters, self.stem = self.tokenizer.model, byte_letters(), re.compile(PLAIN)

    @classmethod
    def of_process(cls, path: str, limit: int) -> WordTokenizer:
        """One per Python worker, kept between its tasks."""
        kept = sys.modules.setdefault("_rowferry_tokenizers", types.ModuleType("_rowferry_tokenizers"))
        if (path, limit) not in kept.__dict__:
            kept.__dict__[path, limit] = cls(path, limit)
        return kept.__dict__[path, limit]

    def _merged(self, stem: str) -> bytes:
        if not stem.isascii():
            stem = "".join(map(self.letters.__getitem__, stem.encode()))
        return array("I", [token.id for token in self.merges.tokenize(stem)]).tobytes()

    def _learned(self, parts: list[str]) -> list[bytes]:
        learned, others = {}, []
        for part in parts:
            match = self.stem.fullmatch(part)
            if match is None or match["marks"]:
                others.append(part)
            else:
                learned[part] = self._merged(part)
        encoded = self.tokenizer.encode_batch(others, add_special_tokens=False)
        learned.update((part, array("I", e.ids).tobytes()) for part, e in zip(others, encoded))
        self.known.update((part, ids) for part, ids in learned.items() if len(part) <= LONG_WORD)
        return [learned[part] for part in parts]

    def _of_parts(self, parts: pa.Array) -> pa.Array:
        """The ids of each of ``parts``: stems in lower case, marks, or words that are neither."""
        encoded = parts.dictionary_encode()
        different = encoded.dictionary.to_pylist()
        found = list(map(self.known.get, different))
        learned = iter(self._learned([part for part, ids in zip(different, found) if ids is None]))
        found = [next(learned) if ids is None else ids for ids in found]
        return pa.array(found, pa.large_binary()).take(encoded.indices)

    def ids(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        # texts with what only Python and Arrow call white space are for the whole tokenizer
        apart = pc.match_substring_regex(texts, f"[{SPLITTING}]")
        split = pc.utf8_split_whitespace(pc.if_else(apart, "", texts))
        encoded = split.flatten().dictionary_encode()
        words = encoded.dictionary
        parted = pc.extract_regex(words, PLAIN)
        if len(self.known) > self.limit:
            self.known.clear()
        of_words = pc.binary_join_element_wise(
            self._of_parts(pc.coalesce(pc.utf8_lower(pc.struct_field(parted, "stem")), words)),
            self._of_parts(pc.fill_null(pc.struct_field(parted, "marks"), "")), pa.scalar(b"", pa.large_binary()))
        _, starts, ids = of_words.take(encoded.indices).buffers()
        ids = np.frombuffer(ids or b"", dtype=np.uint32)
        bounds = (np.frombuffer(starts, dtype=np.int64)[split.offsets.to_numpy()] // 4).tolist()
        found = [ids[low:high] for low, high in zip(bounds, bounds[1:])]
        for place in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            whole = self.tokenizer.encode(texts[place].as_py(), add_special_tokens=False)
            found[place] = np.array(whole.ids, dtype=np.uint32)
        return found


@dataclass(frozen=True)
class Corpus:
    """What BM25 counts over a whole table: documents, their mean length, the documents that hold each term."""

    n: int
    mean: float
    held: np.ndarray

    def idf(self) -> np.ndarray:
        return np.log1p((self.n - self.held + 0.5) / (self.held + 0.5))


def term_counts(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, and by document and term: owner, term, count)."""
    n = len(documents)
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    terms = np.concatenate(documents) if n else np.empty(0, np.int64)
    span = int(terms.max(initial=0)) + 1
    kind = np.uint32 if n * span < 1 << 32 else np.int64  # narrow numbers sort faster
    pairs = np.repeat(np.arange(n, dtype=kind) * kind(span), sizes)
    pairs += terms.astype(kind)
    pairs.sort()
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.empty(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(pairs)])))
    owner, term = np.divmod(pairs[first], kind(span))
    return sizes, owner.astype(np.int64), term.astype(np.int64), counts


def term_weights(sizes, owner, term, counts, idf, mean, k1, b) -> np.ndarray:
    norm = k1 * (1 - b + b * sizes / max(1.0, mean))
    return (idf[term] * counts * (k1 + 1) / (counts + norm[owner])).astype(np.float32)


class Bm25Index:
    """BM25 over the token ids of a shard's documents, weighed by the counts of ``corpus``, else by their own."""

    def __init__(self, documents: list[np.ndarray], k1: float, b: float, query_terms: int, corpus: Corpus | None = None):
        n = len(documents)
        sizes, owner, term, counts = term_counts(documents)
        span = int(term.max(initial=0)) + 1
        held = np.bincount(term, minlength=span)
        corpus = corpus or Corpus(n, sizes.mean() if n else 1.0, held)
        weight = term_weights(sizes, owner, term, counts, corpus.idf(), corpus.mean, k1, b)
        self.n, self.query_terms = n, query_terms
        self.of_document = np.searchsorted(owner, np.arange(n + 1))
        self.term, self.weight = term, weight
        # a term that only one document holds finds nobody
        self.telling = np.where(held[term] > 1, weight, np.float32(0))
        order = np.argsort(term.astype(np.uint16) if span <= 1 << 16 else term, kind="stable")
        self.postings, self.posting_weight = owner[order], weight[order]
        self.of_term = np.searchsorted(term[order], np.arange(span + 1))

    def neighbours(self, document: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share the document's most telling terms, best first."""
        low, high = self.of_document[document], self.of_document[document + 1]
        telling = self.telling[low:high]
        if len(telling) > self.query_terms:
            chosen = np.argpartition(-telling, self.query_terms)[: self.query_terms]
        else:
            chosen = np.arange(len(telling))
        terms = self.term[low:high][chosen[telling[chosen] > 0]]
        if not len(terms):
            return np.empty(0, np.int64)
        ranges = [slice(self.of_term[t], self.of_term[t + 1]) for t in terms]
        scores = np.bincount(
            np.concatenate([self.postings[r] for r in ranges]),
            np.concatenate([self.posting_weight[r] for r in ranges]), self.n)
        scores[used] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def fill_order(sizes: np.ndarray, index: Bm25Index, window: int) -> np.ndarray:
    """The order in which documents follow one another through the windows."""
    order, filled, next_free = [], 0, 0
    used = np.zeros(len(sizes), dtype=bool)

    def place(document: int) -> None:
        nonlocal filled
        used[document] = True
        order.append(document)
        filled += int(sizes[document])

    while len(order) < len(sizes):
        if filled % window == 0 or not found:
            # a window without a rest to go on from, or without neighbours: the next free document
            while used[next_free]:
                next_free += 1
            place(next_free)
        # the last document placed is the seed: it opens this window, or its rest does
        window_end = -(-filled // window) * window
        found = False
        if filled < window_end:
            for other in index.neighbours(order[-1], used):
                place(int(other))
                found = True
                if filled >= window_end:
                    break
    return np.array(order, dtype=np.int64)


@lru_cache(maxsize=2)
def directions(terms: int, dimensions: int) -> np.ndarray:
    """A fixed random direction for each term."""
    return np.random.default_rng(1).standard_normal((terms, dimensions), dtype=np.float32)


def signatures(documents: list[np.ndarray], orders: list[int], corpus: Corpus,
               settings: PackSettings) -> tuple[np.ndarray, list[bytes]]:
    """Each document's vector of length one, and its heaviest terms, heaviest first, then its hash. Terms that
    no other document holds do not count."""
    sizes, owner, term, counts = term_counts(documents)
    weight = term_weights(sizes, owner, term, counts, corpus.idf(), corpus.mean, settings.k1, settings.b)
    shared = corpus.held[term] > 1
    owner, term, weight = owner[shared], term[shared], weight[shared]
    of_document = np.searchsorted(owner, np.arange(len(documents) + 1)).tolist()
    heavy = []
    for low, high in zip(of_document, of_document[1:]):
        own = -weight[low:high]
        best = np.arange(len(own))
        if len(own) > settings.query_terms:
            best = np.sort(np.argpartition(own, settings.query_terms)[: settings.query_terms])
        heavy.append(low + best[np.argsort(own[best], kind="stable")])
    heavy = np.concatenate(heavy) if heavy else np.empty(0, np.int64)
    owner, term, weight = owner[heavy], term[heavy], weight[heavy]
    vectors = np.zeros((len(documents), settings.dimensions), dtype=np.float32)
    of_document = np.searchsorted(owner, np.arange(len(documents) + 1))
    if len(owner):
        filled = np.flatnonzero(np.diff(of_document))
        scaled = directions(len(corpus.held), settings.dimensions)[term] * weight[:, None]
        vectors[filled] = np.add.reduceat(scaled, of_document[filled], axis=0)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.float32(1e-9))
    written, keys = term.astype(">u4"), []
    for document, hashed in enumerate(orders):
        low = of_document[document]
        terms = written[low: min(of_document[document + 1], low + settings.route_terms)].tobytes()
        keys.append(terms.ljust(4 * settings.route_terms, b"\xff") + (hashed + (1 << 63)).to_bytes(8, "big"))
    return vectors, keys


class MeansTree:
    """Means of means: each vector goes to the child whose mean it is most like. ``leaves`` count from ``first``."""

    def __init__(self, vectors: np.ndarray, branches: int, leaf_size: int, first: int = 0, rounds: int = 10):
        self.first, self.children, self.leaves, n = first, [], 1, len(vectors)
        if n <= 2 * leaf_size:
            return
        k = min(branches, -(-n // leaf_size))
        self.means = vectors[np.random.default_rng(1).choice(n, k, replace=False)]
        for _ in range(rounds):
            nearest = (vectors @ self.means.T).argmax(axis=1)
            sums = np.zeros_like(self.means)
            np.add.at(sums, nearest, vectors)
            sums = sums[np.bincount(nearest, minlength=len(sums)) > 0]
            self.means = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), np.float32(1e-9))
        nearest = (vectors @ self.means.T).argmax(axis=1)
        if np.bincount(nearest).max() == n:  # all alike
            return
        self.leaves = 0
        for child in range(len(self.means)):
            self.children.append(MeansTree(vectors[nearest == child], branches, leaf_size, first + self.leaves, rounds))
            self.leaves += self.children[-1].leaves

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        if not self.children or not len(vectors):
            return np.full(len(vectors), self.first, dtype=np.int64)
        nearest, out = (vectors @ self.means.T).argmax(axis=1), np.empty(len(vectors), dtype=np.int64)
        for child in np.unique(nearest):
            own = nearest == child
            out[own] = self.children[child].leaf(vectors[own])
        return out


def route_keys(tree: MeansTree, vectors: np.ndarray, keys: list[bytes]) -> list[bytes]:
    """Where each document stands among all."""
    return [int(leaf).to_bytes(4, "big") + key for leaf, key in zip(tree.leaf(vectors), keys)]


def leaf_shifts(totals: list[tuple[bytes, int]], shard_bytes: int) -> list[tuple[bytes, int]]:
    """How many bytes each leaf moves up, so that a leaf that fits into a shard is not cut."""
    at, moved, out = 0, 0, []
    for leaf, size in sorted(totals):
        room = -at % shard_bytes
        if room < size <= shard_bytes:
            at, moved = at + room, moved + room
        out.append((leaf, moved))
        at += size
    return out


def place_rows(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """(key, row, shard) of each of ``rows`` (key, row, size): shards cut from the order of key and row by bytes.

    Rows are sorted across tasks, each task's part has a running sum of its own, and the sums of the parts
    before it, one number per task, are added. Leaves are as few as the tree's sample allows.
    """
    spark = rows.sparkSession
    parts = settle(rows.orderBy("key", "row").select(
        "*", F.substring("key", 1, 4).alias("leaf"), F.spark_partition_id().alias("part")), "packing-order")
    upto, starts = 0, []
    for part, size in sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.sum("size").alias("n")).collect()):
        starts.append((part, upto))
        upto += size
    totals = [(bytes(r["leaf"]), r["n"]) for r in parts.groupBy("leaf").agg(F.sum("size").alias("n")).collect()]
    starts = spark.createDataFrame(starts, "part int, start long")
    shifts = spark.createDataFrame(leaf_shifts(totals, shard_bytes), "leaf binary, shift long")
    within = F.sum("size").over(Window.partitionBy("part").orderBy("key", "row"))
    before = F.col("start") + F.col("shift") + F.col("within") - F.col("size")
    return parts.withColumn("within", within).join(starts, "part").join(shifts, "leaf").select(
        "key", "row", F.floor(before / F.lit(shard_bytes)).alias("shard"))


def _pieces(batches, column: int, size: int):
    """The batches in slices whose ``column`` holds about ``size`` bytes, so a task holds few documents at a time."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(1, batch.column(column).nbytes)))
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _arrays(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=kind) for v in column.to_pylist()]


def _tokenise(batches, settings: PackSettings, path: str, kind: str, terms: int):
    """Each document's ids; in the end one row that tells how many documents held each term."""
    tokenizer = WordTokenizer.of_process(path, settings.cached_words)
    held, last = np.zeros(terms, dtype=np.int64), np.zeros(terms, dtype=np.int64)
    names = [part.split()[0] for part in TOKENS.split(", ")]
    for batch in _pieces(batches, 4, settings.shard_bytes):
        bodies = tokenizer.ids(batch.column(4))
        for body in bodies:
            places = np.arange(len(body))
            last[body] = places
            held[body[last[body] == places]] += 1  # each term once
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array([b.astype(kind).tobytes() for b in bodies], pa.binary()),
             pa.nulls(len(bodies), pa.list_(pa.int64()))], names=names)
    nothing = [pa.nulls(1, pa.int64())] * 4
    yield pa.RecordBatch.from_arrays(
        [*nothing, pa.array([None], pa.binary()), pa.array([held], pa.list_(pa.int64()))], names=names)


def _sign(batches, settings: PackSettings, kind: str, corpus: Corpus):
    for batch in _pieces(batches, 1, settings.shard_bytes // 2):
        vectors, _ = signatures(_arrays(batch.column(1), kind), batch.column(0).to_pylist(), corpus, settings)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["order", "vector"])


def _route(batches, settings: PackSettings, kind: str, corpus: Corpus, tree: MeansTree):
    for batch in _pieces(batches, 4, settings.shard_bytes // 2):
        bodies = _arrays(batch.column(4), kind)
        keys = route_keys(tree, *signatures(bodies, batch.column(1).to_pylist(), corpus, settings))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *batch.columns[2:5], pa.array(keys, pa.binary())],
            names=["doc_id", "row", "size", "ids", "key"])


def _shard(batches, cuts: list[tuple[bytes, int]]):
    """``cuts``: the last (key, row) of each shard but the last one."""
    for batch in batches:
        places = zip(batch.column(3).to_pylist(), batch.column(1).to_pylist())
        shards = pa.array([bisect.bisect_left(cuts, place) for place in places], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), shards], names=["doc_id", "ids", "key", "shard"])


def _pack(key, table: pa.Table, settings: PackSettings, kind: str, corpus: Corpus) -> pa.Table:
    table = table.sort_by([("key", "ascending")])
    ids = table.column("doc_id").to_pylist()
    end = np.array([settings.end_id], dtype=np.uint32)
    bodies = [body.astype(np.uint32) for body in _arrays(table.column("ids"), kind)]
    sizes = np.array([len(b) + 1 for b in bodies], dtype=np.int64)
    index = Bm25Index(bodies, settings.k1, settings.b, settings.query_terms, corpus)
    order = fill_order(sizes, index, settings.window)
    rows, at, first = [], 0, int(key[0].as_py()) << 32
    for document in order.tolist():
        whole = np.concatenate((bodies[document], end))
        start, total = 0, len(whole)
        while start < total:
            sequence, offset = divmod(at, settings.window)
            size = min(total - start, settings.window - offset)
            rows.append((ids[document], start, size, zlib.crc32(whole[start: start + size]), total,
                         first + sequence, offset))
            start += size
            at += size
    columns = list(zip(*rows)) if rows else [[]] * 7
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.table({name: pa.array(values, pa.int64()) for name, values in zip(names, columns)})


def pack(docs: DataFrame, settings: PackSettings = PackSettings(), doc_id="doc_id", text="text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = settings.tokenizer
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    terms = max(Tokenizer.from_file(path).get_vocab().values()) + 1
    kind = "<u2" if terms <= 1 << 16 else "<u4"
    # a number of its own for each row, spread over all numbers; it only tells rows alike in id and text apart
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("order"),
        F.xxhash64(F.monotonically_increasing_id()).alias("row"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 64).cast("long").alias("size"), F.col(text).alias("text"))
    read = settle(rows.mapInArrow(
        partial(_tokenise, settings=settings, path=path, kind=kind, terms=terms), TOKENS), "packing-tokens")
    tokens = read.where(F.col("order").isNotNull()).drop("held")
    n, size, most = tokens.agg(F.count(F.lit(1)), F.sum("size"), F.sum(F.octet_length("ids"))).first()
    # one row per term of the vocabulary
    held = np.zeros(terms, dtype=np.int64)
    for row in (read.where(F.col("order").isNull()).select(F.posexplode("held")).where("col > 0")
                .groupBy("pos").agg(F.sum("col").alias("n")).collect()):
        held[row["pos"]] = row["n"]
    corpus = Corpus(n, (most or 0) / np.dtype(kind).itemsize / max(1, n), held)
    shards = max(1, -(-(size or 0) // settings.shard_bytes))
    known = {"settings": settings, "kind": kind, "corpus": corpus}

    def pack_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _pack(key, table, settings, kind, corpus)

    # rows alike in id and text come into the sample once
    found = [] if shards == 1 else (
        tokens.where(F.pmod("order", F.lit(-(-n // settings.sample))) == 0)
        .groupBy("order").agg(F.any_value("ids").alias("ids"))
        .mapInArrow(partial(_sign, **known), "order long, vector binary").collect())
    vectors = np.frombuffer(b"".join(r["vector"] for r in sorted(found)), dtype=np.float32)
    vectors = vectors.reshape(-1, settings.dimensions)
    tree = MeansTree(vectors, settings.branches, max(settings.leaf_sample, -(-len(vectors) // shards)))
    routed = settle(tokens.mapInArrow(partial(_route, **known, tree=tree), ROUTED), "packing-routed")
    discard(read)
    placed = place_rows(routed.select("key", "row", "size"), settings.shard_bytes)
    if shards <= settings.sent_cuts:
        ends = placed.groupBy("shard").agg(F.max(F.struct("key", "row")).alias("end")).select("shard", "end.key", "end.row")
        cuts = [(bytes(r["key"]), r["row"]) for r in sorted(ends.collect())][:-1]
        sharded = routed.select("doc_id", "row", "ids", "key").mapInArrow(partial(_shard, cuts=cuts), SHARDED)
    else:
        sharded = routed.join(placed.select("row", "shard"), "row").select("doc_id", "ids", "key", "shard")
    return sharded.groupBy("shard").applyInArrow(pack_shard, SCHEMA)
