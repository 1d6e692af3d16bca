import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from rowferry.llm.packing import Bm25Index, Corpus, PackSettings, WordTokenizer, fill_order, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "Don't we'll I've!! it's 'S İstanbul ΣΑΣ. Straße É é \xa0x\x85y\x1cz ª½ 12ab,3 <|endoftext|>, a<|endoftext|>b ß. ÿ!! ŉ ŀ İ",
       "中文。テスト, ok... (a) [b] --- ''' _x_ ​zw \U0001f600!", "word! Word. WORD, wörter; a'b .. ,", "é café café."]


def test_word_by_word_is_the_whole_tokenizer():
    whole, words = Tokenizer.from_file(PATH), WordTokenizer(PATH, 3)
    for _ in range(2):  # the second time after the cache was let go
        found = words.ids(ODD)
        assert [f.tolist() for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in ODD]


def test_round_trip(docs):
    texts = [" ".join(f"word{(i * j) % 50}" for j in range(i * 7)) for i in range(60)] + ODD + [None, "long " * 6000]
    settings = PackSettings(window=256, shard_bytes=6000)
    pieces = pack(docs(list(enumerate(texts))), settings).collect()
    whole, by_doc, by_sequence = Tokenizer.from_file(PATH), collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, text in enumerate(texts):
        ids, at = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4"), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    lengths = []
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        lengths.append(at)
    shards = len({s >> 32 for s in by_sequence})
    assert max(lengths) <= 256 and sum(n < 256 for n in lengths) <= shards


def test_neighbours_fill_the_window():
    documents = [np.array(d) for d in ([1, 2, 3, 9], [4, 5, 6, 9], [1, 2, 3, 3], [4, 5, 6, 6], [7, 8])]
    index = Bm25Index(documents, 1.2, 0.75, 16)
    used = np.zeros(5, bool)
    used[0] = True
    assert index.neighbours(0, used).tolist()[0] == 2
    order = fill_order(np.array([5, 5, 5, 5, 3]), index, 10)
    assert order.tolist()[:2] == [0, 2] and sorted(order.tolist()) == [0, 1, 2, 3, 4]


def test_alike_documents_meet_in_a_shard(docs):
    rng = np.random.default_rng(3)
    topics = [[f"{a}{b}" for b in ("river", "castle", "window", "garden", "silver")] for a in ("zork", "quil", "bram", "vext", "jomp", "plux")]
    texts = [" ".join(rng.choice(topics[i % 6], 30)) + f" common words {i}" for i in range(120)]
    pieces = pack(docs(list(enumerate(texts))), PackSettings(window=256, shard_bytes=6000)).collect()
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces}
    counts = collections.Counter((shard[i], i % 6) for i in range(120))
    assert len({s for s, _ in counts}) > 3
    # a pair of one topic in one shard: by chance one in the number of shards
    pairs = sum(n * (n - 1) for n in counts.values()) / (120 * 19)
    assert pairs > 0.5


def test_counts_of_the_whole_table_weigh_a_shard():
    documents = [np.array(d) for d in ([1, 2], [1, 3], [2, 4])]
    held = np.array([0, 900, 2, 1, 1])
    alone = Bm25Index(documents, 1.2, 0.75, 16)
    assert alone.posting_weight[alone.of_term[1]] == alone.posting_weight[alone.of_term[2]]
    index = Bm25Index(documents, 1.2, 0.75, 16, Corpus(1000, 2.0, held))
    assert index.posting_weight[index.of_term[1]] < index.posting_weight[index.of_term[2]]


def test_rows_alike_are_split_and_partitions_do_not_matter(docs):
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in ("river", "castle", "window", "garden") for b in ("stone", "light", "paper", "field")]
    texts = [" ".join(rng.choice(vocabulary, 20)) for _ in range(400)]
    table = docs(list(enumerate(texts)) + [(9999, "the same row again and again")] * 1200)
    settings = PackSettings(window=256, shard_bytes=8000, sample=500)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    found = [sorted(map(tuple, pack(table.repartition(n), settings).select(*names).collect())) for n in (1, 5)]
    assert found[0] == found[1]
    shards = collections.Counter(sequence >> 32 for _, start, *_, sequence, _ in found[0] if start == 0)
    assert sum(shards.values()) == 1600 and len(shards) > 15
    # a row has at least 64 bytes of the shard's 8,000
    assert max(shards.values()) <= 8000 // 64 + 1
    # of more cuts than are sent, rows learn their shards by a join
    joined = pack(table, PackSettings(window=256, shard_bytes=8000, sample=500, sent_cuts=0)).select(*names)
    assert sorted(map(tuple, joined.collect())) == found[0]


def test_ranking_is_bm25(docs):
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 60, rng.integers(1, 40)) for _ in range(80)]
    index = Bm25Index(documents, 1.2, 0.75, 10_000)
    held = [sum(t in d for d in documents) for t in range(60)]
    mean = sum(map(len, documents)) / 80

    def score(seed, other):
        return sum(
            np.log1p((80 - held[t] + 0.5) / (held[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(other) / mean))
            for t in set(seed.tolist()) if held[t] > 1 and (c := int((other == t).sum())))

    for seed in range(0, 80, 7):
        used = np.zeros(80, bool)
        used[seed] = True
        want = np.array([0 if i == seed else score(documents[seed], d) for i, d in enumerate(documents)])
        found = index.neighbours(seed, used)
        assert sorted(found) == np.flatnonzero(want).tolist()
        assert np.all(np.diff(want[found]) <= 1e-4)


def test_long_words_are_not_kept():
    words = WordTokenizer(PATH, 100)
    words.ids(["x" * 5000 + " short", "a\x1cb" * 100, "Y" * 200 + "!!"])
    assert "short" in words.known and all(len(w) <= 64 for w in words.known)


def test_only_different_stems_and_marks_are_learned():
    words = WordTokenizer(PATH, 100)
    words.ids(["Word. WORD, word Wörter! WÖRTER.", "word... wörter!"])
    assert set(words.known) - {""} == {"word", "wörter", ".", ",", "!", "..."}


def test_arrow_columns_are_tokenised_like_whole_texts():
    whole, words = Tokenizer.from_file(PATH), WordTokenizer(PATH, 1000)
    # every character of one and two bytes, and white space of three, inside and around words
    odd = [chr(c) for c in [*range(1, 0x800), 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x212A]]
    texts = [None, *ODD, None, "", " ", *(f"a{c}B {c}x y{c}" for c in odd), " end\n"]
    for kind in (pa.string(), pa.large_string()):
        found = words.ids(pa.array(["cut off", *texts], kind)[1:])
        assert [f.tolist() for f in found] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert words.ids(pa.array([], kind)) == []
    assert [f.tolist() for f in words.ids([None, ""])] == [[], []]
