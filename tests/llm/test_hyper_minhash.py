import random

import numpy as np
import pytest

from rowferry.llm import hyper_minhash as hm
from rowferry.llm.hyper_minhash import HyperSettings, near_duplicates


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n, component, kept) with every pair of sets compared."""
    sets = [plain_set(text) for _, text in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [d for (d, _), x in zip(rows, label) if x == label[k] and d is not None]
        least = min(ids) if ids and sets[k] else doc
        out.append((doc, len(sets[k]), least, doc == least))
    return sorted(out, key=str)


def corpus(seed=5, sizes=(6, 8, 12, 30, 60, 200, 900)):
    rng = random.Random(seed)
    rows, doc = [], 0
    passage = [f"p{i}" for i in range(60)]
    for n in sizes:
        for _ in range(6):
            base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(500)) for _ in range(n)]
            if rng.random() < 0.3:
                base[n // 2:n // 2] = passage
            for _ in range(8):
                words = list(base)
                for _ in range(rng.randrange(1 + n // 25)):
                    words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
                if rng.random() < 0.3:
                    words += ["tail"] * rng.randrange(3)
                rows.append((rng.randrange(10 ** 6), rng.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (5, "one"), (None, "one"), (None, "alone here"), (None, None)]


@pytest.mark.parametrize("settings", [HyperSettings(), HyperSettings(block_documents=3), HyperSettings(block_shingles=200)])
def test_against_every_pair(docs, settings):
    rows = corpus()
    found = near_duplicates(docs(rows), settings).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str) == brute(rows)


def test_registers():
    rng = np.random.Generator(np.random.PCG64(1))
    for size in (1, 5, 100, 5000):
        hashes = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        want = [0] * 128
        for h in sorted(map(int, hashes), reverse=True):
            bits = format(h, "064b")
            rest = bits[7:]
            zeros = len(rest) - len(rest.lstrip("0"))
            want[int(bits[:7], 2)] = (zeros + 1) << 10 | int((rest[zeros + 1:] + "0" * 10)[:10], 2)
        assert hm.registers(hashes).tolist() == want
        full = hm.densified(np.array([want], np.uint16), hm._probes(3))[0]
        assert (full > 0).all() and set(full.tolist()) == {w for w in want if w}
    assert hm.registers(np.empty(0, np.uint64)).tolist() == [0] * 128
    assert hm.densified(np.zeros((1, 128), np.uint16), hm._probes(3)).sum() == 0


def test_chance_matches():
    """Equal registers of disjoint sets, counted and expected. Few mantissa bits would be many matches."""
    rng = np.random.Generator(np.random.PCG64(2))
    for n, m in ((50, 50), (3000, 200), (4000, 4000)):
        equal = 0
        for _ in range(300):
            a, b = (hm.registers(np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64) << np.uint64(1))) for k in (n, m))
            equal += int(((a == b) & (a > 0)).sum())
        expected = 300 * float(hm.chance_matches(np.array([n]), np.array([m]))[0])
        assert abs(equal - expected) < 4 * expected ** 0.5 + 2


def test_long_and_empty(docs):
    long = " ".join(f"w{i % 9001}" for i in range(200_000))
    found = {r.doc_id: r for r in near_duplicates(docs([(1, long), (2, long + " end"), (3, "x" * 100_000)])).collect()}
    assert found[2].component_id == 1 and not found[2].kept and found[3].kept
    assert found[1].n_shingles == 9001 and found[3].n_shingles == 1
    assert near_duplicates(docs([])).count() == 0
