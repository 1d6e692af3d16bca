import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm.filter_audit import AuditSettings, audit, difference, gallop, union


def failing(rows):
    """Per row the letters it fails, plainly."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows):
            fails.add("E")
        out.append(fails)
    return out


def brute(rows, labels):
    fails, out = failing(rows), []
    positive = [{d for d, *flags in labels if d is not None and flags[k] == 1} for k in (0, 1)]
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                lines.append([part, "".join(order), step, len(left), len(gone),
                              sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                              *(sum(d in p for d, _ in gone) for p in positive), letter])
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out)


def corpus():
    rng, rows = random.Random(4), []
    texts = [" ".join(rng.choice(["Abc", "de", "f#", "gh", "ijk", f"w{i}"]) if rng.random() < p else f"v{i}" for i in range(n))
             for n in (0, 1, 150, 199, 200, 300) for p in (0.02, 0.5, 1)] + [None, "", " \n\t", "É" * 10 + "A" * 3]
    for k in range(120):
        rows.append((rng.choice([None, k, k % 40]), rng.choice(texts), rng.choice(["one", "two", None, ""])))
    return rows + rows[:10]


@pytest.mark.parametrize("size", [65_536, 7])
def test_against_every_order(spark, docs, size):
    rows = corpus()
    rng = random.Random(1)
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(60)] + [(None, 1, 1), (3, 1, 1), (3, 0, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = docs(rows).withColumns({c: F.lit(1) for c in ("part", "id", "h", "bits", "n", "first", "good", "filter")})
    found = audit(frame, table, AuditSettings(range_rows=size)).collect()
    assert sorted(map(tuple, found)) == brute(rows, labels)


def test_empty(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs([]), labels).count() == 0
    assert audit(docs([(1, "a b")]), labels).count() == 600


def test_merges():
    rng = np.random.Generator(np.random.PCG64(3))
    for _ in range(60):
        lists = [np.unique(rng.integers(0, int(rng.integers(1, 9000)), int(rng.integers(0, 5000)))) for _ in range(4)]
        rest = set().union(*(x.tolist() for x in lists[1:]))
        assert difference(lists[0], lists[1:]).tolist() == sorted(set(lists[0].tolist()) - rest)
        assert union(lists).tolist() == sorted(rest | set(lists[0].tolist()))
        for target in rng.integers(-1, 9001, 5):
            start = int(rng.integers(0, len(lists[0]) + 1))
            assert gallop(lists[0], start, target) == start + int(np.searchsorted(lists[0][start:], target))
