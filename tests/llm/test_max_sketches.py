import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm.max_sketches import SketchSettings, coordinate, impact, search, sketch, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    counts = [(d, Counter(plain_terms(t))) for d, t in rows]
    counts = [(d, c, c.total()) for d, c in counts if c]
    n, length = len(counts), sum(x for *_, x in counts)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in queries.items():
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c, _ in counts) + 1))) for t in terms}
        scored = []
        for d, c, size in counts:
            m = 10 + 90 * size * n // length
            score = sum(weight[t] * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=str)


def corpus(n=400):
    rng, rows = random.Random(8), []
    words = [f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(4000)] + ["É", "naïve", "it's", "X-ray", "a_b", "中文"]
    for k in range(n):
        rows.append((k, rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(120)))))
    rows += [(None, rows[3][1]), (None, "w1"), (5000, rows[3][1]), (5000, rows[3][1]), (5001, None), (5002, ""), (5003, "-- !"),
             (5004, "w1 " * 30_000)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for k in range(40)]
    return rows, items + [(3, "w1 w2"), (50, None), (51, "unknown"), (None, "w1 naïve"), (52, "")]


@pytest.mark.parametrize("settings", [SketchSettings(), SketchSettings(coordinates=8, slice_documents=5, block_terms=60)])
def test_against_every_document(spark, docs, settings):
    rows, items = corpus()
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    extra = docs(rows).repartition(7).withColumns({c: F.lit(1) for c in ("item_id", "score", "query", "part", "rank")})
    found = search(extra, frame, settings).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, items)


def test_nothing_to_find(spark, docs):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert search(docs([]), items).count() == 0
    assert search(docs([(1, None), (2, "")]), items).count() == 0
    assert search(docs([(1, "word")]), items.where("false")).count() == 0
    # a term of every document of a large table weighs nothing
    assert search(docs([(k, "word") for k in range(2000)]), items).count() == 0


def test_bounds_hold():
    rows, items = corpus()
    counts = [Counter(terms_of(t)) for _, t in rows]
    norms = np.arange(10, 10 + len(counts))
    found = sketch(counts, norms, 16)
    for _, text in items:
        for term in set(terms_of(text)):
            exact = np.array([impact(c[term], m) for c, m in zip(counts, norms)])
            assert (found[coordinate(term, 16)] >= exact).all()
    assert [t.encode() for t in plain_terms("Ab1 É-x_y\x7fZ中文")] == terms_of("Ab1 É-x_y\x7fZ中文")
