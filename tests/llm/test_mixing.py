import collections

import pytest
from pyspark.sql import functions as F

from rowferry.llm.mixing import MixTarget, find_exponent, mix, mixed_documents


def rows(sizes):
    out, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            out.append((at, " ".join(["w"] * (1 + at % 7)), source))
            at += 1
    return out


def shares(spark, values):
    return spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(values)], "source string, share double")


def test_exponent_meets_the_repetition_limit(spark):
    totals = shares(spark, [0.7, 0.2, 0.1])
    a = find_exponent(totals, MixTarget(max_repeats=1.5))
    repeats = [s ** a / s / sum(x ** a for x in (0.7, 0.2, 0.1)) for s in (0.7, 0.2, 0.1)]
    assert max(repeats) == pytest.approx(1.5, abs=1e-6)
    assert find_exponent(totals, MixTarget(max_repeats=100.0)) == 0
    assert find_exponent(totals, MixTarget(max_repeats=1.0)) == pytest.approx(1)


def test_exponent_meets_the_entropy(spark):
    import math

    totals = shares(spark, [0.7, 0.2, 0.1])
    a = find_exponent(totals, MixTarget(max_repeats=None, entropy_share=0.9))
    w = [x ** a for x in (0.7, 0.2, 0.1)]
    assert -sum(x / sum(w) * math.log(x / sum(w)) for x in w) == pytest.approx(0.9 * math.log(3), abs=1e-6)


def test_budgets_are_met_within_a_document(spark, docs):
    frame = docs(rows({"big": 1500, "mid": 300, "small": 60}))
    out = mix(frame, MixTarget(max_repeats=2.5)).collect()
    tokens, weights = collections.Counter(), {}
    for r in out:
        tokens[r.source] += r.n_tokens
        weights[r.source] = r.weight
    total = sum(1 + i % 7 for i in range(1860))
    assert sum(weights.values()) == pytest.approx(1)
    for source, weight in weights.items():
        assert total * weight - 8 < tokens[source] <= total * weight + 1
    passes = collections.Counter((r.doc_id, r.epoch) for r in out)
    assert max(passes.values()) == 1


def test_every_document_goes_in_without_a_budget(spark, docs):
    frame = docs(rows({"big": 200, "small": 20}) + [(900, "", "none"), (901, None, "none")])
    out = mixed_documents(frame, MixTarget(max_repeats=2.0, budget_share=None))
    times = collections.Counter(r.doc_id for r in out.collect())
    assert set(times) == set(range(220)) | {900, 901} and max(times.values()) <= 2
    assert out.columns == frame.columns


def test_hot_repeated_rows(spark, docs):
    """Rows that are all alike go the same way, whatever the budget."""
    frame = docs([(1, "a b c", "x")] * 50 + rows({"y": 30}))
    times = collections.Counter(r.doc_id for r in mix(frame, MixTarget(max_repeats=1.2)).where("source = 'x'").collect())
    assert not times or times[1] % 50 == 0
    assert mix(frame.withColumn("source", F.lit(None).cast("string")), MixTarget()).count() == 80
