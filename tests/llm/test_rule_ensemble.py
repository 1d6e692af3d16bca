import random
import zlib

import numpy as np

from rowferry.llm.rule_ensemble import RuleModel, RuleSettings, _holds, fit_rules, learn_quality, score_quality


def test_compiled_rules_score_as_the_model(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3)).round(2)
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = fit_rules(x, y, ["a", "b", "c"], RuleSettings(trees=10))
    margin = model.bias + sum(w * _holds(r, x) for r, w in model.rules)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    found = [r[0] for r in frame.select(model.column()).collect()]
    assert np.allclose(found, 1 / (1 + np.exp(-margin)))
    assert ((margin > 0) == (y > 0)).mean() > 0.97
    assert len(model.rules) < 60 and all(len(r) <= 3 for r, _ in model.rules)


def test_labels_of_one_kind():
    x = np.zeros((5, 1))
    assert fit_rules(x, np.ones(5), ["a"]).rules == []
    assert fit_rules(x[:0], np.ones(0), ["a"]) == RuleModel(["a"], 0.0, [])


def test_held_out_accuracy(spark, docs):
    rng, rows, labels = random.Random(1), [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 60))]
        bad = i % 4 == 0
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."))
        labels.append((i, int(not bad)))
    frame = docs(rows)
    model = learn_quality(frame, spark.createDataFrame(labels, "doc_id long, quality int"), RuleSettings(trees=5, min_leaf=5))
    scores = {r.doc_id: r.score for r in score_quality(frame, model).collect()}
    held = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((scores[i] >= 0.3) == bool(q) for i, q in held)
