"""Document quality by a sparse rule ensemble.

Statistics of whole texts are built-in expressions. Small trees are boosted over the statistics of a
bounded sample of labelled rows; every path from a root to a node is a rule, a conjunction of
comparisons. A logistic model with a lasso penalty weighs the rules, most to nothing, and what is left is
compiled into one Spark column expression, so scoring never leaves the JVM.

Defined results: null text has the statistics of an empty one and gets a score; rows without a label
teach nothing; with no labelled row, or labels of one kind only, every score is their mean (one half for
none); repeated rows are scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rowferry.llm.common import fold, words_of


@dataclass(frozen=True)
class RuleSettings:
    """At most about ``sample_rows`` labelled rows, chosen by a hash of the id, are fitted on the driver."""

    sample_rows: int = 20_000
    trees: int = 30
    depth: int = 3
    bins: int = 32
    shrinkage: float = 0.2
    min_leaf: int = 20
    penalty: float = 2e-4
    steps: int = 400


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of ``text`` by name; ``words`` and ``lines`` of it are made in a step before."""
    chars = F.greatest(F.length("text"), F.lit(1))
    n = F.greatest(F.size("words"), F.lit(1))
    kept = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    joined = F.length(F.array_join("words", ""))
    n_lines = F.greatest(F.size("lines"), F.lit(1))
    return {
        "n_words": F.size("words").cast("double"),
        "n_chars": F.length("text").cast("double"),
        "word_length": joined / n,
        "distinct_words": F.size(F.array_distinct("words")) / n,
        "upper_share": kept(r"\P{Lu}+") / chars,
        "digit_share": kept(r"[^0-9]+") / chars,
        "symbol_share": kept(r"[^#*$%&|<>!?{}\[\]=_~^\\/@+]+") / chars,
        "stop_share": kept(r"[^.,;:]+") / chars,
        "bar_share": kept(r"[^|]+") / chars,
        "n_lines": F.size("lines").cast("double"),
        "line_length": F.length("text") / n_lines,
        "repeated_lines": 1 - F.size(F.array_distinct("lines")) / n_lines,
    }


def measured(docs: DataFrame, doc_id="doc_id", text="text") -> tuple[DataFrame, list[str]]:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"), F.split("text", "\n").alias("lines"))
    found = statistics(F.col("text"))
    return rows.select("doc_id", *[c.cast("double").alias(name) for name, c in found.items()]), list(found)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above?, threshold) of each comparison


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for feature, above, threshold in rule:
        out &= (x[:, feature] > threshold) == above
    return out


def _grow(x, codes, cuts, residual, weight, rows, rule, depth, settings, rules, step):
    """One tree, depth first: adds the path to each node to ``rules`` and each leaf's step to ``step``."""
    best = None
    if depth:
        g, h = residual[rows], weight[rows]
        total_g, total_h = g.sum(), h.sum()
        for feature in range(x.shape[1]):
            size = len(cuts[feature]) + 1
            own = codes[rows, feature]
            left_g, left_h = np.cumsum(np.bincount(own, g, size)), np.cumsum(np.bincount(own, h, size))
            left_n = np.cumsum(np.bincount(own, minlength=size))
            ok = (left_n >= settings.min_leaf) & (len(rows) - left_n >= settings.min_leaf)
            gain = np.where(ok, left_g**2 / (left_h + 1) + (total_g - left_g)**2 / (total_h - left_h + 1), -np.inf)[:-1]
            if len(gain) and gain.max() > (best[0] if best else total_g**2 / (total_h + 1) + 1e-9):
                best = (gain.max(), feature, int(gain.argmax()))
    if best is None:
        step[rows] = residual[rows].sum() / (weight[rows].sum() + 1)
        return
    _, feature, cut = best
    below = codes[rows, feature] <= cut
    for above, part in ((False, rows[below]), (True, rows[~below])):
        path = (*rule, (feature, above, float(cuts[feature][cut])))
        rules[path] = None
        _grow(x, codes, cuts, residual, weight, part, path, depth - 1, settings, rules, step)


def tree_rules(x: np.ndarray, y: np.ndarray, settings: RuleSettings) -> list[Rule]:
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, settings.bins + 1)[1:-1])) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(x, codes, cuts, y - p, p * (1 - p), np.arange(len(y)), (), settings.depth, settings, rules, step)
        margin += settings.shrinkage * step
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient steps."""
    n, (bias, w) = len(y), (float(np.log(y.mean() / (1 - y.mean()))), np.zeros(z.shape[1]))
    # a bound of the curvature by power iteration
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) or 1
    rate = 1 / (0.25 * (np.linalg.norm(z @ v) ** 2 / n + 1) + 1e-9)
    ahead_b, ahead_w, t = bias, w, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(ahead_b + z @ ahead_w))) - y
        new_b = ahead_b - rate * error.mean()
        moved = ahead_w - rate * (z.T @ error) / n
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead_b, ahead_w = new_b + (before - 1) / t * (new_b - bias), new_w + (before - 1) / t * (new_w - w)
        bias, w = new_b, new_w
    return bias, w


@dataclass(frozen=True)
class RuleModel:
    names: list[str]
    bias: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score of a row of statistics, as one expression."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for feature, above, threshold in rule:
                value = F.col(self.names[feature])
                holds = holds & (value > threshold if above else value <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], settings: RuleSettings = RuleSettings()) -> RuleModel:
    if not len(y) or y.min() == y.max():
        mean = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
        return RuleModel(names, float(np.log(mean / (1 - mean))), [])
    rules = tree_rules(x, y, settings)
    if not rules:
        return RuleModel(names, float(np.log(y.mean() / (1 - y.mean()))), [])
    z = np.stack([_holds(rule, x) for rule in rules], axis=1).astype(np.float64)
    bias, weights = lasso_logistic(z, y, settings.penalty, settings.steps)
    return RuleModel(names, float(bias), [(r, float(w)) for r, w in zip(rules, weights) if w])


def learn_quality(docs: DataFrame, labels: DataFrame, settings: RuleSettings = RuleSettings(), doc_id="doc_id",
                  text="text", label="quality") -> RuleModel:
    """Fitted on labelled rows outside the held-out fold; the driver gets the sample's statistics only."""
    known = labels.where(F.col(label).isNotNull() & (fold(doc_id) != 0)).select(
        F.col(doc_id).alias("labelled"), F.col(label).cast("double").alias("label"))
    size, scale = known.count(), 1 << 30
    chosen = known if size <= settings.sample_rows else known.where(
        F.pmod(F.xxhash64("labelled"), F.lit(scale)) < settings.sample_rows * scale // size)
    # the sample is bounded by its setting, so it may be broadcast
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("label", "text")
    found, names = measured(rows, doc_id="label")
    pairs = found.select(*names, "doc_id").collect()
    data = np.array([tuple(r) for r in pairs], dtype=np.float64).reshape(-1, len(names) + 1)
    return fit_rules(data[:, :-1], data[:, -1], names, settings)


def score_quality(docs: DataFrame, model: RuleModel, doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, score."""
    found, _ = measured(docs, doc_id, text)
    return found.select("doc_id", model.column().alias("score"))
