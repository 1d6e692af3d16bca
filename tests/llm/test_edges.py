"""Every operator on null, empty and long texts, repeated rows, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowferry.llm import language_id, mixing, packing, page_difference, quality_rules, rule_ensemble
from rowferry.llm import secret_scan, simhash, suffix_levels, vantage_points

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here"
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, PROSE), (5, PROSE), (6, PROSE, None), (None, PROSE),
    (None, None, None), (7, PROSE + ".", "other", "en"), (8, "x" * 5000), (9, "é中\U0001f600 password=abcdefgh12"),
]
CLASHES = ["fp", "_fp", "host", "h", "k", "n", "words", "lines", "label", "labelled", "verdict", "plan", "row", "pass", "key",
           "tokens", "base", "spans", "shard", "order", "least", "DOC_NO"]


def clashing(df):
    return df.withColumns({c: F.lit(c) for c in CLASHES})


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


OPERATORS = {
    "quality": lambda spark, d: quality_rules.quality_rules(d),
    "repeats": lambda spark, d: suffix_levels.remove_repeats(d),
    "secrets": lambda spark, d: secret_scan.secret_scan(d),
    "simhash": lambda spark, d: simhash.simhash_groups(d),
    "language": lambda spark, d: language_id.predict_languages(
        d, language_id.learn_profiles(d, language_id.ProfileSettings())),
    "rules": lambda spark, d: rule_ensemble.score_quality(
        d, rule_ensemble.learn_quality(d, labels(spark, [(4, 1), (5, 0), (None, 1), (6, None)]))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, docs, name):
    plain = OPERATORS[name](spark, docs(ROWS)).collect()
    assert len(plain) == len(ROWS)
    extra = OPERATORS[name](spark, clashing(docs(ROWS))).collect()
    assert sorted(map(str, plain)) == sorted(map(str, extra))
    assert OPERATORS[name](spark, docs([])).count() == 0


def test_mixing_and_packing(spark, docs):
    for frame in (docs(ROWS), clashing(docs(ROWS))):
        mixed = mixing.mix(frame, mixing.MixTarget(budget_share=None))
        assert {r.doc_id for r in mixed.collect()} >= {4, 5, 6, 7, 8, 9}
        pieces = packing.pack(frame).collect()
        assert sum(p.doc_tokens for p in pieces if p.start == 0) == sum(p.length for p in pieces)
        assert sum(p.start == 0 for p in pieces) == len(ROWS)
    assert mixing.mix(docs([])).count() == 0 == packing.pack(docs([])).count()


def test_pipeline_stages_keep_the_columns(spark, docs):
    for frame in (docs(ROWS), clashing(docs(ROWS)), docs([])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, "")
            assert out.columns == frame.columns
            assert [t for _, t in out.dtypes] == [t for _, t in frame.dtypes]
            out.collect()


def test_pages(spark):
    kind = "page_id long, url string, html string"
    rows = [(1, None, None), (2, "http://h/a", ""), (None, "http://h/a", "<p>a"), (3, "not a url", "<p>b</p>"),
            (3, "not a url", "<p>b</p>"), (4, "http://h/b", "<p>" + "long text " * 50_000), (5, "http://h/c", "<" * 2000 + "<p")]
    found = page_difference.main_text(spark.createDataFrame(rows, kind).withColumns({c: F.lit(1) for c in ("at", "lines", "host")}))
    assert found.count() == len(rows)
    assert page_difference.main_text(spark.createDataFrame([], kind)).count() == 0


def test_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [-1.0, 0.0]), (8, [1.0, 0.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, kind).withColumns({c: F.lit(1) for c in ("v", "id", "shard", "kind", "bound")})
    found = vantage_points.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 8, 1.0), (0, 2, 1, 0.5), (0, 3, 7, -1.0)]
    assert vantage_points.nearest(spark.createDataFrame([], kind), F.col("vec_id") % 20 == 0).count() == 0
