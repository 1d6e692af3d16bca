"""The registered queries: shapes on the smallest tables, and SQL where there is some."""

import pytest

from oracle import compare, duck
from rowferry.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    _, difference = compare(spark, duck(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER)
    assert difference is None


def test_pipeline(spark):
    import corpus_pipeline

    pieces = corpus_pipeline.run(spark, FOLDER)
    documents = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert pieces.count() > 100 and {r.doc_id for r in pieces.collect()} <= documents
