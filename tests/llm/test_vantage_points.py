import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm.vantage_points import TreeSettings, nearest

KIND = "vec_id long, embedding array<float>"


def plain(ids, vectors, size=20):
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[at]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != at][:size]
        out[int(ids[at])] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def made(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], KIND)


def searched(frame, **settings):
    found = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0, TreeSettings(**settings)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("unit", [True, False])
def test_factor_one_is_exact(spark, unit):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(1500, 8)) * rng.uniform(0.5, 2, size=(1500, 1))
    if unit:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32).astype(np.float64)
    vectors[700:760] = vectors[3]  # copies: ties go to the smaller id
    ids = rng.permutation(1500)
    found, want = searched(made(spark, ids, vectors), factor=1.0, shard_rows=400, leaf=32), plain(ids, vectors)
    assert found.keys() == want.keys()
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_of_the_default(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4000, 64)).astype(np.float32).astype(np.float64)
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
    ids = np.arange(4000)
    found, want = searched(made(spark, ids, vectors)), plain(ids, vectors)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_few_candidates(spark):
    found = searched(made(spark, [0, 5], np.eye(2)))
    assert found == {0: [(5, 0.0)]}
