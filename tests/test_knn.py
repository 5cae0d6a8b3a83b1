"""k-NN novelty against numpy brute force, with chunking forced."""

import numpy as np
from pyspark.sql import functions as F

from tickframe.operators import knn
from tickframe.sources.tables import table

from conftest import SF_SMALL


def test_knn_novelty_chunked_equals_brute_force(spark):
    e = table(spark, SF_SMALL, "embeddings")
    refs = {"backlog": e.filter(F.col("label") < 5), "population": e.filter(F.col("label") >= 5)}
    got = {r["vec_id"]: r["novelty"] for r in knn.knn_novelty(e, refs, "vec_id", "embedding", k=4,
                                                                block=40).collect()}
    pdf = e.toPandas()
    X = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    lab = pdf["label"].to_numpy()
    for i, vid in enumerate(pdf["vec_id"]):
        score = 0.0
        for mask in (lab < 5, lab >= 5):
            dist = np.sqrt(((X[mask] - X[i]) ** 2).sum(axis=1))
            score += np.sort(dist)[:4].mean()
        assert abs(got[vid] - score) < 1e-9


def test_near_equal_and_distant_vectors(spark):
    """A far offset must not drown the differences; more blocks than one merge takes."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 16)) + 1e8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {r["id"]: r["novelty"] for r in knn.knn_novelty(df, {"all": df}, "id", "v", k=4, block=2).collect()}
    for i in range(len(x)):
        assert abs(got[i] - np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[:4].mean()) < 1e-7


def test_block_pairs_fall_and_answers_stay(spark, monkeypatch):
    """Clustered vectors in small blocks: most block pairs are left out, nothing changes; copies count each."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 6)) * 50
    ref = [[float(v) for v in centres[rng.integers(12)] + rng.normal(size=6)] for _ in range(600)]
    ref += [ref[0]] * 30
    qs = [(k, [float(v) for v in centres[k % 12] + rng.normal(size=6)]) for k in range(200)]
    kept = []
    pairs = knn.block_pairs

    def counted(q, r, k):
        out = pairs(q, r, k)
        kept.append((out.count(), q.count() * r.count()))
        return out
    monkeypatch.setattr(knn, "block_pairs", counted)
    df = spark.createDataFrame(qs, "id int, v array<double>").repartition(3)
    refs = spark.createDataFrame([(v,) for v in ref], "v array<double>").repartition(4)
    got = {r.id: r.novelty for r in knn.knn_novelty(df, {"a": refs}, "id", "v", k=5, block=20).collect()}
    x = np.array(ref)
    for k, v in qs:
        want = np.sort(np.sqrt(((x - np.array(v)) ** 2).sum(1)))[:5].mean()
        assert abs(got[k] - want) < 1e-9
    assert kept[0][0] < 0.5 * kept[0][1]


def _brute(q, ref, many, k):
    return [np.sort(np.repeat(np.sqrt(((ref - x) ** 2).sum(1)), many))[:k] for x in q]


def test_least_by_products_equals_differences(monkeypatch):
    """Far from the origin, copies, ties, non-finite and huge values, fewer vectors than k."""
    rng = np.random.default_rng(3)
    n = rng.normal
    cases = [(n(size=(70, 16)), n(size=(3000, 16))), (n(size=(70, 16)) + 1e8, n(size=(3000, 16)) + 1e8), (n(size=(20, 16)) + 1e6, n(size=(900, 16))),
             (np.zeros((20, 8)), np.zeros((200, 8))), (rng.integers(0, 3, (90, 6)) * 1.0, rng.integers(0, 3, (400, 6)) * 1.0),
             (n(size=(9, 8)) * 1e200, n(size=(300, 8)) * 1e200), (n(size=(9, 8)), n(size=(3, 8))), (n(size=(9, 8)), n(size=(1, 8)))]
    monkeypatch.setattr(knn, "SLICE", 20_000)
    for q, ref in cases:
        many = rng.integers(1, 3, len(ref))
        for k in (1, 4, 7):
            got = knn._least(q, ref, many, k)
            assert len(got) == len(q)
            with np.errstate(over="ignore"):
                assert all(np.allclose(a, b, rtol=1e-12, atol=0) for a, b in zip(got, _brute(q, ref, many, k)))
    q, ref = np.vstack([n(size=(5, 4)), [[np.nan] * 4]]), np.vstack([n(size=(200, 4)), [[np.inf] * 4]])
    got = knn._least(q, ref, np.ones(201, int), 4)
    assert np.isnan(got[5]).all() and all(np.allclose(a, b) for a, b in zip(got[:5], _brute(q[:5], ref, np.ones(201, int), 4)))


def test_few_distances_are_computed_one_by_one(monkeypatch):
    """One matrix product instead of a pass per query."""
    rng = np.random.default_rng(4)

    def never(*_):
        raise AssertionError("a pass per query")
    monkeypatch.setattr(knn, "_direct", never)
    q, ref = rng.normal(size=(300, 32)), rng.normal(size=(2000, 32))
    got = knn._least(q, ref, np.ones(2000, int), 4)
    assert all(np.allclose(a, b, rtol=1e-12, atol=0) for a, b in zip(got, _brute(q, ref, np.ones(2000, int), 4)))


def test_blocks_grow_with_the_reference_vectors(spark, monkeypatch):
    """Rows are sent once per block they meet: the blocks met are bounded until a block holds ``MOST``."""
    monkeypatch.setattr(knn, "BLOCK", 4)
    monkeypatch.setattr(knn, "BLOCKS", 5)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    met, pairs = [], knn.block_pairs

    def counted(q, r, k):
        met.append(r.count())
        return pairs(q, r, k)
    monkeypatch.setattr(knn, "block_pairs", counted)
    got = {r.id: r.novelty for r in knn.knn_novelty(df, {"a": df}, "id", "v", k=3).collect()}
    assert met[0] <= 15
    for i in range(len(x)):
        assert abs(got[i] - np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[:3].mean()) < 1e-9
