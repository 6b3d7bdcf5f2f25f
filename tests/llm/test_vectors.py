"""Forest and segment search against brute force: recall, exact scores, ties, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickwork.llm import forest, segments

SCHEMA = "vec_id long, embedding array<float>"


def clustered(n, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    return (centers[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, dim))).astype(np.float32)


def odd_rows(dim):
    nan, inf = float("nan"), float("inf")
    return [(9001, None), (9002, [0.0] * dim), (9003, [None] + [1.0] * (dim - 1)), (9004, [nan] * dim), (9005, [inf] + [0.0] * (dim - 1)), (9006, []), (None, [1.0] * dim)]


def exact(vectors, ids, query, k, scale=None):
    v = vectors.astype(np.float64) if scale is None else np.floor(scale * vectors.astype(np.float64))
    score = (v * v[ids.index(query)]).sum(axis=1)
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-score[i], ids[i]))[:k]
    return [(ids[i], score[i]) for i in order]


def test_forest_recall_and_scores(spark):
    vectors = clustered(3000) * np.random.default_rng(1).uniform(0.1, 8, (3000, 1)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + odd_rows(24)
    found = forest.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0, k=10, share=0.25, least=150).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by_query) == set(range(0, 3000, 50))
    hits = 0
    for q, got in by_query.items():
        want = exact(vectors, list(range(3000)), q, 10)
        assert len(got) == 10
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        for i, score in got:
            assert score == pytest.approx(float(vectors[q].astype(np.float64) @ vectors[i].astype(np.float64)), abs=1e-12)
        hits += len({i for i, _ in got} & {i for i, _ in want})
    assert hits >= 0.9 * 10 * len(by_query)


def test_forest_buckets_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(forest, "BUCKET", 64)
    vectors = clustered(1500, seed=2)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = forest.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0, k=5, share=0.2, least=50).collect()
    hits = 0
    for q in range(0, 1500, 100):
        got = {r.vec_id for r in found if r.query_id == q}
        assert len(got) == 5
        hits += len(got & {i for i, _ in exact(vectors, list(range(1500)), q, 5)})
    assert hits >= 0.8 * 5 * 15


def test_forest_ascends_through_buckets_beside(spark, monkeypatch):
    """A query that needs more rows than its own buckets hold meets those that share its bits, not all rows."""
    monkeypatch.setattr(forest, "BUCKET", 16)
    monkeypatch.setattr(forest, "ASKED", 8)
    met = []
    inner = forest.meet
    monkeypatch.setattr(forest, "meet", lambda held, asks, sizes: met.append((held, asks, inner(held, asks, sizes))) or met[-1][2])
    vectors = np.random.default_rng(5).normal(size=(3000, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = 1200
    found = forest.nearest(frame, F.col("id") % 60 == 0, k=5, trees=12, share=wanted / 3000, least=0).collect()
    held, asks, dealt = met[1]
    sizes = held.groupBy("tree", "bucket").count()
    per_query = asks.filter("level > 0").join(sizes, ["tree", "bucket"]).groupBy("id", "level").sum("count").collect()
    assert len(per_query) >= 40
    assert {r.level for r in per_query} & set(range(1, 7))
    assert all(wanted <= r[2] < 3000 for r in per_query)
    assert dealt.filter("asks").groupBy(*forest.KEY).count().agg(F.max("count")).first()[0] <= 3 * forest.ASKED
    hits = 0
    for q in range(0, 3000, 60):
        got = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        assert len(got) == 5
        hits += len({i for i, _ in got} & {i for i, _ in exact(vectors, list(range(3000)), q, 5)})
    assert hits >= 0.8 * 5 * 50


def test_forest_scores_in_bounded_slices():
    """Many queries of one span: no matrix of all their products."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(9000, 4))
    frame = pd.DataFrame({"tree": 0, "bucket": 0, "chunk": 0, "block": 0, "hash": 5, "id": range(9000), "vector": [v.tobytes() for v in vectors], "level": 1, "asks": [i < 4000 for i in range(9000)]})
    tracemalloc.start()
    (found,) = forest._score(iter([frame]), 63, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # 4000 by 5000 doubles are 160e6
    best = np.argsort(-(vectors[:4000] @ vectors[4000:].T), axis=1)[:, :3] + 4000
    assert (found["id"].to_numpy().reshape(4000, 3) == best).all()


def test_forest_ties_of_different_vectors(spark):
    """Binary vectors: hundreds of different ones at the same score, of which the smallest ids count."""
    rng = np.random.default_rng(8)
    vectors = np.unique(np.concatenate([np.ones((600, 1)), rng.integers(0, 2, (600, 16))], axis=1), axis=0)[::-1]
    vectors = np.concatenate([np.eye(17)[:1], rng.permutation(vectors)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = forest.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0, k=6).collect()
    got = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])]
    assert got == [(i, 1.0) for i in range(1, 7)]


def test_forest_copies_ties_and_few_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 120, 2)] + [(1, [0.5, 0.5]), (3, [0.0, 2.0])]
    found = forest.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, k=4).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 20, 100)}
    assert got == {0: [2, 4, 6, 8], 20: [0, 2, 4, 6], 100: [0, 2, 4, 6]}
    few = forest.nearest(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (5, [-1.0])], SCHEMA), F.col("id") == 0).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 1, 2.0), (2, 5, -1.0)]
    assert forest.nearest(spark.createDataFrame([], SCHEMA), F.col("id") == 0).count() == 0
    assert forest.nearest(spark.createDataFrame(odd_rows(3), SCHEMA), F.col("id") > 0).count() == 0


def test_segments_are_exact(spark, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK", 200)
    vectors = np.concatenate([clustered(900, 20, 3), np.repeat(clustered(1, 20, 4), 30, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [r for r in odd_rows(20) if r[0] not in (9002, 9006)]
    found = segments.top_products(spark.createDataFrame(rows, SCHEMA), F.col("id") % 31 == 0, k=7).collect()
    for q in range(0, 930, 31):
        got = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        assert got == [(i, int(s)) for i, s in exact(vectors, list(range(930)), q, 7, 1024)]


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = segments.Levels(rng.normal(size=(40, 13))), segments.Levels(rng.normal(size=(50, 13)))
    product = a.vectors @ b.vectors.T
    last = np.full(product.shape, np.inf)
    for x, y in zip(a.stats, b.stats, strict=True):
        bound = x @ y.T
        assert (bound >= product - 1e-9).all()
        assert (bound <= last + 1e-9).all()
        last = bound


def test_segments_ragged_zero_and_large(spark):
    rows = [(0, [3.0, 1.0]), (1, [0.5]), (2, []), (3, [1e9, 1e9]), (4, None), (5, [0.0, 0.0])]
    found = segments.top_products(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0, k=3).collect()
    got = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])]
    big = int(1024 * float(np.float32(1e9)))
    assert got == [(3, 3072 * big + 1024 * big), (1, 3072 * 512), (2, 0)]
    assert segments.products(np.array([[1e17]]), np.array([[1e17]])).tolist() == [[segments.LONG]]
    assert segments.top_products(spark.createDataFrame([], SCHEMA), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("norms", ["unit", "uniform", "lognormal"])
def test_forest_recall_with_mixed_norms(spark, norms):
    """At the production share, on random directions: the few long vectors hold most answers."""
    rng = np.random.default_rng(11)
    n = 5_000
    v = rng.normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v *= {"unit": np.ones(n), "uniform": rng.uniform(0.5, 2, n), "lognormal": rng.lognormal(0, 0.7, n)}[norms][:, None]
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = forest.nearest(frame, F.col("id") % 50 == 0, k=20).collect()
    hits = 0
    for q in range(0, n, 50):
        score = v @ v[q]
        score[q] = -np.inf
        best = set(np.argsort(-score)[:20].tolist())
        hits += len(best & {r.vec_id for r in got if r.query_id == q})
    assert hits / (20 * n / 50) >= 0.9
