"""Exact top-k against brute force, nearest neighbours' recall, odd vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import ann, topk

QUERY = "vec_id % 50 = 0"


def table(spark, vectors, ids=None):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 2500)] + 0.4 * rng.normal(size=(2500, 16))).astype(np.float32)
    x[700:1500] = x[0]  # a third of all rows are one vector
    return x


def brute(scores, ids, own, k=5):
    return [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]


def check_topk(spark, x, **tiling):
    got: dict = {}
    for r in topk.top_k(table(spark, x), F.expr(QUERY), **tiling).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    whole, ids = np.floor(256 * np.asarray(x, np.float64)).astype(np.int64), np.arange(len(x))
    for q in range(0, len(x), 50):
        scores = whole @ whole[q]
        assert [got[q][k] for k in sorted(got[q])] == [(i, scores[i]) for i in brute(scores, ids, q)]


def test_topk(spark, clustered):
    check_topk(spark, clustered, tile_rows=400, tile_queries=20)
    check_topk(spark, np.round(clustered[:300]), tile_rows=100)  # many ties


def test_threshold_stops_early():
    rng = np.random.default_rng(3)
    values = np.zeros((5000, 4), np.int64)
    values[:, 0] = rng.permutation(5000)
    values[:, 1:] = rng.integers(0, 3, (5000, 3))
    order = np.argsort(-values, axis=0, kind="stable").T
    query = np.array([100, -1, 0, 1])
    at, scores = topk.threshold_search(query, values.astype(float), order, np.arange(5000), 5)
    assert scores.tolist() == sorted((values @ query).tolist(), reverse=True)[:5] and len(at) == 5
    assert topk.threshold_search(np.zeros(4, np.int64), values.astype(float), order, np.arange(5000), 2)[0].tolist() == [0, 1]


def test_recall_and_scores(spark, clustered):
    got: dict = {}
    for r in ann.nearest(table(spark, clustered), F.expr(QUERY), sample_rows=600, rows_per_part=40, block_rows=300).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    ids, x, hits = np.arange(len(clustered)), clustered.astype(np.float64), 0
    for q in range(0, len(x), 50):
        scores = ann.cosines(x[q], x)
        want = brute(scores, ids, q)
        found = [got[q][k] for k in sorted(got[q])]
        hits += len({i for i, _ in found} & set(want))
        assert all(s == scores[i] for i, s in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits >= 0.9 * 5 * len(got)


def test_balanced_parts(clustered):
    x = ann._unit(np.unique(clustered.astype(np.float64), axis=0))
    sizes = np.bincount(ann.balanced_parts(x, ann.neighbour_graph(x, 8), 16))
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 5


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], None, [], [nan, 1], [None, 1], [inf, 0], [0, 0], [0.5, 0.1], [1, 0], [1, 0, 0]]
    df = table(spark, [*vectors, [2, 0]], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 50]).unionByName(table(spark, [[1, 0]], [8]))
    near = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.expr(QUERY)).orderBy("query_id", "rank").collect()]
    assert near == [(0, 1, 8), (0, 2, 8), (0, 3, 50), (0, 4, 7), (50, 1, 0), (50, 2, 8), (50, 3, 8), (50, 4, 7)]
    top = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.expr(QUERY)).orderBy("query_id", "rank").collect()]
    assert top[:5] == [(0, 1, 50, 131072), (0, 2, 8, 65536), (0, 3, 8, 65536), (0, 4, 7, 32768), (0, 5, 6, 0)]
    assert ann.nearest(df.limit(0), F.expr(QUERY)).count() == 0 and topk.top_k(df.limit(0), F.expr(QUERY)).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), F.expr(QUERY)).count() == 0


def test_lengths_have_answers_of_their_own(spark):
    """Vectors of several lengths in one table: each query is answered among those of its length."""
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=3 if i % 7 == 1 else 6).astype(np.float32).tolist() for i in range(1200)]
    df = table(spark, vectors)
    near: dict = {}
    for r in ann.nearest(df, F.expr(QUERY), rows_per_part=30).collect():
        near.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q in range(0, 1200, 50):
        own = np.array([i for i in range(1200) if len(vectors[i]) == len(vectors[q])])
        scores = ann.cosines(np.array(vectors[q]), np.array([vectors[i] for i in own]))
        assert all(len(vectors[i]) == len(vectors[q]) for i in near[q]) and len(near[q]) == 5
        hits += len(set(near[q]) & {int(own[i]) for i in brute(scores, own, q)})
    assert hits >= 0.9 * 5 * 24


@pytest.mark.parametrize(("n", "most_visits", "most_rows"), [(2000, 0.5, 0.75), (51282, 0.34, 0.55)])
def test_recall_and_visits_with_production_parameters(n, most_visits, most_rows):
    """Recall of 0.9 or more against brute force, by visits to a share of the parts that hold a share of the rows (vectors
    drawn in all directions alike, as the test tables', without structure that parts could follow)."""
    ids, x = np.arange(n), np.random.default_rng(n).normal(size=(n, 64))
    u = ann._unit(x)
    found = ann.fit_partition(u[np.random.default_rng(0).permutation(len(u))[:8192]], len(u), 2, 60, 256, 0.93)
    assert found.visits <= found.parts * most_visits and found.parts >= 16
    own = np.argsort(-ann.part_scores(found.weights, u), axis=1)[:, :2]
    hits = rows_read = 0
    queries = np.flatnonzero(ids % 50 == 0)[:200]
    for q in queries:
        visited = np.argsort(-ann.part_scores(found.weights, u[q : q + 1]))[0, : found.visits]
        scores = u @ u[q]
        scores[q] = -2
        near = np.argpartition(-scores, 5)[:5]
        met = np.isin(own, visited).any(axis=1)
        hits, rows_read = hits + met[near].sum(), rows_read + met.sum()
    print(n, "parts", found.parts, "visits", found.visits, "recall", hits / 5 / len(queries), "share of rows read", rows_read / len(queries) / len(u))
    assert hits >= 0.9 * 5 * len(queries) and rows_read <= most_rows * len(queries) * len(u)


def test_huge_components(spark):
    """Products beyond 64 bits are compared exactly and given as the nearest long."""
    vectors = [[1e17, 1.0], [1e17, 2.0], [-1e17, 0.0], [1.0, 1.0], [1e308, 1.0]]
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), F.expr(QUERY)).orderBy("rank").collect()]
    assert got == [(n + 1, i, (1 << 63) - 1) for n, i in enumerate((1, 3, 4))] + [(4, 2, -(1 << 63))]
    assert topk.whole(np.array([[1e308, 0.5]]), 256)[0].tolist() == [int(1e308) * 256, 128]


def test_tiles_below_the_floor_are_not_met(spark):
    """Rows of very different sizes: most tiles' bounds are below what the first tile gives; the answers are brute force's."""
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(3000, 4)) * np.exp(rng.normal(size=(3000, 1)) * 2)).astype(np.float32)
    check_topk(spark, x, tile_rows=100, tile_queries=20)
    rows = table(spark, x).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.lit(4).alias("dim"))
    tiled = rows.withColumn("tile", F.floor(F.log1p(F.aggregate("v", F.lit(0.0), lambda a, c: a + F.abs(c)))).cast("int"))
    known = topk.heads(tiled)
    asked = tiled.where("id % 50 = 0").drop("tile").withColumn("floor", F.lit(1e6))
    reached = topk.bounded(asked, known, 256).select("id", "reached").collect()
    whole = np.floor(256 * x.astype(np.float64))
    tile = np.floor(np.log1p(np.abs(x.astype(np.float64)).sum(axis=1))).astype(int)
    for r in reached:
        assert set(tile[whole @ whole[r.id] >= 1e6].tolist()) <= set(r.reached)
    assert sum(len(r.reached) for r in reached) < 0.7 * len(reached) * len(known[4][0])
