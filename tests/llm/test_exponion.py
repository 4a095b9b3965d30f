"""Clusters against plain Lloyd rounds over whole numbers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import exponion
from weftline.llm.queries import op13_clusters


def lloyd(rows, k=8, rounds=10, scale=1024, dims=64, seed=3):
    """Sorted (id, cluster, distance, cluster_inertia, inertia, digest), every distance taken each round."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    x = np.array([v for _, v in kept], dtype=object)
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(v) for _, v in first]
    for r in range(rounds + 1):
        d = np.stack([((x - np.array(m, dtype=object)) ** 2).sum(axis=1) for m in c], axis=1)
        own = [min(range(len(c)), key=lambda j: (row[j], j)) for row in d]
        if r < rounds:
            for j in set(own):
                mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
                c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    dist = [int(row[o]) for row, o in zip(d, own, strict=True)]
    per = {j: sum(t for t, o in zip(dist, own, strict=True) if o == j) for j in set(own)}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(repr((i, o, t, per[o], sum(dist), sha[o])) for (i, _), o, t in zip(kept, own, dist, strict=True))


def check(spark, rows, dims, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = exponion.cluster(df, dims=dims, **how)
    assert sorted(repr(tuple(r)) for r in got.collect()) == lloyd(rows, dims=dims, **how)


def test_ties_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    grid = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.integers(-2, 3, (200, 2)))]  # a grid: ties everywhere
    odd = [(None, [1.0, 1.0]), (None, [0.0, 2.0]), (7, None), (8, []), (9, [1.0]), (10, [1.0, None]), (11, [float("nan"), 0.0]), (12, [0.0, float("inf")]), (13, [1.0, 2.0, 3.0])]
    check(spark, grid + odd + [grid[4]] * 150, 2, k=7, rounds=6, scale=3)
    check(spark, [(i, [1.0, 1.0]) for i in range(30)], 2, k=5, rounds=3)
    check(spark, grid[:3], 2, k=5, rounds=2)
    check(spark, grid[:40], 2, k=1, rounds=2)


def test_many_centroids_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(exponion, "BLOCK", 37)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(30, 5)) * 4
    rows = [(int(i), (centre[i % 30] + rng.normal(size=5)).tolist()) for i in range(900)]
    check(spark, rows, 5, k=40, rounds=5, scale=100)


def test_large_components(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, v) for i, v in enumerate((rng.integers(-(1 << 27), 1 << 27, (120, 3)) / 1024).tolist())], 3, k=6, rounds=4)
    far = spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.distance for r in exponion.cluster(far, k=1, rounds=0, dims=2).collect()}
    assert sorted(got.values()) == [0, 2 << 54]


def test_few_distances_are_taken():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (64, 8))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-200, 200, (4000, 8))
    own, upper, lower, looked = exponion.Balls(centres).first(x)
    assert looked == 64 * 4000
    now = centres + rng.integers(-20, 20, centres.shape)
    got = exponion.Balls(now, centres).again(x, own, upper, lower)
    assert (got[0] == exponion.squared(x, now).argmin(axis=1)).all()
    assert got[3] < 2 * 4000


def test_empty_and_refused(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, cluster string")
    assert exponion.cluster(none).count() == 0
    with pytest.raises(ValueError, match="centroids"):
        exponion.cluster(none, k=0)


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(repr(tuple(r)) for r in op13_clusters(spark, sf).collect()) == lloyd(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("exponion")]


def test_rounds_do_not_shuffle_vectors(spark):
    rows = spark.range(500).select(F.col("id"), F.array(*[F.rand(i).alias("x") * 100 for i in range(4)]).cast("array<long>").alias("v"))
    tables = exponion._Tables(spark)
    data = tables.write(exponion.blocks(rows, 4).repartition(tables.buckets, "block"), "vectors")
    centroids = np.arange(12).reshape(3, 4)
    state = tables.write(exponion.assigned(data.select("block", "flat"), centroids, None), "state0")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = data.select("block", "flat").join(state.select("block", "cluster"), "block")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    tables.drop("vectors")
    tables.drop("state0")
