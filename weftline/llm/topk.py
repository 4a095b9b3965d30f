"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt over tiles by the size of their vectors; of each tile the first and last value of every list is known
(its heads), which bounds any score in it. A query begins with the tile of the highest bound; its kth score there is a
floor for all others, and of these it meets only the ones whose bound reaches that floor. In a tile, whose candidates are
sorted once per dimension, the lists are read from their better ends, a round at a time; what is met first is scored in
full; the last values read bound whatever is still unseen. A query is done when that bound is below its floor or its kth
score (a tie could still go to a smaller id), or when all are seen; when over half are seen, the rest is scored without
reading on. The few best of each tile are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import cut_lineage, in_worker, with_arrays
from weftline.llm.vectors import best, matrix, tiles, usable

SCHEMA = "query_key long, query_id long, vec_id long, score long, kth double"
#: Heads of tiles are sent to all tasks: two numbers a dimension. Tiles grow where there would be more of them.
MOST_TILES, BANDS = 20_000, 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * component), exactly: doubles, or Python integers where these could not hold a product."""
    with np.errstate(over="ignore"):
        v = np.floor(x * float(scale))
    if not np.isfinite(v).all() or np.abs(v).max(initial=0) >= 2**53:
        return np.array([[floor(Fraction(float(c)) * scale) for c in row] for row in x], object).reshape(x.shape)
    return v


def threshold_search(query: np.ndarray, values: np.ndarray, order: np.ndarray, ids: np.ndarray, k: int, first_depth: int = 16, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best rows of ``values``, but for those that are sure to score below ``least``.
    ``order``: per dimension the rows by falling value."""
    n, live = len(values), np.flatnonzero(query)
    small = values.dtype != object and query.dtype != object and max(1, np.abs(values).max(initial=0)) * max(1, np.abs(query).max(initial=0)) * len(query) < 2**53
    exact = np.float64 if small else object
    v, q = values.astype(exact, copy=False), query.astype(exact)
    if not small:
        v, q = np.vectorize(int, otypes=[object])(v), np.vectorize(int, otypes=[object])(q)
    seen, at, scores = np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, exact)
    if not len(live):
        at, scores = np.arange(n), np.zeros(n, exact)
    depth, done, forward = first_depth, 0, query > 0
    while done < n and len(live):
        depth = min(depth, n)
        lists = [order[d, done:depth] if forward[d] else order[d, n - depth : n - done] for d in live]
        met = np.concatenate(lists)
        seen_now = np.zeros(n, bool)
        seen_now[met] = True
        many = 2 * np.count_nonzero(seen | seen_now) > n
        new = np.flatnonzero(~seen if many else seen_now & ~seen)
        seen[new] = True
        at, scores = np.r_[at, new], np.r_[scores, v[new] @ q]
        keep = best(scores, ids[at], k)
        at, scores = at[keep], scores[keep]
        last = np.array([order[d, depth - 1] if forward[d] else order[d, n - depth] for d in live])
        bound = (v[last, live] * q[live]).sum()
        if many or bound < least or len(at) == k and scores[-1] > bound:
            break
        done, depth = depth, depth * 2
    keep = best(scores, ids[at], k)
    return at[keep], scores[keep]


def heads(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of vectors (tiles, greatest and least component of each of them), from rows (v, dim, tile).

    Tasks reduce their batches first; ``MOST_TILES`` bounds what comes to the driver.
    """

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            dims, tile = (batch.column(x).to_numpy() for x in ("dim", "tile"))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x, t = matrix(batch.column("v").take(pa.array(at))), tile[at]
                turn = np.argsort(t, kind="stable")
                first = np.flatnonzero(np.r_[True, t[turn][1:] != t[turn][:-1]])
                for key, high, low in zip(t[turn][first].tolist(), np.maximum.reduceat(x[turn], first), np.minimum.reduceat(x[turn], first), strict=True):
                    known = held.setdefault((dim, key), [high, low])
                    held[dim, key] = [np.maximum(known[0], high), np.minimum(known[1], low)]
        names = list(held)
        kinds = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([n[0] for n in names], pa.int32()), pa.array([n[1] for n in names], pa.int32()), *[pa.array([held[n][i] for n in names], kinds) for i in (0, 1)]], names=["dim", "tile", "high", "low"])

    def joined(table: pa.Table) -> pa.Table:
        high, low = matrix(table.column("high")).max(axis=0), matrix(table.column("low")).min(axis=0)
        kinds = pa.list_(pa.float64())
        return pa.table({"dim": table.column("dim")[:1], "tile": table.column("tile")[:1], "high": pa.array([high], kinds), "low": pa.array([low], kinds)})

    schema = "dim int, tile int, high array<double>, low array<double>"
    parts = rows.select("v", "dim", "tile").mapInArrow(in_worker("topk", reduced), schema)
    got = parts.groupBy("dim", "tile").applyInArrow(joined, schema).toArrow()
    out, dims = {}, got["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        some = got.filter(pa.array(dims == dim))
        out[dim] = (some["tile"].to_numpy(), matrix(some["high"]), matrix(some["low"]))
    return out


def bounded(queries: DataFrame, known: dict, scale: int) -> DataFrame:
    """Queries (.., v, dim, floor) with ``reached``: tiles whose bound reaches the floor, the highest bound first."""
    shared = queries.sparkSession.sparkContext.broadcast(known)  # MOST_TILES * 2 numbers a dimension at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, found = batch.column("dim").to_pylist(), []
            for v, dim, least in zip(batch.column("v").to_pylist(), dims, batch.column("floor").to_pylist(), strict=True):
                tile, high, low = shared.value[dim]
                q = np.array(v) * scale
                with np.errstate(over="ignore", invalid="ignore"):
                    parts = np.maximum((np.floor(q) * scale) * high, (np.floor(q) * scale) * low) + np.abs(q) + 1  # floors lower a component by less than 1
                    bound, error = parts.sum(axis=1), 1e-9 * np.abs(parts).sum(axis=1)
                    bound = np.where(np.isfinite(bound), bound + error, np.inf)
                order = np.argsort(-bound, kind="stable")
                found.append(tile[order[bound[order] >= least]].astype(np.int32))
            yield with_arrays(batch, reached=pa.array(found, pa.list_(pa.int32())))

    return queries.mapInArrow(in_worker("topk", run), T.StructType([*queries.schema.fields, T.StructField("reached", T.ArrayType(T.IntegerType()))]))


def met(queries: DataFrame, rows: DataFrame, k: int, scale: int, tile_queries: int) -> DataFrame:
    """The k best of each query (key, id, v, dim, floor, tile) in each of its tiles, and its kth score there."""
    layers = queries.groupBy("dim", "tile").agg(F.ceil(F.count("*") / F.lit(tile_queries)).cast("int").alias("layers"))
    asked = queries.join(layers, ["dim", "tile"]).withColumn("layer", F.pmod("key", "layers").cast("int"))
    candidates = rows.join(layers, ["dim", "tile"]).withColumn("layer", F.explode(F.sequence(F.lit(0), F.col("layers") - 1)))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            ids, times, values = b.column("id").to_numpy(), b.column("n").to_numpy(), whole(matrix(b.column("v")), scale)
            order = np.argsort(-values, axis=0, kind="stable").T.copy()
            for key, own, least, query in zip(*[a.column(x).to_pylist() for x in ("key", "id", "floor")], whole(matrix(a.column("v")), scale), strict=True):
                at, scores = threshold_search(query, values, order, ids, k + int((ids == own).sum()), least=least)
                found = [(int(ids[i]), int(s)) for i, s in zip(at.tolist(), scores.tolist(), strict=True) if ids[i] != own for _ in range(min(k, int(times[i])))][:k]
                kth = float(found[-1][1]) if len(found) == k else -np.inf
                out += [(key, own, i, min(max(s, LEAST), MOST), kth) for i, s in found]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_key", "query_id", "vec_id", "score", "kth"), columns, kinds, strict=True)})

    sent = ["key", "id", "v", "dim", "tile", "layer"]
    return tiles(asked.select(*sent, "floor"), candidates.select(*sent[1:], "n"), ["dim", "tile", "layer"], search, SCHEMA)


def top_k(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256, tile_rows: int = 16384, tile_queries: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of floor(scale * component).

    ``is_query`` is a condition on rows; candidates are all rows of other ids with vectors of the query's length. Vectors
    that are null, empty or have a null or non-finite component take no part. Fewer candidates give fewer ranks, ties go
    to smaller ids, repeated rows are candidates each. Scores are compared exactly at any size, within a tile; a score
    beyond 64 bits is given as the nearest long, and such scores tie. Tables may be empty; other columns are not read.
    """
    rows = df.where(usable(F.col(vector)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    # Repeated rows are one row with a number; tiles are bands of the vectors' sizes, cut by hash.
    rows = rows.groupBy("id", "v").agg(F.count("*").alias("n"), F.max("is_query").alias("is_query"))
    size = F.aggregate("v", F.lit(0.0), lambda a, c: a + F.abs(c))
    rows = cut_lineage(rows.withColumns({"key": F.xxhash64("id", "v"), "dim": F.size("v"), "size": size}))
    total = rows.count()
    if not total:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    wide = min(MOST_TILES, -(-total // tile_rows))
    bands = min(BANDS, wide)
    edges = rows.agg(F.percentile_approx("size", [i / bands for i in range(1, bands)] or [0.5])).first()[0] if bands > 1 else []
    band = sum((F.when(F.col("size") > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    per = -(-wide // bands)
    rows = cut_lineage(rows.withColumn("tile", (band * F.lit(per) + F.pmod("key", F.lit(per))).cast("int")).drop("size"))
    known = heads(rows)
    queries = rows.where("is_query").select("key", "id", "v", "dim")
    begun = bounded(queries.withColumn("floor", F.lit(float("-inf"))), known, scale).withColumn("tile", F.element_at("reached", 1)).drop("reached")
    first = cut_lineage(met(begun, rows, k, scale, tile_queries))
    floors = first.groupBy(F.col("query_key").alias("key"), F.col("query_id").alias("id")).agg(F.max("kth").alias("floor"))
    again = begun.drop("floor").withColumnRenamed("tile", "begun").join(floors, ["key", "id"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    others = bounded(again, known, scale).select("key", "id", "v", "dim", "floor", "begun", F.explode("reached").alias("tile")).where("tile <> begun").drop("begun")
    both = first.unionByName(met(others, rows, k, scale, tile_queries))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
