"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into balanced parts (recursive halving along the main axis,
then exchanges that lower the cut). A small classifier learns in which parts a vector's neighbours are. Every row is
indexed under its few most probable parts; a query goes to several most probable parts and is reranked exactly against all
that are there. How many parts it visits is measured on sample rows that were kept out of the fit. Vectors of each length
have parts of their own; a length with few sample rows has one. Crowded parts are cut into blocks of rows, and their
visitors into layers, so no task holds more than a block and a layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import cut_lineage, in_worker, with_arrays
from weftline.llm.vectors import matrix, tiles, usable

SCHEMA = "query_key long, query_id long, vec_id long, score double"


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row by cosine (rows have length 1), a block at a time."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part of 0..parts-1 (a power of two) for each row, of equal sizes up to one, with few edges cut."""
    label = np.zeros(len(x), np.int64)
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    a, b = np.r_[source, graph.ravel()], np.r_[graph.ravel(), source]
    while label.max(initial=0) + 1 < parts:
        side = np.zeros(len(x), np.int64)
        for p in range(label.max(initial=0) + 1):
            own = np.flatnonzero(label == p)
            centred = x[own] - x[own].mean(axis=0)
            axis = np.linalg.svd(centred.T @ centred)[0][:, 0]
            side[own[np.argsort(centred @ axis, kind="stable")[len(own) // 2 :]]] = 1
        inside = label[a] == label[b]
        ea, eb = a[inside], b[inside]
        for _ in range(rounds):
            gain = np.bincount(ea, np.where(side[ea] == side[eb], -1.0, 1.0), len(x))
            moved = 0
            for p in range(label.max(initial=0) + 1):
                own = np.flatnonzero(label == p)
                left, right = own[side[own] == 0], own[side[own] == 1]
                left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
                n = min(len(left), len(right))
                swap = int((gain[left[:n]] + gain[right[:n]] > 1).sum() * 0.5)
                side[left[:swap]], side[right[:swap]] = 1, 0
                moved += swap
            if not moved:
                break
        label = 2 * label + side
    return label


def neighbour_shares(label: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Per row the shares of its neighbours' parts; its own counts twice."""
    shares = np.zeros((len(label), parts))
    np.add.at(shares, (np.repeat(np.arange(len(label)), graph.shape[1]), label[graph].ravel()), 1.0)
    shares[np.arange(len(label)), label] += 2
    return shares / shares.sum(axis=1, keepdims=True)


def part_scores(w: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ w[0] + w[1]) @ w[2] + w[3]


def visits_for(w: tuple[np.ndarray, ...], indexed: np.ndarray, asked: np.ndarray, recall: float, copies: int, k: int = 5) -> int:
    """The least number of parts in which ``asked`` rows meet that share of their k nearest ``indexed`` rows."""
    parts = len(w[3])
    near = np.argpartition(-(asked @ indexed.T), min(k, len(indexed)) - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-part_scores(w, asked), axis=1, kind="stable"), axis=1)
    own = np.argsort(-part_scores(w, indexed), axis=1, kind="stable")[:, :copies]
    place = np.min([np.take_along_axis(rank, own[:, c][near], axis=1) for c in range(own.shape[1])], axis=0)
    met = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    return int(np.argmax(met >= recall)) + 1


def fit_router(x: np.ndarray, shares: np.ndarray, parts: int, hidden: int = 96, epochs: int = 30, seed: int = 5) -> tuple[np.ndarray, ...]:
    """One hidden layer and softmax, by Adam."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)) * 3, np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 128):
            i = order[s : s + 128]
            h = np.tanh(x[i] @ w[0] + w[1])
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z = (z - shares[i]) / len(i)
            back = (z @ w[2].T) * (1 - h * h)
            t += 1
            for j, g in enumerate((x[i].T @ back, back.sum(0), h.T @ z, z.sum(0))):
                m[j] += 0.1 * (g - m[j])
                v[j] += 0.001 * (g * g - v[j])
                w[j] -= 0.004 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return tuple(w)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, also where squares would overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Row by row in double precision, so that equal vectors have equal scores wherever they stand."""
    dot = (candidates * query).sum(axis=1)
    return dot / (np.sqrt((candidates * candidates).sum(axis=1)) * np.sqrt((query * query).sum()))


@dataclass(frozen=True)
class Partition:
    """A router's weights, its number of parts, and how many of them a query visits."""

    weights: tuple[np.ndarray, ...]
    parts: int
    visits: int


def fit_partition(x: np.ndarray, rows: int, copies: int, rows_per_part: int, most_parts: int, recall: float) -> Partition | None:
    """From unit vectors of one length, for a table of so many rows; None where that makes a single part."""
    x = np.unique(x, axis=0)
    parts = 1 << max(0, min(most_parts, len(x) // 24, rows // rows_per_part).bit_length() - 1)
    if parts <= copies:
        return None
    x = x[np.random.default_rng(7).permutation(len(x))]
    fitted, kept_out = x[len(x) // 8 :], x[: len(x) // 8]
    graph = neighbour_graph(fitted, 10)
    weights = fit_router(fitted, neighbour_shares(balanced_parts(fitted, graph, parts), graph, parts), parts)
    return Partition(weights, parts, visits_for(weights, fitted, kept_out, recall, copies))


def routed(rows: DataFrame, partitions: dict[int, Partition], copies: int) -> DataFrame:
    """Add ``own`` (a row's most probable parts) and ``visits`` (what a query's vector visits), array<int> both."""
    shared = rows.sparkSession.sparkContext.broadcast(partitions)  # for each length (dim + parts) * hidden numbers

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = pa.compute.list_value_length(batch.column("v")).to_numpy()
            for dim in np.unique(length).tolist():
                some = batch.take(pa.array(np.flatnonzero(length == dim)))
                of = shared.value.get(dim)
                order = np.zeros((some.num_rows, 1), np.int32) if of is None else np.argsort(-part_scores(of.weights, _unit(matrix(some.column("v")))), axis=1, kind="stable").astype(np.int32)
                lists = {"own": order[:, :copies], "visits": order[:, : of.visits if of else 1]}
                yield with_arrays(some, **{n: pa.array(list(x), pa.list_(pa.int32())) for n, x in lists.items()})

    kinds = T.ArrayType(T.IntegerType())
    return rows.mapInArrow(in_worker("ann", route), T.StructType([*rows.schema.fields, T.StructField("own", kinds), T.StructField("visits", kinds)]))


def nearest(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", sample_rows: int = 8192, rows_per_part: int = 60, most_parts: int = 256, copies: int = 2, recall: float = 0.93, block_rows: int = 4096, block_queries: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest found by cosine, nearest first, ties to smaller ids.

    Every usable row is indexed, in ``copies`` parts; only partitioners and routers are fitted on ``sample_rows`` rows (of
    least hash) at most. ``recall``: what the number of visited parts is chosen for, on an eighth of the sample. Candidates
    are rows of other ids with vectors of the query's length. Vectors that are null, empty, zero or have a null or non-finite
    component take no part; repeated rows are candidates each; an empty table gives no rows; other columns are not read.
    """
    rows = df.where(usable(F.col(vector), nonzero=True) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    # Repeated rows are one row with a number.
    rows = rows.groupBy("id", "v").agg(F.count("*").alias("n"), F.max("is_query").alias("is_query")).withColumns({"key": F.xxhash64("id", "v"), "dim": F.size("v")})
    rows = cut_lineage(rows)
    sample = rows.select("key", "v", "dim").orderBy("key").limit(sample_rows).toArrow()
    total, lengths = rows.count(), sample["dim"].to_numpy()
    partitions = {}
    for dim, n in zip(*np.unique(lengths, return_counts=True), strict=True):
        x = _unit(matrix(sample["v"].filter(pa.array(lengths == dim))))
        found = fit_partition(x, total * int(n) // len(lengths), copies, rows_per_part, most_parts, recall)
        if found:
            partitions[int(dim)] = found
    placed = cut_lineage(routed(rows, partitions, copies))
    indexed = placed.select("id", "v", "n", "key", "dim", "own", F.posexplode("own").alias("nth", "part"))
    asked = placed.where("is_query").select("id", "v", "key", "dim", "visits", F.explode("visits").alias("part"))
    share = lambda count, most: F.ceil(F.count("*") / F.lit(most)).cast("int").alias(count)
    cells = indexed.groupBy("dim", "part").agg(share("blocks", block_rows)).join(asked.groupBy("dim", "part").agg(share("layers", block_queries)), ["dim", "part"])
    dealt = lambda n: F.pmod(F.col("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # A row stands in several parts: a query takes it in the first of them that it visits.
    before = F.slice("own", F.lit(1), F.col("nth")).alias("before")
    candidates = indexed.join(cells, ["dim", "part"]).select("id", "v", "n", "dim", "part", before, dealt("blocks").alias("block"), every("layers").alias("layer"))
    queries = asked.join(cells, ["dim", "part"]).select("key", "id", "v", "dim", "part", "visits", dealt("layers").alias("layer"), every("blocks").alias("block"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            ids, values, times = b.column("id").to_numpy(), matrix(b.column("v")), b.column("n").to_numpy()
            before = b.column("before").combine_chunks()
            of = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(before).to_numpy())
            earlier = before.flatten().to_numpy(zero_copy_only=False)
            u = _unit(values)
            keys, owns, asked_for, visits = a.column("key").to_pylist(), a.column("id").to_pylist(), matrix(a.column("v")), a.column("visits").to_pylist()
            visited = np.zeros(1 + max(max(map(max, visits)), earlier.max(initial=0)), bool)
            for s in range(0, len(keys), 256):
                rough = _unit(asked_for[s : s + 256]) @ u.T
                for j in range(len(rough)):
                    score, own = rough[j], owns[s + j]
                    visited[visits[s + j]] = True
                    score[of[visited[earlier]]] = -np.inf
                    visited[visits[s + j]] = False
                    score[ids == own] = -np.inf
                    n = min(k, len(score))
                    near = np.flatnonzero((score >= -np.partition(-score, n - 1)[n - 1] - 1e-9) & (score > -np.inf))
                    exact = cosines(asked_for[s + j], values[near])
                    for i in np.lexsort((ids[near], -exact))[:k]:
                        out += [(keys[s + j], own, int(ids[near[i]]), float(exact[i]))] * min(k, int(times[near[i]]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_key", "query_id", "vec_id", "score"), columns, kinds, strict=True)})

    met = tiles(queries, candidates, ["dim", "part", "block", "layer"], search, SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
