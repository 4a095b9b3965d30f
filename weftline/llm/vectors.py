"""Vectors in array columns: which take part, and tiles of queries and candidates that meet in one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, nonzero: bool = False) -> Column:
    """True for a vector that is not null or empty and has only finite components (and, if asked, one that is not 0)."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ok = x.isNotNull() & (F.size(x) > 0) & finite
    return F.coalesce(ok & F.exists(x, lambda c: c != 0) if nonzero else ok, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, best first, ties to smaller ids; time in proportion to the number of scores."""
    if len(scores) > k:
        at_least = -np.partition(-scores, k - 1)[k - 1]
        near = np.flatnonzero(scores >= at_least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def tiles(queries: DataFrame, candidates: DataFrame, keys: list[str], search: Callable, schema: str) -> DataFrame:
    """Run ``search(queries, candidates)`` (Arrow tables in, one out) wherever both sides have rows of the same keys."""

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return search(a, b)

    other = candidates.toDF(*candidates.columns)  # columns of its own, where both sides come from one frame
    return queries.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(run, schema)
