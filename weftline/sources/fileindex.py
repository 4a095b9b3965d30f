"""Where rows stand in their files: split by split, without a list of splits on the driver.

A file scan hands each split's rows to one task, in their order. So a row's place in its split is counted as it streams by;
what the splits before it hold is a table of running sums, one row for each split, that only the cluster ever sees whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans.durable import keep

#: Columns that tell a split, in the order of files.
PLACE = T.StructType([T.StructField(n, T.StringType() if n == "path" else T.LongType()) for n in ("append", "part", "path", "start")])
#: Rows of a table that one task of ``running`` sums up; rows that are sent to all tasks at most.
ROWS_A_PART, SENT = 20_000, 100_000


def running(table: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """Add ``before_<column>``: the column's sum over all rows before in the given order, which must be one.

    Two levels: rows are dealt by ranges, summed within each, and the ranges' totals are all that comes to the driver (one row
    for ``ROWS_A_PART`` rows or more, and 10,000 at most).
    """
    rows = keep(table)
    parts = min(10_000, 1 + rows.count() // ROWS_A_PART)
    dealt = keep(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy("__part").agg(*[F.sum(c).alias(c) for c in sums]).orderBy("__part").collect()
    offsets = zip(*[accumulate((r[c] or 0 for r in totals), initial=0) for c in sums], strict=True)
    known = dealt.sparkSession.createDataFrame([(r["__part"], *o) for r, o in zip(totals, offsets, strict=False)], "__part int, " + ", ".join(f"`__{c}` long" for c in sums))
    earlier = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = {f"before_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) + F.col(f"__{c}") for c in sums}
    return dealt.join(F.broadcast(known), "__part").withColumns(summed).drop("__part", *[f"__{c}" for c in sums])


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(split, its rows) of a batch with a ``place`` column, in the order they come."""
    if not batch.num_rows:
        return
    place = batch.column("place")
    start, path = place.field("start").to_numpy(zero_copy_only=False), place.field("path").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((start[1:] != start[:-1]) | (path[1:] != path[:-1])) + 1
    for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, batch.num_rows].tolist(), strict=True):
        one = place[a].as_py()
        yield tuple(one.values()), batch.slice(a, b - a)


def counted_lines(read: Callable[[str], dict], kind: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over (raw, place): adds what ``read`` says of each line, how many lines of its split came before it,
    and how many of those were valid (their ``error`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        struct = to_arrow_type(kind)
        now, line, rank = None, 0, 0
        for batch in batches:
            for split, rows in runs(batch):
                if split != now:
                    now, line, rank = split, 0, 0
                parsed = [read(r) for r in rows.column("raw").to_pylist()]
                good = np.array([p["error"] is None for p in parsed])
                at = rank + np.cumsum(good) - good
                columns = [rows.column("raw"), rows.column("place"), pa.array(parsed, struct), pa.array(np.arange(line, line + len(parsed)), pa.int64()), pa.array(at, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["raw", "place", "parsed", "line", "rank"])
                line, rank = line + len(parsed), rank + int(good.sum())

    return run


def split_index(rows: DataFrame, valid: Column) -> DataFrame:
    """(place, lines, valid, before_lines, before_valid) of each split of rows that carry their place."""
    counts = rows.groupBy("place").agg(F.count("*").alias("lines"), F.count_if(valid).alias("valid"))
    return running(counts, ["place"], ["lines", "valid"])


def at_place(rows: DataFrame, index: DataFrame, count: int) -> DataFrame:
    """Rows with their split's entry. It goes to all tasks only where it is counted few; else a shuffle joins them."""
    return rows.join(F.broadcast(index) if count <= SENT else index, "place")
