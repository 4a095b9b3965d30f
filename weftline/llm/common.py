"""Helpers shared by the training-data operators: reading, checkpoints, clashing columns, Arrow text buffers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a folder of our own only where the session names none, on a single machine."""
    scala_context = spark.sparkContext._jsc.sc()
    current = scala_context.getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder; one of this machine is no use to the executors of a cluster")
    spark.sparkContext.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "weftline-checkpoints"))
    return scala_context.getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that a lost executor costs a reread and not a replay."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose names an operator is about to add (compared as Spark compares names: without case)."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def set_aside(df: DataFrame, used: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with every column but ``used`` under a name that no operator adds, and what gives the old names back.

    So an operator's own columns never meet a caller's, whatever these are called.
    """
    kept = {n.lower() for n in used}
    names = [c if c.lower() in kept else f"carried column {i}" for i, c in enumerate(df.columns)]
    old = list(df.columns)
    return df.toDF(*names), lambda out: out.select(*[F.col(f"`{n}`").alias(o) for n, o in zip(names, old, strict=True)])


#: Bytes of a batch that goes to or from a Python worker; Spark's own default is eight times that.
BATCH_BYTES, SPARK_DEFAULT_BYTES = 8 << 20, 64 << 20


def bound_batches(df: DataFrame) -> None:
    """Keep Arrow batches of texts small, on both sides of the pipe; a setting of the user's own stays as it is."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name).rstrip("b") == str(SPARK_DEFAULT_BYTES):
        conf.set(name, str(BATCH_BYTES))


#: What the operator that last ran in this Python worker keeps over tasks, and which operator that was.
kept_by_worker: dict[str, object] = {}
_ran_last: list[str] = [""]


def settle(operator: str) -> None:
    """A worker serves one operator after another: what the one before kept goes when the next begins."""
    if _ran_last[0] != operator:
        kept_by_worker.clear()
        _ran_last[0] = operator
        hand_back()


def hand_back() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def in_worker(operator: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function that settles first and hands memory back when it is done."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from weftline.llm import common  # the worker's own module, not a pickled copy of its state

        common.settle(operator)
        yield from run(batches)
        common.hand_back()

    return wrapped


def row_keys(id_col: Column, text_col: Column) -> tuple[Column, Column]:
    """96 bits (a long and an int) that stand for a row by its id and whole text. Rows equal in both share them, and every
    result of theirs."""
    known, text = F.coalesce(id_col.cast("string"), F.lit("\u0000null")), F.coalesce(text_col, F.lit(""))
    return F.xxhash64(F.lit(7), known, text), F.shiftright(F.xxhash64(F.lit(11), text, known), 32).cast("int")


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and n+1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of a column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str, budget: int) -> Iterable[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``budget`` bytes, a single longer text by itself."""
    if batch.num_rows == 0:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes) - sizes) // budget
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def with_arrays(batch: pa.RecordBatch, **arrays: pa.Array) -> pa.RecordBatch:
    """The batch with columns added (or replaced, when the name is there)."""
    names = [n for n in batch.schema.names if n not in arrays]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(arrays.values()), names=names + list(arrays))
