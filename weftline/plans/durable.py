"""Materialising results that must not be computed again, in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (spark.checkpoint.dir). Where none is named, one of our own, on a single machine only:
    on a cluster a folder of this machine is no use to the executors, so that is refused."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "weftline-checkpoints"))
    return context._jsc.sc().getCheckpointDir().get()


def keep(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def counted(df: DataFrame, save: Callable[[DataFrame], DataFrame], **what: Column) -> tuple[DataFrame, dict[str, int]]:
    """What ``save`` (which must compute all rows, as ``keep`` does) makes of the rows, and aggregates of them that were taken
    on the way, without a job of their own."""
    seen = Observation()
    saved = save(df.observe(seen, *[c.alias(n) for n, c in what.items()]))
    return saved, {n: seen.get[n] for n in what}
