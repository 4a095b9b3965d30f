"""Labelled rows for fitting: a bounded sample, drawn by hash, so that every run and every executor draws the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label 0/1) of at most ``rows`` labelled documents; ids and other columns stay behind.

    Labels other than 0 and 1 and null ids are passed over; of an id's several labels the greatest counts, of its several
    documents the least text. The picked labels are broadcast: ``rows`` bounds them.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).where(allowed)
    picked = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    picked = picked.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    met = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), "__id")
    return met.groupBy("__id").agg(F.min("text").alias("text"), F.max("__label").alias("label")).select("text", "label")
