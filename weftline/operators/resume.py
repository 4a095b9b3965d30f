"""What earlier runs have: merging their rows, and planning what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import task_id, trim


def merge(rows: DataFrame, fields: list[str], key: str | list[str] = "task_id", status: str = "status", order: tuple[str, ...] = ("file_rank", "line_no")) -> DataFrame:
    """One row for each key: the last status, and of each field the last value that is not ''.

    One shuffle; partial aggregates keep a row for each key and task, so a key with very many rows is no burden.
    """
    at = F.struct(*order)
    last = [F.coalesce(F.max_by(F.when(F.col(f) != "", F.col(f)), F.when(F.col(f) != "", at)), F.lit("")).alias(f) for f in fields]
    return rows.groupBy(*([key] if isinstance(key, str) else key)).agg(F.max_by(status, at).alias(status), *last)


def checked_status(status: Column) -> Column:
    """``generated`` or ``done``; anything else stops the run."""
    s = trim(status)
    return F.when(s.isin("generated", "done"), s).otherwise(F.raise_error(F.concat(F.lit("unknown status "), status)))


def status_counts(merged: DataFrame) -> DataFrame:
    s = checked_status(F.col("status"))
    return merged.agg(F.count_if(s == "generated").alias("generated"), F.count_if(s == "done").alias("done"))


def expected_tasks(samples: DataFrame, variants: int, keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """Each sample with variant_index 0..variants-1 and the task's id."""
    each = samples.select(*keep, F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("variant_index"))
    return each.withColumn("task_id", task_id(F.col("sample_id"), F.col("variant_index")))


def task_place(task: Column) -> tuple[Column, Column]:
    """(sample_id, variant_index) of a task's id; nulls for what is no such id."""
    pattern = r"(?s)\A(.*)_q([0-9]{3}|[1-9][0-9]{3,8})\z"
    fits = task.rlike(pattern)
    return F.when(fits, F.regexp_extract(task, pattern, 1)), F.when(fits, F.regexp_extract(task, pattern, 2).cast("int"))


def _placed(merged: DataFrame, variants: int) -> DataFrame:
    """Rows of tasks that could be expected, with sample_id and variant_index."""
    sample, index = task_place(F.col("task_id"))
    return merged.withColumns({"sample_id": sample, "variant_index": index}).where(F.col("variant_index") < variants)


#: Variants in a word of a sample's bitmap.
BITS = 64


def taken_bits(merged: DataFrame, variants: int) -> DataFrame:
    """(sample_id, taken): a bit for each variant that earlier runs have, in words of ``BITS``. A row a sample and task before
    the shuffle, however many variants there are."""
    words = range(-(-variants // BITS))
    index = F.col("variant_index")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), index % BITS)
    held = [F.coalesce(F.bit_or(F.when(F.floor(index / BITS) == w, bit)), F.lit(0).cast("long")) for w in words]
    return _placed(merged.select("task_id"), variants).groupBy("sample_id").agg(F.array(*held).alias("taken"))


def _with_taken(samples: DataFrame, merged: DataFrame, variants: int) -> DataFrame:
    none = F.array(*[F.lit(0).cast("long") for _ in range(-(-variants // BITS))])
    return samples.join(taken_bits(merged, variants), "sample_id", "left").withColumn("taken", F.coalesce("taken", none))


def missing(samples: DataFrame, merged: DataFrame, variants: int, keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """(keep, variant_index, task_id) of each sample's variants that earlier runs don't have: the complement of its bitmap,
    taken in place, so that only what is missing becomes rows."""
    absent = F.filter(F.sequence(F.lit(0), F.lit(variants - 1)), lambda v: F.getbit(F.get("taken", F.floor(v / BITS).cast("int")), v % BITS) == 0)
    each = _with_taken(samples, merged, variants).select(*keep, F.explode(absent).alias("variant_index"))
    return each.withColumn("task_id", task_id(F.col("sample_id"), F.col("variant_index")))


def accepted(samples: DataFrame, merged: DataFrame, variants: int) -> DataFrame:
    """Tasks that earlier runs have, with their rows; rows of no expected task fall away."""
    found = _placed(merged, variants).join(samples.select("sample_id"), "sample_id")
    return found.select("task_id", "sample_id", "variant_index", *[c for c in merged.columns if c != "task_id"])


def pending(samples: DataFrame, merged: DataFrame, variants: int) -> DataFrame:
    """Accepted tasks that still want an answer."""
    return accepted(samples, merged.where(checked_status(F.col("status")) == "generated"), variants)


def open_samples(samples: DataFrame, merged: DataFrame, variants: int) -> DataFrame:
    """Samples with at least one missing variant, and how many; no variant becomes a row."""
    held = F.aggregate("taken", F.lit(0), lambda n, word: n + F.bit_count(word))
    return _with_taken(samples, merged, variants).groupBy("sample_id").agg(F.sum(F.lit(variants) - held).alias("missing")).where("missing > 0")
