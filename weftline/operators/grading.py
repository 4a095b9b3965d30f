"""Model answers: grading, routing, counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X


def grade(rows: DataFrame, user: Column | None = None, expected: str = "expected", assistant: str = "assistant") -> DataFrame:
    """Add correct, split and (given a user column) the training text, '' for wrong answers."""
    graded = rows.withColumn("correct", X.correct(F.col(expected), F.col(assistant)))
    graded = graded.withColumn("split", F.when(F.col("correct"), "success").otherwise("failed"))
    if user is None:
        return graded
    return graded.withColumn("text", F.when(F.col("correct"), X.training_text(user, F.col(assistant))).otherwise(""))


def answered(rows: DataFrame, assistant: str = "assistant") -> DataFrame:
    """Rows whose model gave anything; the others are skipped, not failed."""
    return rows.where(X.trim(F.col(assistant)) != "")


def letter_by_chance(expected: Column) -> Column:
    """Free text that is graded by a stray letter: it has a label but is not that letter alone."""
    return X.label(expected).isNotNull() & ~X.trim(expected).rlike(r"\A[A-Za-z]\z")


def split_counts(graded: DataFrame) -> DataFrame:
    return graded.groupBy("split").agg(F.count("*").alias("n"))


def answer_stats(graded: DataFrame, skipped: Column) -> DataFrame:
    ok = ~skipped
    return graded.agg(F.count_if(ok & F.col("correct")).alias("success"), F.count_if(ok & ~F.col("correct")).alias("failed"), F.count_if(skipped).alias("skipped"))


def pick_model(task_id: Column, models: int) -> Column:
    """A model's place from the task's id: the same in every run."""
    return (F.conv(F.substring(F.md5(task_id.cast("binary")), 1, 8), 16, 10).cast("long") % F.lit(models)).cast("int")
