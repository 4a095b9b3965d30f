"""Training exports from finished rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X


def first_of_each_id(rows: DataFrame, tid: str, order: str) -> DataFrame:
    """The first row of each id by ``order``, which no two rows share; rows with a blank id all stay.

    First places are least values by id, found by each task for itself before they are sent; only ids that occur more than once
    come back to the rows.
    """
    named = rows.where(F.col(tid) != "").groupBy(F.col(tid).alias("__id")).agg(F.min(order).alias("__first"), F.count("*").alias("__rows"))
    several = named.where("__rows > 1").drop("__rows")
    return rows.join(several, F.col(tid) == F.col("__id"), "left").where(F.col("__id").isNull() | (F.col(order) == F.col("__first"))).drop("__id", "__first")


def export_assistant(split: Column, assistant: Column, expected: Column) -> Column:
    """Success: the answer, else the expected one. Failed: think block and expected answer, whichever there are."""
    a, e, think = X.strip(assistant), X.strip(expected), X.think_block(assistant)
    right = F.when(a != "", a).otherwise(e)
    wrong = F.when((think != "") & (e != ""), F.concat(think, F.lit("\n\n"), e)).when(think != "", think).when(e != "", e).otherwise(a)
    return F.when(split == "success", right).otherwise(wrong)


def export_text(user: Column, assistant: Column, system: str | None = None) -> Column:
    parts = ([F.lit(f"System: {system}")] if system else []) + [F.concat(F.lit("User: "), user), F.concat(F.lit("Assistant: "), assistant)]
    return F.concat_ws("\n\n", *parts)


def convert(rows: DataFrame, split: str, tid: str = "task_id", user: str = "user", order: str = "line_no", system: str | None = None) -> DataFrame:
    """Rows of a split for training. The id is seen even where the row then falls for its blank user."""
    named = rows.withColumn(tid, X.strip(F.col(tid))).withColumn("source_split", F.lit(split))
    first = first_of_each_id(named, tid, order)
    made = first.withColumn("user", X.strip(F.col(user))).withColumn("assistant", export_assistant(F.col("source_split"), F.col("assistant"), F.col("expected_answer")))
    kept = made.where((F.col("user") != "") & (F.col("assistant") != ""))
    return kept.withColumn("text", export_text(F.col("user"), F.col("assistant"), system))


def done_training(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Finished rows as user, assistant and text; ``rewritten_user`` stands in for a missing user. ``keep``: further columns."""
    user = F.coalesce("user", "rewritten_user") if "rewritten_user" in rows.columns else F.col("user")
    line = F.concat(F.lit("User: "), F.coalesce(user, F.lit("null")), F.lit("\nAssistant: "), F.coalesce("assistant", F.lit("null")))
    return rows.where(F.col("status") == "done").select(user.alias("user"), "assistant", line.alias("text"), *keep)


def reference_answers(rows: DataFrame, tid: str = "task_id", order: str = "line_no") -> DataFrame:
    """The last row of each id, if its user is not empty and its reference answer a letter from A to D."""
    at = F.col(order)
    more = [F.max_by(n, at).alias(n) for n in ("sample_id", "status", "answer_model") if n in rows.columns]
    last = rows.groupBy(tid).agg(F.max_by("user", at).alias("user"), F.max_by("ref_answer", at).alias("ref_answer"), *more)
    user = F.regexp_replace(F.regexp_replace("user", r"\A\s+", ""), r"\s+\z", "")
    kept = last.where((F.col("user") != "") & F.col("ref_answer").rlike(r"\A[ABCD]\z"))
    named = [F.col(n).alias(o) for n, o in (("sample_id", "sample_id"), ("status", "source_status"), ("answer_model", "source_answer_model")) if n in rows.columns]
    if named:
        named.append(F.lit("ref_answer").alias("answer_source"))
    return kept.select(tid, *named, user.alias("user"), F.col("ref_answer").alias("assistant"), F.concat(F.lit("User: "), user, F.lit("\nAssistant: "), F.col("ref_answer")).alias("text"))


def sample(rows: DataFrame, n: int = 8000, seed: int = 0, tid: str = "task_id") -> DataFrame:
    """The n rows whose ids have the least hashes: the same for any partitioning, and of any cluster.

    Each task keeps the n least of its hashes, one task the n least of these; the rows themselves are then told by the nth. Rows
    of one id are drawn together, so a repeated id at the end makes a few more.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(tid), F.lit(""))).cast("binary"))
    last = rows.select(drawn.alias("__h")).orderBy("__h").limit(n).agg(F.max("__h")).first()[0]
    return rows.where(drawn <= F.lit(last)) if last is not None else rows.limit(0)
