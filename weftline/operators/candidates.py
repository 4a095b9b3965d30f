"""Generated candidates: local filters, duplicates, verdicts, allocation, feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.plans.durable import keep

# The reasons that feedback and logs carry.
REASONS = {
    "user_empty": "generated user is empty",
    "answer_empty": "generated answer is empty",
    "user_role": "generated item must be a user prompt, not an assistant response",
    "answer_role": "generated answer must be the final answer only, not a dialogue transcript",
    "identical": "generated item is effectively identical to the original",
    "reference": "generated answer reuses original ref_answer content",
}
FEEDBACK_LEAD, FEEDBACK_JOIN, FEEDBACK_MOST = "部分候选未通过：", " | ", 8


def reject_reason(user: Column, answer: Column, source: Column, reused: Column | None = None) -> Column:
    """The first rule that a candidate (cleaned user, trimmed answer) breaks; null if it passes. ``reused``: whether its answer
    repeats the reference's."""
    why = (
        F.when(user == "", REASONS["user_empty"])
        .when(answer == "", REASONS["answer_empty"])
        .when(user.startswith("Assistant:"), REASONS["user_role"])
        .when(answer.startswith("Assistant:"), REASONS["answer_role"])
        .when(X.norm(user) == X.norm(source), REASONS["identical"])
    )
    return why if reused is None else why.when(F.coalesce(reused, F.lit(False)), REASONS["reference"])


def with_reason(rows: DataFrame, user: str = "user", answer: str = "answer", source: str = "source_user", reference: str = "ref_answer") -> DataFrame:
    """Add ``reason``. Letters and options are columns on the way, so that no rule is written out within another."""
    u, a, s, r = (F.col(n) for n in (user, answer, source, reference))
    letters = rows.withColumns({"__given": X.option_letter(r), "__own": X.option_letter(a), "__same": X.same_answer(a, r)})
    options = letters.withColumns({"__theirs": X.option_at(s, F.col("__given")), "__ours": X.option_at(u, F.col("__own"))})
    reused = F.col("__same") & X.repeats_option(F.col("__theirs"), F.col("__ours"), r)
    return options.withColumn("reason", reject_reason(u, a, s, reused)).drop("__given", "__own", "__same", "__theirs", "__ours")


def norm_key(norm: Column) -> Column:
    """128 bits that stand for a norm where rows are shuffled by it."""
    return F.unhex(F.md5(norm.cast("binary")))


def dedup(candidates: DataFrame, group: str, position: str, user: str = "user", taken: DataFrame | None = None) -> DataFrame:
    """Add norm and is_duplicate: the norm was taken (``taken``: group, norm) or has an earlier position in the group.

    First positions are least values by group and norm (a digest of it), which tasks find for themselves before anything is
    sent; only norms that occur more than once come back to the rows. So a norm that very many rows share is no sorted pile:
    its rows are spread by the join as Spark splits them.
    """
    normed = candidates.withColumn("norm", X.norm(F.col(user))).withColumn("__norm", norm_key(F.col("norm")))
    first = normed.groupBy(F.col(group).alias("__group"), F.col("__norm").alias("__known")).agg(F.min(position).alias("__first"), F.count("*").alias("__rows"))
    first = first.where("__rows > 1").drop("__rows").withColumn("__taken", F.lit(False))
    if taken is not None:
        held = taken.select(F.col(group).alias("__group"), norm_key(F.col("norm")).alias("__known")).distinct().withColumns({"__first": F.lit(None).cast(first.schema["__first"].dataType), "__taken": F.lit(True)})
        first = first.unionByName(held).groupBy("__group", "__known").agg(F.min("__first").alias("__first"), F.max("__taken").alias("__taken"))
    joined = normed.join(first, F.col(group).eqNullSafe(F.col("__group")) & F.col("__norm").eqNullSafe(F.col("__known")), "left")
    twice = F.coalesce(F.col("__taken"), F.lit(False)) | F.coalesce(F.col(position) > F.col("__first"), F.lit(False))
    return joined.withColumn("is_duplicate", twice).drop("__norm", "__group", "__known", "__first", "__taken")


def ranked(rows: DataFrame, group: str, position: str, out: str) -> DataFrame:
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(position)))


def ranked_wide(rows: DataFrame, group: str, position: str, out: str, parts: int | None = None) -> DataFrame:
    """The same ranks where a group may hold a large share of all rows: rows are dealt by ranges of group and position, ranked
    within their range, and raised by what the group has in the ranges before. No task ranks more than a range.

    The dealt rows are kept, as ranges are drawn from a sample and must be the same for rows and counts.
    """
    deal = rows.repartitionByRange(group, position) if parts is None else rows.repartitionByRange(parts, group, position)
    dealt = keep(deal.withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(group).alias("__group"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part", group).orderBy(position))
    met = dealt.withColumn(out, within).join(before, (F.col("__part") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")))
    return met.withColumn(out, F.col(out) + F.col("__before")).drop("__part", "__group", "__of", "__before")


def allocate(survivors: DataFrame, missing: DataFrame, group: str = "sample_id", position: str = "pos", index: str = "variant_index", most: int | None = None) -> DataFrame:
    """The kth survivor gets the kth missing index; those beyond are left out.

    ``most``: missing indexes of a sample at most (counted if not given). With it each task passes on only so many
    survivors of a sample, so that no task ranks all of them.
    """
    if most is None:
        counts = missing.groupBy(group).agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
    a = ranked(survivors, group, position, "__rank").where(F.col("__rank") <= F.lit(most))
    b = ranked(missing.select(group, index), group, index, "__rank")
    return a.join(b, [group, "__rank"]).drop("__rank")


def apply_verdicts(candidates: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Join verdicts (keys, valid, reason) to candidates by group and index."""
    return candidates.join(verdicts, keys, "left")


def verdict_faults(verdicts: DataFrame, sizes: DataFrame, group: str, index: str = "index") -> DataFrame:
    """(group, fault): null where a batch's indexes are just 0..n-1; sizes has (group, n)."""
    got = verdicts.groupBy(group).agg(F.count("*").alias("items"), F.count_distinct(index).alias("kinds"), F.min(index).alias("low"), F.max(index).alias("high"))
    fault = (
        F.when(F.coalesce("items", F.lit(0)) != F.col("n"), F.format_string("validator returned %d items, expected %d", F.coalesce("items", F.lit(0)), F.col("n")))
        .when((F.col("low") < 0) | (F.col("high") >= F.col("n")), "validator returned out-of-range item index")
        .when(F.col("kinds") < F.col("items"), "validator returned duplicate item index")
    )
    return sizes.join(got, group, "left").select(group, "n", fault.alias("fault"))


def feedback(reasons: DataFrame, group: str, stage: str = "stage", position: str = "pos", reason: str = "reason", most: int = FEEDBACK_MOST) -> DataFrame:
    """(group, feedback, rejected): the first reasons by stage and position in one line, and how many there are.

    Ranks come first, so that a group's collected list is never longer than ``most``.
    """
    order = Window.partitionBy(group).orderBy(stage, position)
    rank = reasons.withColumn("__rank", F.row_number().over(order))
    kept = rank.where(F.col("__rank") <= most).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__rank", reason))).alias("r"))
    line = F.concat(F.lit(FEEDBACK_LEAD), F.array_join(F.transform("r", lambda x: x[reason]), FEEDBACK_JOIN))
    return kept.select(group, line.alias("feedback")).join(reasons.groupBy(group).agg(F.count("*").alias("rejected")), group)


def duplicate_reason(index: Column, user: Column) -> Column:
    return F.concat(F.lit("#"), index.cast("string"), F.lit(' duplicate variant "'), X.preview(user, 120), F.lit('"'))
