"""The whole run: scan, samples, resume, rounds, answers, routing, summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.strictjson import item_answer
from weftline.operators import grading, resume
from weftline.operators.samples import to_samples
from weftline.plans import durable, resumelog
from weftline.plans import prompts as P
from weftline.plans.config import Config
from weftline.plans.rounds import Rounds, run_rounds
from weftline.sources import scans, sinks

COUNTERS = ("samples", "total_tasks", "resumed_generated", "generated_now", "answered_success", "answered_failed", "skipped_generate", "skipped_answer")


def answer(tasks: DataFrame, config: Config, ask: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Graded rows: each task asks the model its id picks; no or empty output is left out."""
    from weftline.streaming.model_calls import request_key

    names = F.array(*[F.lit(m.model_name) for m in config.answer_models])
    picked = tasks.withColumn("answer_model", F.element_at(names, grading.pick_model(F.col("task_id"), len(config.answer_models)) + 1))
    asked = picked.withColumn("prompt", P.answer_prompt(F.col("user")))
    asked = asked.withColumn("request_key", request_key(F.lit("answer"), F.col("answer_model"), F.concat_ws("\u0001", "task_id", "prompt")))
    got = keep(ask(asked).withColumn("assistant", X.merged_output(F.col("reasoning"), F.coalesce("content", F.lit("")))))
    ok = got.where("error is null and assistant <> ''")
    return grading.grade(ok, F.col("user"), "expected_answer").withColumn("status", F.lit("done"))


def synthesize(spark: SparkSession, config: Config, generate, validate, ask, keep: Callable[[DataFrame], DataFrame] = durable.keep) -> dict[str, int]:
    """Run a configuration with given transports (rows of requests in, rows with responses out); the counters.

    Counters are taken while rows are kept or written; only model responses, and what decides over them, are kept.
    """
    counts = dict.fromkeys(COUNTERS, 0)
    rows, _ = scans.read_rows(spark, config.dataset_path, config.start_index, config.limit)
    samples, seen = durable.counted(to_samples(rows)[0], keep, n=F.count("*"))
    if not seen["n"]:
        return counts
    counts |= {"samples": seen["n"], "total_tasks": seen["n"] * config.variant_count}
    paths = sinks.layout(config.jsonl_path)
    sinks.prepare(spark, paths, config.resume)
    earlier = resumelog.earlier_rows(spark, paths)
    checked = earlier.withColumn("status", resume.checked_status(F.col("status")))  # a bad status stops the run here
    merged = keep(checked)
    wanted = samples.select("sample_id")
    read = resume.pending(wanted, merged, config.variant_count).withColumn("item", item_answer("generated_item_json"))
    known = F.when(F.col("item.error").isNull(), F.col("item.answer")).otherwise(F.raise_error(F.concat("task_id", F.lit(": "), "item.error")))
    pending, seen = durable.counted(read.withColumn("expected_answer", known).drop("item"), keep, n=F.count("*"))  # an item that cannot be read stops the run here
    counts["resumed_generated"] = seen["n"]

    def answered(tasks: DataFrame, n: int) -> None:
        if not config.answer_generated:
            counts["skipped_answer"] += n
            return
        routed = sinks.append_routed(answer(tasks.select("task_id", "user", "expected_answer", "generated_item_json"), config, ask, keep), paths)
        counts["answered_success"] += routed["success"]
        counts["answered_failed"] += routed["failed"]
        counts["skipped_answer"] += n - sum(routed.values())

    if counts["resumed_generated"]:
        answered(pending, counts["resumed_generated"])
    missing = resume.missing(wanted, merged, config.variant_count)
    plan = Rounds(P.load_profile(config.profile_path, config.validate_generated_questions), generate, validate if config.validate_generated_questions else None, config.generation_attempts, keep)
    tasks, outcomes = run_rounds(samples, missing, resume.accepted(wanted, merged, config.variant_count).select("sample_id", "variant_index", "user"), plan)
    made = tasks.select("task_id", F.lit("generated").alias("status"), "user", "generated_item_json", *[F.lit("").alias(n) for n in ("answer_model", "assistant", "text")])
    counts["generated_now"] = sinks.append_rows(made, paths["generate"])
    counts["skipped_generate"] = outcomes.where("not completed").count()
    if counts["generated_now"]:
        answered(tasks, counts["generated_now"])
    return counts
