"""Generation rounds: prompt, call, parse, filter, deduplicate, validate, allocate; all open samples at once.

The driver only counts rounds. State is two tables, accepted tasks and open samples, materialised after each round, so
that no model call is ever evaluated twice and a lost executor does not repeat calls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.strictjson import parse_items, parse_verdicts
from weftline.operators import candidates as C
from weftline.plans import prompts as P
from weftline.plans.durable import keep

#: From requests (request_key, sample_id, prompt) to the same with content and error.
Transport = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Rounds:
    profile: P.Profile
    generate: Transport
    validate: Transport | None = None
    attempts: int = 4
    materialise: Callable[[DataFrame], DataFrame] = keep


def _users(accepted: DataFrame) -> DataFrame:
    """Per sample its accepted users in order."""
    listed = accepted.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("variant_index", "user"))).alias("a"))
    return listed.select("sample_id", F.transform("a", lambda x: x["user"]).alias("users"))


def run_rounds(samples: DataFrame, missing: DataFrame, accepted: DataFrame, plan: Rounds) -> tuple[DataFrame, DataFrame]:
    """(tasks, outcomes). samples: sample_id, source_user, source_meta, ref_answer; missing: sample_id, variant_index;
    accepted: sample_id, variant_index, user. Outcomes: sample_id, wanted, got, rejected, error, completed.

    A failed call stops its sample; a response that cannot be read is fed back, and stops it in the last round; a
    faulty verdict stops it at once. A sample that got nothing keeps its error.
    """
    from weftline.streaming.model_calls import request_key

    save = plan.materialise
    wanted = missing.groupBy("sample_id").agg(F.count("*").alias("wanted"))
    state = save(wanted.select("sample_id", F.lit(None).cast("string").alias("feedback"), F.lit(None).cast("string").alias("error"), F.lit(0).cast("long").alias("rejected")))
    open_slots, taken = save(missing.select("sample_id", "variant_index")), save(accepted.select("sample_id", "variant_index", "user"))
    tasks = None
    for attempt in range(plan.attempts):
        active = state.where("error is null").join(open_slots.groupBy("sample_id").agg(F.count("*").alias("count")), "sample_id")
        if active.isEmpty():
            break
        asked = active.join(samples, "sample_id").join(_users(taken), "sample_id", "left")
        source = P.source_json(F.col("sample_id"), F.col("source_user"), F.col("source_meta"))
        users = F.coalesce("users", F.array().cast("array<string>"))
        asked = asked.withColumn("prompt", P.generation_prompt(plan.profile, F.col("count"), source, P.accepted_json(users), F.col("feedback")))
        asked = asked.withColumn("request_key", request_key(F.lit(f"generate{attempt}"), F.col("sample_id"), F.col("prompt")))
        answers = save(plan.generate(asked.select("request_key", "sample_id", "prompt", "source_user", "source_meta", "ref_answer")))
        read = save(answers.withColumn("parsed", F.when(F.col("error").isNull(), parse_items("content"))))
        last = attempt + 1 == plan.attempts
        stop = F.when(F.col("error").isNotNull(), F.col("error")).when(F.lit(last), F.col("parsed.error"))
        faults = read.where("error is not null or parsed.error is not null").select("sample_id", stop.alias("stop"), F.col("parsed.error").alias("line"))
        drafts = read.where("parsed.items is not null").select("sample_id", "source_user", "source_meta", "ref_answer", F.posexplode("parsed.items").alias("pos", "item"))
        cleaned = drafts.select("*", X.sanitize(F.col("item.user")).alias("user"), X.trim(F.col("item.answer")).alias("answer"), F.col("item.meta").alias("meta"))
        # Kept, so that the rules are worked out once for each candidate and not within every filter by their result.
        judged = save(C.with_reason(cleaned))
        local = judged.where("reason is not null").select("sample_id", F.lit(0).alias("stage"), "pos", F.concat(F.lit("#"), F.col("pos").cast("string"), F.lit(" "), "reason").alias("reason"))
        passed = C.ranked(judged.where("reason is null").drop("reason"), "sample_id", "pos", "at").withColumn("at", F.col("at") - 1)
        known = taken.select("sample_id", X.norm(F.col("user")).alias("norm"))
        marked = save(C.dedup(passed, "sample_id", "at", "user", known))
        twice = marked.where("is_duplicate").select("sample_id", F.lit(1).alias("stage"), F.col("at").alias("pos"), C.duplicate_reason(F.col("at"), F.col("user")).alias("reason"))
        batch = C.ranked(marked.where("not is_duplicate"), "sample_id", "at", "index").withColumn("index", F.col("index") - 1).drop("at")
        stops = faults.where("stop is not null").select("sample_id", "stop")
        reasons = local.unionByName(twice)
        if plan.validate is not None:
            batch, refused, bad = _validated(batch, plan, attempt)
            reasons, stops = reasons.unionByName(refused), stops.unionByName(bad)
            reasons = reasons.join(bad.select("sample_id"), "sample_id", "left_anti")
        got = C.allocate(batch, open_slots, position="index")
        item_json = F.to_json(F.struct("user", "answer"))
        with_meta = F.concat(F.expr("substring(j, 1, length(j) - 1)"), F.lit(',"meta":'), F.coalesce("meta", F.lit("null")), F.lit("}"))
        new = save(got.withColumn("j", item_json).select("sample_id", "variant_index", X.task_id(F.col("sample_id"), F.col("variant_index")).alias("task_id"), "user", F.col("answer").alias("expected_answer"), with_meta.alias("generated_item_json")))
        tasks = new if tasks is None else tasks.unionByName(new)
        taken = save(taken.unionByName(new.select("sample_id", "variant_index", "user")))
        open_slots = save(open_slots.join(new.select("sample_id", "variant_index"), ["sample_id", "variant_index"], "left_anti"))
        told = C.feedback(reasons, "sample_id")
        line = faults.groupBy("sample_id").agg(F.first("line", ignorenulls=True).alias("line"))
        ended = stops.groupBy("sample_id").agg(F.first("stop").alias("stop"))
        joined = state.drop("feedback").join(told, "sample_id", "left") if "rejected" not in told.columns else state.drop("feedback").join(told.withColumnRenamed("rejected", "more"), "sample_id", "left")
        joined = joined.join(line, "sample_id", "left").join(ended, "sample_id", "left")
        state = save(joined.select("sample_id", F.coalesce("line", "feedback").alias("feedback"), F.coalesce("error", "stop").alias("error"), (F.col("rejected") + F.coalesce("more", F.lit(0))).alias("rejected")))
    if tasks is None:
        tasks = samples.select("sample_id", F.lit(0).alias("variant_index"), *[F.lit("").alias(n) for n in ("task_id", "user", "expected_answer", "generated_item_json")]).limit(0)
    counted = tasks.groupBy("sample_id").agg(F.count("*").alias("got"))
    outcomes = wanted.join(state.drop("feedback"), "sample_id").join(counted, "sample_id", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return tasks, outcomes.withColumn("completed", F.col("got") == F.col("wanted"))


def _validated(batch: DataFrame, plan: Rounds, attempt: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid candidates, refusals as reasons, samples that a faulty verdict stops)."""
    from weftline.streaming.model_calls import request_key

    save = plan.materialise
    item = F.struct(F.col("index"), "user", "answer", "meta")
    groups = batch.groupBy("sample_id", "source_user", "source_meta").agg(F.array_sort(F.collect_list(item)).alias("items"), F.count("*").alias("n"))
    source = P.source_json(F.col("sample_id"), F.col("source_user"), F.col("source_meta"))
    asked = groups.withColumn("prompt", P.validation_prompt(plan.profile, source, P.candidates_json(F.col("items"))))
    asked = asked.withColumn("request_key", request_key(F.lit(f"validate{attempt}"), F.col("sample_id"), F.col("prompt")))
    answers = save(plan.validate(asked.select("request_key", "sample_id", "prompt", "n")))
    read = save(answers.withColumn("parsed", F.when(F.col("error").isNull(), parse_verdicts("content"))))
    verdicts = read.where("parsed.items is not null").select("sample_id", F.explode("parsed.items").alias("v")).select("sample_id", "v.*")
    shape = C.verdict_faults(verdicts, read.where("parsed.items is not null").select("sample_id", "n"), "sample_id").where("fault is not null")
    bad = read.where("error is not null or parsed.error is not null").select("sample_id", F.coalesce("error", "parsed.error").alias("stop")).unionByName(shape.select("sample_id", F.col("fault").alias("stop")))
    joined = batch.join(bad.select("sample_id"), "sample_id", "left_anti").join(verdicts.withColumnRenamed("reason", "why"), ["sample_id", "index"])
    refused = joined.where("not valid").select("sample_id", F.lit(2).alias("stage"), F.col("index").alias("pos"), F.concat(F.lit("#"), F.col("index").cast("string"), F.lit(" "), X.trim(F.col("why"))).alias("reason"))
    return joined.where("valid").drop("valid", "why"), refused, bad
