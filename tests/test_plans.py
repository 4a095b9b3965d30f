"""Candidates, resume, rounds and the whole run over recorded responses."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from weftline.operators import candidates, exports, grading, resume
from weftline.plans import config, prompts
from weftline.plans.rounds import Rounds, run_rounds
from weftline.plans.synthesize import synthesize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not find this file
PROFILE = prompts.load_profile()


def test_reject_reasons(spark):
    df = spark.createDataFrame([("", "A"), ("u", ""), ("Assistant: x", "A"), ("u", "Assistant: x"), ("So urce.", "A"), ("u", "A")], "u string, a string")
    got = [r[0] for r in df.select(candidates.reject_reason(F.col("u"), F.col("a"), F.lit("source"))).collect()]
    assert got == [candidates.REASONS[k] for k in ("user_empty", "answer_empty", "user_role", "answer_role", "identical")] + [None]


def test_merge_and_status(spark):
    rows = spark.createDataFrame([("t", "generated", "u", 0, 1), ("t", "done", "", 1, 0), ("x", "odd", "", 0, 2)], "task_id string, status string, user string, file_rank int, line_no long")
    merged = resume.merge(rows, ["user"])
    assert {(r.task_id, r.status, r.user) for r in merged.collect()} == {("t", "done", "u"), ("x", "odd", "")}
    with pytest.raises(Exception, match="unknown status"):
        resume.status_counts(merged).collect()


def test_first_wins_marks_the_id_before_blank_users_fall(spark):
    rows = spark.createDataFrame([("a", " ", 0), ("a", "u", 1), ("", "v", 2), (" ", "v", 3)], "task_id string, user string, line_no long")
    rows = rows.withColumn("assistant", F.lit("x")).withColumn("expected_answer", F.lit("A"))
    got = exports.convert(rows, "success", system="s").collect()
    assert [(r.task_id, r.text) for r in got] == [("", "System: s\n\nUser: v\n\nAssistant: x")] * 2


def test_model_pick_is_stable(spark):
    got = [r[0] for r in spark.range(50).select(grading.pick_model(F.concat(F.lit("t"), "id"), 3)).collect()]
    assert set(got) == {0, 1, 2}


def setting(spark, n=3):
    samples = spark.createDataFrame([(f"s{i}", f"source {i}", "{}", None) for i in range(n)], "sample_id string, source_user string, source_meta string, ref_answer string")
    missing = resume.expected_tasks(samples, 2).select("sample_id", "variant_index")
    return samples, missing, missing.limit(0).withColumn("user", F.lit(""))


def test_bitmaps_plan_as_rows_do(spark):
    """Missing, accepted, pending and open samples against every expected task one by one."""
    samples = spark.createDataFrame([(s,) for s in ("a", "a_q001", "b\n", "", "c", "d")], "sample_id string")
    have = [("a_q000", "done"), ("a_q001", "generated"), ("a_q001_q001", "done"), ("b\n_q129", "generated"), ("b\n_q128", "done"), ("_q063", "generated"), ("_q064", "done"), ("a_q1", "done"), ("a_q0002", "done"), ("x_q000", "generated"), ("q", "done"), ("c_q1000", "done"), ("c_q1001", "done")]
    have += [(f"d_q{i:03d}", "generated") for i in range(1200)]
    merged = spark.createDataFrame(have, "task_id string, status string")
    for variants in (1, 2, 64, 65, 130, 1001):
        expected = resume.expected_tasks(samples, variants)
        rows = lambda df: sorted(tuple(r) for r in df.select("task_id", "sample_id", "variant_index").collect())
        assert rows(resume.missing(samples, merged, variants)) == rows(expected.join(merged, "task_id", "left_anti"))
        assert rows(resume.accepted(samples, merged, variants)) == rows(expected.join(merged, "task_id"))
        assert rows(resume.pending(samples, merged, variants)) == rows(expected.join(merged.where("status = 'generated'"), "task_id"))
        counts = expected.join(merged, "task_id", "left_anti").groupBy("sample_id").count().collect()
        assert {(r.sample_id, r.missing) for r in resume.open_samples(samples, merged, variants).collect()} == {tuple(r) for r in counts}


def shuffled_rows(df):
    """Rows that the exchanges of a plan that has run were given."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_what_is_shuffled_does_not_follow_the_number_of_variants(spark):
    samples = spark.range(400).select(F.concat(F.lit("s"), "id").alias("sample_id"))
    merged = resume.expected_tasks(samples.where("sample_id like '%1'"), 2).select("task_id")
    few, many = (shuffled_rows(resume.missing(samples, merged, v)) for v in (2, 60))
    assert few == many


def test_duplicates_of_one_crowded_norm(spark):
    """First positions against plain Python, over several partitions, with nulls, taken norms and one norm of most rows."""
    rows = [("g" if i % 3 else "h", i, "Same!" if i % 4 else f"own {i % 50}") for i in range(2000)] + [(None, 3000, "a"), (None, 3001, "A."), ("g", 3002, None), ("g", 3003, None), ("h", -1, "own 8")]
    df = spark.createDataFrame(rows, "sample_id string, pos long, user string").repartition(7)
    taken = spark.createDataFrame([("g", "own4"), ("g", "own4"), (None, "zz"), ("h", "own12")], "sample_id string, norm string")
    for held in (None, taken):
        got = {r.pos: (r.norm, r.is_duplicate) for r in candidates.dedup(df, "sample_id", "pos", "user", held).collect()}
        seen = {(r.sample_id, r.norm) for r in held.collect()} if held is not None else set()
        for g, pos, _ in sorted(rows, key=lambda r: r[1]):
            assert got[pos][1] == ((g, got[pos][0]) in seen), (g, pos)
            seen.add((g, got[pos][0]))
    plan = candidates.dedup(df, "sample_id", "pos")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_ranks_of_a_crowded_group_are_the_windows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, None).otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("g"), ((F.col("id") * 7919) % 5000).alias("p"))
    want = sorted(repr(tuple(r)) for r in candidates.ranked(rows, "g", "p", "k").collect())
    for parts in (1, 16):
        got = candidates.ranked_wide(rows, "g", "p", "k", parts)
        assert got.columns == ["g", "p", "k"] and sorted(repr(tuple(r)) for r in got.collect()) == want


def test_first_of_a_crowded_id(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 5 == 0, "").when(F.col("id") % 5 < 4, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("task_id"), F.struct((F.col("id") % 7).alias("a"), F.col("id").alias("b")).alias("line_no"))
    got = exports.first_of_each_id(rows.repartition(5), "task_id", "line_no").collect()
    first = min((r.line_no for r in rows.collect() if r.task_id == "hot"))
    assert [r.line_no for r in got if r.task_id == "hot"] == [first] and len(got) == 600 + 1 + 600


def test_samples_follow_ids_and_not_partitions(spark):
    rows = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("task_id"), F.col("id").alias("n"))
    want = None
    for parts, seed in ((1, 3), (9, 3), (4, 3), (4, 4)):
        got = {r.n for r in exports.sample(rows.repartition(parts), 100, seed).collect()}
        assert len(got) == 100
        want = want or got
        assert (got == want) == (seed == 3)
    assert exports.sample(rows, 6000).count() == 5000 and exports.sample(rows, 0).count() == exports.sample(rows.limit(0)).count() == 0


def replying(answer):
    """A transport from a Python function of sample id and prompt."""
    udf = F.udf(lambda s, p: answer(s, p), "content string, error string")
    return lambda requests: requests.withColumn("r", udf("sample_id", "prompt")).select("*", "r.*").drop("r")


def items(*users):
    return json.dumps({"items": [{"user": u, "answer": "A"} for u in users]}), None


def test_rounds(spark):
    def generate(sample, prompt):
        if sample == "s0":
            return items("one", "One!") if "duplicate variant" not in prompt else items("two")
        if sample == "s1":
            return ("broken", None)
        return (None, "no call")

    tasks, outcomes = run_rounds(*setting(spark), Rounds(PROFILE, replying(generate), None, 2))
    assert {(r.task_id, r.user) for r in tasks.collect()} == {("s0_q000", "one"), ("s0_q001", "two")}
    by = {r.sample_id: r for r in outcomes.collect()}
    assert by["s0"].completed and by["s0"].rejected == 1
    assert not by["s1"].completed and "valid JSON" in by["s1"].error and by["s2"].error == "no call"


def test_rounds_with_verdicts(spark):
    def validate(sample, prompt):
        verdict = lambda i, ok: {"index": i, "valid": ok, "reason": "weak"}
        if sample == "s1":
            return json.dumps({"items": [verdict(0, True)] * 2}), None
        n = prompt.count('"index": ')
        return json.dumps({"items": [verdict(i, i > 0 or n == 1) for i in range(n)]}), None

    generate = lambda s, p: items("three", "four") if "weak" in p else items("one", "two")
    tasks, outcomes = run_rounds(*setting(spark, 2), Rounds(PROFILE, replying(generate), replying(validate), 2))
    by = {r.sample_id: r for r in outcomes.collect()}
    assert by["s1"].got == 0 and "duplicate" in by["s1"].error
    assert {r.user for r in tasks.collect()} == {"two", "four"} and by["s0"].completed


def test_whole_run_and_resume(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join(json.dumps({"task_id": f"t{i}", "context": f"User: q{i}?\n\nAssistant: A"}) for i in range(3)) + "\n{}\n")
    text = f"""
[input]
dataset_path = "{source}"
[generator]
endpoint = "e"
model_name = "m"
api_key = "k"
variant_count = 2
validate_generated_questions = false
[output]
jsonl_path = "{tmp_path}/out/train.jsonl"
[[answer_models]]
endpoint = "e"
model_name = "a"
api_key = "k"
"""
    c = config.parse(text)
    generate = replying(lambda s, p: items(f"{s} x", f"{s} y"))
    ask = lambda r: r.withColumn("content", F.when(F.col("user").endswith("x"), "so A").when(F.col("user").startswith("t2"), "").otherwise("B")).withColumn("reasoning", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string"))
    first = synthesize(spark, c, generate, generate, ask)
    assert first == {"samples": 3, "total_tasks": 6, "resumed_generated": 0, "generated_now": 6, "answered_success": 3, "answered_failed": 2, "skipped_generate": 0, "skipped_answer": 1}
    second = synthesize(spark, c, generate, generate, ask)
    assert (second["resumed_generated"], second["generated_now"], second["skipped_answer"]) == (1, 0, 1)
