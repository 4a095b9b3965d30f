"""Strict JSON, scans, sinks, configuration, prompts, model responses."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from weftline.functions import plain, strictjson
from weftline.operators import resume
from weftline.plans import config, export, prompts
from weftline.sources import scans, sinks
from weftline.streaming import model_calls


def test_envelopes_are_strict():
    good = '{"items":[{"user":"u","answer":"a","meta":{"b":1.0,"a":[true,null]}}]}'
    assert strictjson.read_items(good)["items"] == [{"user": "u", "answer": "a", "meta": '{"a":[true,null],"b":1.0}'}]
    assert strictjson.read_items(f"Sure:\n```json\n{good}\n```")["items"]
    assert strictjson.read_items('x {"items":[{"user":"}","answer":"a"}]} y')["items"][0]["user"] == "}"
    for bad in ('{"items":[{"user":"u","answer":3}]}', '{"items":[{"user":"u","answer":"a","x":1}]}', "{'items':[]}", '{"items":[],"items":[]}', '{"items":[]}', "", None, '{x} {"items":[{"user":"u","answer":"a"}]}', '{"items":[{"user":"u","answer":"a","meta":NaN}]}'):
        assert strictjson.read_items(bad)["items"] is None, bad
    assert strictjson.read_verdicts('{"items":[{"index":0,"valid":true,"reason":"r"}]}')["items"] == [{"index": 0, "valid": True, "reason": "r"}]
    assert strictjson.read_verdicts('{"items":[{"index":"0","valid":true,"reason":""}]}')["items"] is None


def test_scalars_and_rows():
    assert [strictjson.scalar(strictjson.loads(x)) for x in ("true", "42", '" text "', "[]", "1.0", '" "', "null")] == ["true", "42", "text", None, "1.0", None, None]
    row = strictjson.read_row('{"task_id":" t ","sample_index":3,"context":"c","ref_answer":"B","other":1,"answer":null}')
    assert (row["task_id"], row["sample_index"], row["ref_answer"]) == ("t", "3", "B")
    assert json.loads(row["meta"]) == {"task_id": " t ", "sample_index": 3, "ref_answer": "B", "answer": None}
    assert strictjson.read_row("not-json")["error"] and strictjson.read_row(None)["error"]


def test_scan_windows(spark, tmp_path):
    lines = tmp_path / "rows.jsonl"
    lines.write_text('{"context":"first"}\nnot-json\n\n{"context":"second"}\n{"context":"third"}\n')
    rows, report = scans.read_rows(spark, str(lines), 1, 1)
    assert [(r.logical_index, r.parsed.context) for r in rows.collect()] == [(1, "second")]
    assert report["invalid"] == 1 and len(report["first"]) == 1
    array = tmp_path / "rows.json"
    array.write_text(' [{"context":"first"}, {"context":"second"},\n{"context":"third"}] trailing')
    rows, _ = scans.read_rows(spark, str(array), 2, 5)
    assert [(r.logical_index, r.parsed.context) for r in rows.collect()] == [(2, "third")]
    array.write_text('[{"context":"a"},]')
    with pytest.raises(Exception, match="comma"):
        scans.read_rows(spark, str(array))[0].collect()
    (blank := tmp_path / "blank").write_text(" \n")
    with pytest.raises(ValueError, match="empty"):
        scans.sniff(spark, str(blank))


def test_dense_index_over_many_partitions(spark):
    df = scans.dense_index(spark.range(0, 1000, 1, 7).where("id % 3 <> 1"))
    assert [r.logical_index for r in df.orderBy("id").collect()] == list(range(667))


def test_output_rows(spark, tmp_path):
    paths = sinks.layout(f"{tmp_path}/run/train.jsonl")
    assert paths["failed"].endswith("run/train/done/failed.jsonl")
    rows = spark.createDataFrame([("t1", "done", "", "", "m", "a", "")], ", ".join(f"{n} string" for n in scans.OUTPUT_FIELDS))
    sinks.prepare(spark, paths, resume=False)
    sinks.append_routed(rows.withColumn("correct", F.lit(True)), paths)
    text = "".join(p.read_text() for p in (tmp_path / "run/train/done/success.jsonl").rglob("*.json"))
    assert json.loads(text) == {"task_id": "t1", "status": "done", "answer_model": "m", "assistant": "a"}
    (tmp_path / "old.jsonl").write_text('{"task_id":"t2","status":"generated","rewritten_user":"u","extra":1}\n')
    back = scans.read_output(spark, [str(tmp_path / "missing"), str(tmp_path / "old.jsonl"), paths["success"]]).orderBy("file_rank").collect()
    assert [(r.task_id, r.user, r.file_rank) for r in back] == [("t2", "u", 1), ("t1", "", 2)]
    (tmp_path / "bad.jsonl").write_text('{"task_id":"t2"}\n')
    with pytest.raises(Exception, match="without status"):
        scans.read_output(spark, [str(tmp_path / "bad.jsonl")]).collect()
    assert scans.read_output(spark, []).count() == 0


CONFIG = """
[input]
dataset_path = "in.jsonl"
[generator]
endpoint = " http://x "
model_name = " m "
api_key = " k "
system_prompt = "  "
variant_count = 2
[[answer_models]]
endpoint = "http://y"
model_name = "a"
api_key = "k"
thinking = {type = " on "}
"""


def test_configuration():
    c = config.parse(CONFIG, "/base")
    assert (c.generator.endpoint, c.generator.system_prompt, c.generation_attempts, c.answer_requests) == ("http://x", None, 4, 16)
    assert c.dataset_path == "/base/in.jsonl" and c.answer_models[0].thinking == "on" and "api_key" not in repr(c.generator)
    for old, new in (("variant_count = 2", "variant_count = 0"), ('"a"', '" "'), ("[input]", "[input]\nwhat = 1"), ("[[answer_models]]", "[[others]]")):
        with pytest.raises(ValueError):
            config.parse(CONFIG.replace(old, new))
    assert [plain.call_partitions(*x) for x in ((0, 5), (8, 3), (4, 0))] == [1, 3, 1]


def test_profiles_and_prompts(spark, tmp_path):
    own = prompts.load_profile()
    assert own.validation and "{{source_sample_json}}" in own.generation
    (p := tmp_path / "p.toml").write_text('name = "n"\n[generation]\ntemplate = "{{variant_count}}|{{accepted_samples_json}}|{{feedback_block}}"\n')
    with pytest.raises(ValueError, match="validation"):
        prompts.load_profile(str(p))
    made = prompts.generation_prompt(prompts.load_profile(str(p), False), F.lit(2), F.lit("{}"), prompts.accepted_json(F.array(F.lit('a"b'))), F.lit("why"))
    text = spark.range(1).select(made).first()[0]
    assert text.startswith('2|[\n  {\n    "user": "a\\"b"\n  }\n]|') and "why" in text
    items = F.array(F.struct(F.lit(0).alias("index"), F.lit("u").alias("user"), F.lit("a").alias("answer"), F.lit(None).cast("string").alias("meta")))
    assert json.loads(spark.range(1).select(prompts.candidates_json(items)).first()[0]) == [{"index": 0, "user": "u", "answer": "a", "meta": None}]


def test_requests_and_responses():
    m = config.Model("e", "m", "k", system_prompt="s", stream=True, thinking="on", max_completion_tokens=5)
    plainly = model_calls.request_body(m, "p", False)
    assert plainly["stream"] and [x["role"] for x in plainly["messages"]] == ["system", "user"] and plainly["thinking"] == {"type": "on"}
    assert "stream" not in model_calls.request_body(m, "p", True) and model_calls.request_body(m, "p", True)["response_format"] == {"type": "json_object"}
    assert model_calls.parse_body('{"choices":[{"message":{"content":" c ","reasoning_content":" ","reasoning":"r"}}]}') == ("c", "r")
    stream = 'data: {"choices":[{"delta":{"reasoning_content":"a"}}]}\n\ndata: {"choices":[{"delta":{"content":"b"}}]}\ndata: [DONE]\ndata: junk'
    assert model_calls.parse_events(stream) == ("b", "a")
    assert model_calls.parse_response(stream, "Text/Event-Stream; x", False) == ("b", "a")
    for bad in ('{"choices":[]}', '{"choices":[{"message":{"content":" "}}]}', "no"):
        with pytest.raises(strictjson.Malformed):
            model_calls.parse_body(bad)
    for bad in ("", "data: nope", 'data: {"choices":[]}'):
        with pytest.raises(strictjson.Malformed):
            model_calls.parse_events(bad)


def test_retry():
    good = (200, None, '{"choices":[{"message":{"content":"c"}}]}')
    for answers, calls, content in (([(500, None, "x"), good], 2, "c"), ([(400, None, "x"), good], 1, None), ([(429, None, "x")] * 3, 3, None), ([(200, None, "bad"), good], 1, None)):
        left, slept = list(answers), []
        got = model_calls.with_retry(lambda left=left: left.pop(0), False, slept.append)
        assert got[0] == content and len(answers) - len(left) == calls and slept == [2, 4][: calls - 1]


def test_appends_are_read_in_their_order(spark, tmp_path):
    """The last status wins: three appends of different sizes, each in several files, then read as one."""
    path = f"{tmp_path}/tasks.jsonl"
    fields = ", ".join(f"{n} string" for n in scans.OUTPUT_FIELDS)
    for status, pad, n in (("generated", "x" * 50_000, 40), ("done", "", 1), ("generated", "y" * 300, 200)):
        rows = [(f"t{i:03}", status, f"{status}{i}", "", "", pad, "") for i in range(n)] + [("last", status, str(n), "", "", "", "")]
        sinks.append_rows(spark.createDataFrame(rows, fields).repartition(3), path)
    rows = scans.read_output(spark, [path])
    got = [r.status for r in rows.where("task_id = 'last'").orderBy("line_no").collect()]
    assert got == ["generated", "done", "generated"]
    merged = {r.task_id: r for r in resume.merge(rows, ["user"]).collect()}
    assert merged["last"].user == "200" and merged["t000"].status == "generated" and len(merged) == 201


def test_input_folders_are_numbered_in_file_order(spark, tmp_path):
    """Files of very different sizes: Spark takes the large ones first, the index does not."""
    (folder := tmp_path / "in").mkdir()
    want = []
    for k, n in enumerate((2, 3000, 1, 500)):
        want += [f"f{k}-{i}" for i in range(n)]
        (folder / f"part-{k:05}-x.json").write_text("".join(json.dumps({"context": f"f{k}-{i}"}) + "\n" for i in range(n)))
    rows, report = scans.read_rows(spark, str(folder))
    assert [r.context for r in rows.orderBy("logical_index").select("parsed.context").collect()] == want and report["invalid"] == 0
    assert rows.agg(F.max("logical_index"), F.count_distinct("logical_index")).first() == (len(want) - 1, len(want))


def test_exports_of_files(spark, tmp_path):
    def row(task, user, assistant, answer, **more):
        return {"task_id": task, "status": "done", "user": user, "assistant": assistant, "generated_item_json": json.dumps({"answer": answer})} | more

    good = [row("a", "u1", "right", "A"), row("a", "again", "x", "A"), row("", "u2", "", " B "), {"task_id": 5, "user": 7}]
    bad = [row("b", "u3", "<think>t</think> no", "C"), row("c", "u4", "plain", "") | {"generated_item_json": "{"}, row("d", " ", "x", "A")]
    for name, rows in (("good", good), ("bad", bad)):
        (tmp_path / f"{name}.jsonl").write_text("\n\n".join(map(json.dumps, rows)) + "\n")
    (tmp_path / "sys.txt").write_text(" be brief \n")
    base = {n: f"{tmp_path}/{n}" for n in ("out", "texts")}
    counts = export.export_training(spark, f"{tmp_path}/good.jsonl", f"{tmp_path}/bad.jsonl", base["out"], base["texts"], system_file=f"{tmp_path}/sys.txt")
    assert counts == {"success": 2, "failed": 2, "total": 4}
    read = lambda name: [json.loads(line) for p in sorted((tmp_path / name).glob("part-*")) for line in p.read_text().splitlines()]
    assert [r["text"] for r in read("out")] == [f"System: be brief\n\nUser: {u}\n\nAssistant: {a}" for u, a in (("u1", "right"), ("u2", "B"), ("u3", "<think>\nt\n</think>\n\nC"), ("u4", "plain"))]
    assert [r["text"] for r in read("texts")] == [r["text"] for r in read("out")] and [r["source_split"] for r in read("out")] == ["success"] * 2 + ["failed"] * 2
    assert export.export_training(spark, f"{tmp_path}/good.jsonl", f"{tmp_path}/none", base["out"], base["texts"], skip_failed=True) == {"success": 2, "failed": 0, "total": 2}
    with pytest.raises(ValueError, match="not both"):
        export.system_prompt(spark, "a", "b")
    with pytest.raises(Exception, match="invalid line"):
        (tmp_path / "broken.jsonl").write_text("{\n")
        export.export_training(spark, f"{tmp_path}/broken.jsonl", "", base["out"], base["texts"])
    done = [{"task_id": "x", "status": "done", "rewritten_user": "r", "assistant": "a"}, {"task_id": "y", "status": "generated", "user": "u"}, {"task_id": "x", "status": "done", "user": "v", "ref_answer": "D"}]
    (tmp_path / "done.jsonl").write_text("\n".join(map(json.dumps, done)))
    assert export.export_done(spark, f"{tmp_path}/done.jsonl", base["out"], base["texts"]) == {base["out"]: 2, base["texts"]: 2}
    assert [r["text"] for r in read("texts")] == ["User: r\nAssistant: a", "User: v\nAssistant: null"]
    assert export.export_reference_answers(spark, f"{tmp_path}/done.jsonl", base["out"], base["texts"], 1) == {base["out"]: 1, base["texts"]: 1}
    assert read("out")[0] | {"sample_id": ""} == {"task_id": "x", "sample_id": "", "source_status": "done", "source_answer_model": "", "answer_source": "ref_answer", "user": "v", "assistant": "D", "text": "User: v\nAssistant: D"}


def test_items_answers_are_read_strictly(spark):
    texts = ['{"user":"u","answer":" B "}', '{"user":"u","answer":" "}', '{"answer":"A"}', "{", None, '{"user":"u","answer":"A","x":1}']
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strictjson.item_answer("t").alias("r")).orderBy("i").collect()
    assert [r.r.answer for r in got] == ["B", None, None, None, None, None] and all((r.r.error is None) == (r.i == 0) for r in got)


def test_replay_is_the_same_in_any_order(spark):
    responses = spark.createDataFrame([("k", "b", None, 1), ("k", "a", "r", 2), ("k", "c", None, 0)], "request_key string, content string, reasoning string, at int").repartition(3)
    asked = spark.createDataFrame([("k",), ("none",)], "request_key string")
    assert {r.request_key: (r.content, r.error) for r in model_calls.replay(asked, responses).collect()} == {"k": ("a", None), "none": (None, "no response is recorded")}
    assert model_calls.replay(asked, responses, "at").where("request_key = 'k'").first().content == "c"


def test_no_key_in_a_plan(spark):
    model = config.Model("http://127.0.0.1:9", "m", "very-secret-key")
    asked = spark.createDataFrame([("k", "p")], "request_key string, prompt string")
    df = model_calls.http(asked, model, 1, 1, False, timeout_s=1)
    plan = df._jdf.queryExecution().toString()
    assert "very-secret-key" not in plan
