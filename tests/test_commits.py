"""Appends by manifests: what a stopped run leaves, two writers, splits in one pass; the resume log with its snapshots."""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from weftline.operators import resume
from weftline.plans import durable, resumelog
from weftline.sources import commits, scans, sinks

FIELDS = ", ".join(f"{n} string" for n in scans.OUTPUT_FIELDS)


def rows(spark, *tasks, status="done", **more):
    return spark.createDataFrame([tuple({"task_id": t, "status": status, **more}.get(n, "") for n in scans.OUTPUT_FIELDS) for t in tasks], FIELDS)


def read(spark, paths):
    return sorted((r.task_id, r.file_rank) for r in scans.read_output(spark, list(paths.values())).collect())


def test_routed_in_one_pass_and_one_commit(spark, tmp_path):
    paths = sinks.layout(f"{tmp_path}/run/train.jsonl")
    many = spark.range(500).select(F.concat(F.lit("t"), "id").alias("task_id"), F.lit("done").alias("status"), *[F.lit("").alias(n) for n in scans.OUTPUT_FIELDS[2:]], (F.col("id") % 5 > 0).alias("correct"))
    assert sinks.append_routed(many.repartition(4), paths) == {"success": 400, "failed": 100}
    assert sinks.append_routed(many.where("correct").limit(3), paths) == {"success": 3, "failed": 0}
    assert sinks.append_routed(many.limit(0), paths) == {"success": 0, "failed": 0}
    place = f"{tmp_path}/run/train/done"
    assert [(c.number, dict(c.rows)) for c in commits.commits(spark, place)] == [(1, {"success.jsonl": 400, "failed.jsonl": 100}), (2, {"success.jsonl": 3, "failed.jsonl": 0})]
    assert {r.path: r.lines for r in scans.line_counts(spark, paths["success"], paths["failed"]).collect()} == {paths["success"]: 403, paths["failed"]: 100}
    assert len(read(spark, paths)) == 503
    with pytest.raises(Exception, match="no path for split"):
        sinks.append_routed(many.withColumn("correct", F.when(F.col("task_id") != "t7", F.col("correct"))), paths)
    assert len(read(spark, paths)) == 503


def test_a_run_that_stops_before_its_manifest_leaves_nothing(spark, tmp_path, monkeypatch):
    paths = sinks.layout(f"{tmp_path}/run/train.jsonl")
    graded = rows(spark, "a", "b", "c").withColumn("correct", F.col("task_id") != "b")
    sinks.append_routed(graded, paths)
    real = commits.file_system

    def stopped(spark, path):
        if "failed.jsonl/append-" in path:
            raise KeyboardInterrupt
        return real(spark, path)

    for where in ("between the two splits", "before the manifest"):
        with monkeypatch.context() as m:
            if where == "before the manifest":
                m.setattr(commits, "commit", lambda *_, **__: (_ for _ in ()).throw(KeyboardInterrupt()))
            else:
                m.setattr(commits, "file_system", stopped)
            with pytest.raises(KeyboardInterrupt):
                sinks.append_routed(graded, paths)
        assert read(spark, paths) == [("a", 1), ("b", 2), ("c", 1)]
    sinks.append_routed(rows(spark, "d").withColumn("correct", F.lit(True)), paths)
    assert read(spark, paths) == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]
    half = next((tmp_path / "run/train/done/_commits").glob("*.json")).parent / "000000000009.json"
    half.write_text('{"folders": {"succ')  # a manifest that was not finished
    assert len(read(spark, paths)) == 4
    sinks.append_routed(rows(spark, "e").withColumn("correct", F.lit(True)), paths)
    assert commits.commits(spark, f"{tmp_path}/run/train/done")[-1].number == 10 and len(read(spark, paths)) == 5


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/run/tasks.jsonl"
    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(lambda i: sinks.append_rows(rows(spark, *[f"w{i}-{k}" for k in range(5)]), path), range(12))) == [5] * 12
    found = commits.commits(spark, f"{tmp_path}/run")
    assert len({c.number for c in found}) == 12
    with monkeypatch.context() as m:
        m.setattr(commits, "FEW", 3)
        assert commits.commits(spark, f"{tmp_path}/run") == found
    assert len({r.task_id for r in scans.read_output(spark, [path]).collect()}) == 60


def test_starting_anew_and_files_of_others(spark, tmp_path):
    paths = sinks.layout(f"{tmp_path}/run/train.jsonl")
    (tmp_path / "run/train/generate").mkdir(parents=True)
    (tmp_path / "run/train/generate/tasks.jsonl").write_text('{"task_id":"old","status":"generated","rewritten_user":"u"}\n')
    assert read(spark, paths) == [("old", 0)]
    sinks.append_rows(rows(spark, "new"), paths["generate"])
    merged = scans.read_output(spark, [paths["generate"]])
    assert [r.task_id for r in merged.orderBy("line_no").collect()] == ["old", "new"]
    sinks.prepare(spark, paths, resume=True)
    assert read(spark, paths) == [("new", 0), ("old", 0)]
    sinks.prepare(spark, paths, resume=False)
    assert read(spark, paths) == [] and not list((tmp_path / "run").rglob("part-*"))


def test_snapshots_say_what_the_whole_log_says(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    paths = sinks.layout(f"{tmp_path}/run/train.jsonl")

    def more(n):
        for _ in range(n):
            name = rng.choice(list(paths))
            part = [tuple(rng.choice(["", f"{f}{rng.randrange(1000)}"]) if f not in ("task_id", "status") else f"t{rng.randrange(12)}" if f == "task_id" else rng.choice(["done", "generated"]) for f in scans.OUTPUT_FIELDS) for _ in range(rng.randint(1, 6))]
            sinks.append_rows(spark.createDataFrame(part, FIELDS), paths[name])

    def same():
        whole = resume.merge(scans.read_output(spark, list(paths.values())), resumelog.PAYLOAD)
        return sorted(whole.collect()) == sorted(resume.merge(resumelog.read_log(spark, paths)[0], resumelog.PAYLOAD).select(whole.columns).collect())

    more(5)
    resumelog.compact(spark, paths)
    assert resumelog.read_log(spark, paths)[1] == 0 and same()
    more(3)
    assert resumelog.read_log(spark, paths)[1] == 3 and same()
    resumelog.compact(spark, paths)
    more(1)
    read_files = resumelog.read_log(spark, paths)[0].inputFiles()
    assert {f.split("/")[-2].split("-")[0] for f in read_files} == {"snapshot", "append"} and len({f.split("/")[-2] for f in read_files}) == 2 and same()
    monkeypatch.setattr(resumelog, "COMPACT_AFTER", 2)
    more(1)
    assert resumelog.earlier_rows(spark, paths).count() <= 12 and resumelog.read_log(spark, paths)[1] == 0 and same()
    sinks.prepare(spark, paths, resume=False)
    assert resumelog.earlier_rows(spark, paths).count() == 0
    more(1)
    assert resumelog.read_log(spark, paths)[1] == 1 and same()


def test_counted_on_the_way(spark):
    df = spark.range(1000).repartition(5)
    saved, seen = durable.counted(df, durable.keep, n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"n": 1000, "odd": 500} and saved.count() == 1000
    assert durable.counted(df.limit(0), durable.keep, n=F.count("*"))[1] == {"n": 0}


def test_manifests_are_plain(spark, tmp_path):
    sinks.append_rows(rows(spark, "a"), f"{tmp_path}/x/tasks.jsonl")
    (file,) = (tmp_path / "x/_commits").glob("*.json")
    said = json.loads(file.read_text())
    assert said["rows"] == {"tasks.jsonl": 1} and list(said["folders"]) == ["tasks.jsonl"]
