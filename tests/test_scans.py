"""Files read split by split: arrays cut anywhere, indexes of lines, reports of invalid lines; against one pass in Python."""

from __future__ import annotations

import contextlib
import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions.strictjson import Malformed, dumps, loads
from weftline.sources import fileindex, scans


@contextlib.contextmanager
def split_bytes(spark, n):
    """Splits of so many bytes at most."""
    names = {"spark.sql.files.maxPartitionBytes": f"{n}b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read(spark, path, start=0, limit=None):
    return [(r.logical_index, r.raw) for r in scans.read_rows(spark, str(path), start, limit)[0].orderBy("logical_index").collect()]


ODD = [
    '{"context": "a, b ] [ } { \\" , \\\\", "task_id": 1}', '{"k": [1, [2, {"x": "],["}], 3], "text": "é你😀, \\\\\\""}', "3", '"a string, with \\\\\\\\\\" commas ]"',
    "null", "[]", "{}", "[[[[1, 2], 3], 4], 5]", '"\\\\"', '{"a":\n {"b": [ ] } }', "1.50", "true", '"' + "x," * 200 + '"', '"' + "\\\\" * 99 + '"', '"' + "\\\\" * 50 + '\\","',
]


def test_arrays_split_anywhere(spark, tmp_path):
    rng = random.Random(5)
    for n, size in ((0, 7), (1, 16), (12, 16), (80, 61), (80, 1 << 20)):
        parts = [rng.choice(ODD) for _ in range(n)]
        gap = lambda: rng.choice(["", " ", "\n", "\t ", "\r\n"])
        text = gap() + "[" + ",".join(gap() + p + gap() for p in parts) + (" " if not n else "") + "]" + rng.choice(["", "\n", ' trailing , "[ text'])
        (path := tmp_path / f"{n}-{size}.json").write_text(text)
        with split_bytes(spark, size):
            tasks = spark.read.option("lineSep", ",").text(str(path)).rdd.getNumPartitions()
            got = read(spark, path)
        assert got == list(enumerate(parts))
        assert tasks > 1 or size > len(text.encode())


@pytest.mark.parametrize("text", ["[1, 2", "[1,, 2]", "[1, 2,]", "[,1]", "[1 2]", '[1, "x]', "[1, {]", "[1, 2}", "[", "[NaN]", "[01]", '["a\nb"]', "[1, [2]", '[{"a":1,}]', "[1, ]  ]", '["\\x"]', "[tru, 1]", "[{1, 2}, 3]"])
def test_broken_arrays_fail_whole(spark, tmp_path, text):
    """Also where the window asks for rows before the fault only."""
    with pytest.raises(Malformed):  # what one pass says, for what stands before the closing bracket
        loads(text)
    (path := tmp_path / "in.json").write_text(text)
    for size in (4, 1000):
        with split_bytes(spark, size), pytest.raises(Exception, match="JSON|array|bracket"):
            read(spark, path, 0, 1)


def test_array_windows_and_folders(spark, tmp_path):
    (path := tmp_path / "in.json").write_text("[" + ",".join(map(str, range(50))) + "]")
    with split_bytes(spark, 20):
        assert read(spark, path, 10, 5) == [(i, str(i)) for i in range(10, 15)] and read(spark, path, 48) == [(48, "48"), (49, "49")]
        assert read(spark, path, 0, 0) == [] and read(spark, path, 50, 3) == []
        folder = tmp_path / "folder"
        folder.mkdir()
        for k, text in enumerate(["[1, 2]", " \n", "[]", "[3] ,4", '["5"]']):
            (folder / f"f{k}.json").write_text(text)
        assert read(spark, folder) == [(0, "1"), (1, "2"), (2, "3"), (3, '"5"')]


def test_elements_that_span_many_splits(spark, tmp_path):
    items = [{"context": "word, " * 300 + f'"{i}"', "n": i} for i in range(6)]
    (path := tmp_path / "in.json").write_text(json.dumps(items))
    with split_bytes(spark, 50):
        assert [json.loads(raw) for _, raw in read(spark, path)] == items


def one_pass(lines, start, limit):
    kept, bad, index = [], [], 0
    for n, line in enumerate([x for x in lines if x.strip(" ")]):
        if limit is not None and len(kept) >= limit:
            break
        try:
            loads(line)
        except Malformed:
            bad.append(n + 1)
            continue
        if index >= start:
            kept.append((index, line))
        index += 1
    return kept, bad


def test_lines_and_their_report(spark, tmp_path):
    rng = random.Random(6)
    lines = [rng.choice(['{"task_id": %d}' % i, "no json %d" % i, "", "  ", "[%d]" % i]) for i in range(300)]
    (path := tmp_path / "in.jsonl").write_text("\n".join(["{}", *lines]))
    for size, start, limit in ((17, 0, None), (100, 20, 30), (4096, 3, 1), (64, 500, 5), (64, 0, 0)):
        with split_bytes(spark, size):
            frame, report = scans.read_rows(spark, str(path), start, limit)
            got = [(r.logical_index, r.raw) for r in frame.orderBy("logical_index").collect()]
        kept, bad = one_pass(["{}", *lines], start, limit)
        assert got == kept and report["invalid"] == len(bad)
        assert [int(x.split(":")[0].removeprefix("line ")) for x in report["first"]] == bad[: scans.SHOWN_ERRORS]


def test_blank_files_are_refused(spark, tmp_path):
    (path := tmp_path / "in").write_text(" \n\t\n")
    with pytest.raises(ValueError, match="is empty"):
        scans.read_rows(spark, str(path), 0, 0)


def test_running_sums_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(fileindex, "ROWS_A_PART", 40)
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 7).alias("n"))
    want, total = {}, 0
    for r in sorted(rows.collect()):
        want[r.k] = total
        total += r.n
    got = fileindex.running(rows, ["k"], ["n"])
    assert {r.k: r.before_n for r in got.collect()} == want


def test_the_driver_holds_no_list_of_splits(spark):
    """A hundred thousand splits: what is collected is a few rows of totals."""
    many = spark.range(100_000).select(F.struct(F.lit(0).cast("long").alias("append"), F.col("id").alias("part"), F.lit("p").alias("path"), F.lit(0).cast("long").alias("start")).alias("place"), F.lit(3).cast("long").alias("lines"))
    got = fileindex.running(many, ["place"], ["lines"])
    assert got.agg(F.max("before_lines")).first()[0] == 3 * 99_999 and got.where("before_lines <> 3 * place.part").isEmpty()


def test_numbers_keep_their_text():
    assert dumps(loads('{"b": 1.0, "a": 1e5}')) == '{"a":1e5,"b":1.0}'
