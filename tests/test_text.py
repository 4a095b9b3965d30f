"""Text rules against small Python versions written from their definitions, on fuzzed strings."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from weftline.functions import plain
from weftline.functions import text as X

WS = "\t\n\x0b\x0c\r \x85\xa0　 "
SEPS = set(WS) | set(",.;:()[]{}，。；：（）【】")


def label(text: str) -> str | None:
    token, tokens = "", []
    for c in text + ",":
        if c in SEPS:
            tokens.append(token)
            token = ""
        else:
            token += c
    core = [re.sub(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", t) for t in tokens]
    singles = [c for c in core if re.fullmatch("[A-Za-z]", c)]
    if singles:
        return singles[-1].upper()
    runs = [r for r in re.findall("[A-Za-z]+", text) if len(r) == 1]
    return runs[-1].upper() if runs else None


def single(text: str) -> str | None:
    led = "\n" + plain.unescape(text).strip(WS)
    if not led.startswith("\nUser:") or led.count("\nUser:") != 1 or led.count("\nAssistant:") != 1:
        return None
    return led[6 : led.index("\nAssistant:")].strip(WS) or None


def last_line(text: str) -> str:
    return next((x.strip(WS) for x in reversed(text.split("\n")) if x.strip(WS)), "")


def fuzzed(n: int) -> list[str]:
    rng = random.Random(4)
    parts = ["A", "b", "Z", " ", ".", "\n", "(", "）", "，", "word", "don't", "**", "User:", "\nUser:", "\nAssistant:", "\\n", "\\\\", "\\t", "\\", "1", "é", "　", "-C-", "\x85"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_fuzzed_rules(spark):
    cases = fuzzed(3000)
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    t = F.col("t")
    got = df.select("t", X.unescape(t), X.label(t), X.single_turn(t), X.last_line(t)).collect()
    for c, u, lab, s, line in got:
        assert u == plain.unescape(c), c
        assert lab == label(c), c
        assert s == single(c), c
        assert line == last_line(c), c


def rows(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(column(F.col("t"))).collect()]


def test_normalise_sanitise_preview(spark):
    assert rows(spark, X.norm, " A， B. C ", "选择：甲、乙", "ΑΣ", "—《a》…") == ["abc", "选择甲乙", "ας".replace("ς", "σ"), "—《a》…"]
    lead = "You are a very talented expert in math. "
    assert rows(spark, X.sanitize, lead + "Question: 1+1?", lead * 2 + "x", "You are a very talented expert in no end", " x ") == ["Question: 1+1?", "x", "You are a very talented expert in no end", "x"]
    assert rows(spark, lambda c: X.preview(c, 3), " abc ", "abcd") == ["abc", "abc..."]


def test_prompt_user_allows_several_turns(spark):
    many = "User: one\nAssistant: a\nUser: two\nAssistant: b"
    assert rows(spark, X.single_turn, many) == [None]
    assert rows(spark, X.prompt_user, many, "User: only", "none") == ["one", "only", None]


def test_options_and_references(spark):
    text = "Question:\nA. one\nB. two B. not first\nC. \nD. four"
    df = spark.createDataFrame([(text, a) for a in ("A", "b.", "C", "D)", "E", "")], "u string, a string")
    assert [r[0] for r in df.select(X.option_text(F.col("u"), F.col("a"))).collect()] == ["one", "two", None, "four", None, None]
    reuse = lambda s, u, a, r: spark.range(1).select(X.reuses_reference(F.lit(s), F.lit(u), F.lit(a), F.lit(r))).first()[0]
    assert reuse(text, text, "a", "A")
    assert not reuse(text, text.replace("one", "uno"), "A", "A")
    assert not reuse(text, text, "B", "A")
    assert reuse("free", "free", "same", "Same")  # no option text to tell them apart
    assert not reuse(text, text, "A", " ")


def test_answers(spark):
    df = spark.createDataFrame([("A", "Reasoning...\nA"), ("answer: c", "therefore C"), ("A", "B"), ("1+1", "so\n1 + 1"), ("12", "x\n13")], "e string, a string")
    assert [r[0] for r in df.select(X.correct(F.col("e"), F.col("a"))).collect()] == [True, True, False, True, False]
    merged = spark.createDataFrame([(" r ", " c "), ("r", ""), (None, " c")], "r string, c string").select(X.merged_output(F.col("r"), F.col("c"))).collect()
    assert [m[0] for m in merged] == ["<think>\nr\n</think>\n\nc", "<think>\nr\n</think>", "c"]
    assert rows(spark, X.think_block, "x<think> a </think>b", "<think>open", "<think></think>", "none", None) == ["<think>\na\n</think>", "<think>\nopen\n</think>", "<think>\n</think>", "", ""]
    assert rows(spark, lambda c: X.task_id(c, F.lit(7)), "s") == ["s_q007"]
    assert spark.range(1).select(X.task_id(F.lit("s"), F.lit(12345))).first()[0] == "s_q12345"


def one(spark, value, rule):
    return spark.createDataFrame([(value,)], "t string").select(rule(F.col("t")).alias("r")).first().r


def decoded(text):
    out, i = [], 0
    codes = {"n": "\n", "r": "\r", "t": "\t", "\\": "\\", '"': '"', "/": "/"}
    while i < len(text):
        if text[i] == "\\" and text[i + 1 : i + 2] in codes and i + 1 < len(text):
            out.append(codes[text[i + 1]])
            i += 2
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_unescape_decodes_each_pair_from_the_left(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice('\\\\\\nrt"/ab') for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["", "a\\\\n", "\\", "\\\\", "\\\\\\n"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.unescape(F.col("t")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {i: decoded(t) for i, t in enumerate(texts)}


def test_long_runs_and_many_leads_take_linear_time(spark):
    began = time.time()
    spaces = "a" + " " * 100_000 + "b　 "
    assert one(spark, spaces, X.trim) == spaces[:-2] and one(spark, spaces, X.strip) == spaces[:-2]
    assert one(spark, " \n" * 50_000, X.trim) == ""
    leads = "You are a very talented expert in law. \n" * 20_000 + "the question."
    assert one(spark, leads, X.sanitize) == "the question."
    assert time.time() - began < 20


def test_norm_drops_what_its_class_says(spark):
    kept = "".join(c for c in map(chr, [*range(1, 0x300), *range(0x1F00, 0x2100), *range(0x3000, 0x3020), *range(0xFF00, 0xFF20)]) if not re.match(f"[{X.WHITE_CHARACTERS}{re.escape(X.ASCII_SIGNS)}{X.WIDE_MARKS}]", c))
    everything = "".join(map(chr, [*range(1, 0x300), *range(0x1F00, 0x2100), *range(0x3000, 0x3020), *range(0xFF00, 0xFF20)]))
    assert one(spark, everything, X.norm) == one(spark, kept, lambda c: F.lower(F.translate(c, "Σ", "σ")))
    assert one(spark, everything, lambda c: F.regexp_replace(c, f"[{X.WHITE}{X.ASCII_MARKS}{X.WIDE_MARKS}]", "")) == kept
