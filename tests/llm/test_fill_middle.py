"""Boundary lists and cuts against plain slicing."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from weftline.llm import fill_middle as fim
from weftline.llm.queries import op11_fill_middle


def test_boundaries_select_every_code_point():
    rng = random.Random(3)
    kinds = ["a", "é", "你", "😀", "\n"]
    texts = ["", "a", "é", "😀" * 50, "a" * 5000, "你" * 3000 + "a" * 3000] + ["".join(rng.choices(kinds, [9, 2, 1, 1, 1], k=rng.randint(1, 4000))) for _ in range(20)]
    for t in texts:
        listed = fim.boundaries(t.encode())
        some = range(len(t) + 1) if len(t) < 500 else {0, len(t), 1023, 1024, 1025, 2048} | set(rng.sample(range(len(t) + 1), 200))
        for i in (i for i in some if i <= len(t)):
            assert fim.select(listed, i) == len(t[:i].encode())
        with pytest.raises(IndexError):
            fim.select(listed, len(t) + 1)


def test_long_texts_are_listed_in_steps(monkeypatch):
    t = "aé你😀" * 700
    whole = fim.boundaries(t.encode())
    monkeypatch.setattr(fim, "_STEP", 97)
    assert fim.boundaries(t.encode()) == whole
    assert len(whole) < len(t.encode()) / 2


def expected(doc_id, text, seed=1):
    t = text or ""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if t == "" or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, t
    if h[3] % 100 < 20:
        return len(t), "spm", i, j - i, f"<S>{t[j:]}<P>{t[:i]}<M>{t[i:j]}"
    return len(t), "psm", i, j - i, f"<P>{t[:i]}<S>{t[j:]}<M>{t[i:j]}"


def test_odd_rows(spark, odd_documents, no_documents):
    more = [(300 + i, t) for i, t in enumerate(["<P>", "a <M> b", "<", "P>", "x<S", "😀é" * 300, "<P" * 40, ">" * 40])] + [(None, "same")] * 3 + [(i, "a copy") for i in range(400, 700)]
    docs = odd_documents.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.withColumns({"n": F.lit("old"), "key": F.lit("own key"), "Salt": F.lit("own salt"), "listed": F.lit("own")})
    made = fim.fill_in_middle(docs)
    assert made.columns == [c for c in docs.columns if c not in ("text", "n")] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("restored", fim.rebuilt(F.col("output"), F.col("form"))).collect()
    assert all((r.key, r.Salt, r.listed) == ("own key", "own salt", "own") for r in got)
    rows = docs.select("doc_id", "text").collect()
    assert sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got))) == sorted(repr((r.doc_id, *expected(r.doc_id, r.text), r.text or "")) for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(no_documents).count() == 0


def test_texts_that_share_a_digest_stop_the_run(spark):
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one")], "doc_id long, text string")
    with pytest.raises(Exception, match="share a digest"):
        fim.fill_in_middle(docs, digest=lambda t: F.unhex(F.sha2(F.substring(t, 9, 1), 256))).collect()


def test_query(spark, sf):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = op11_fill_middle(spark, sf).collect()
    want = {i: expected(i, t) for i, t in texts.items()}
    assert {r.doc_id: tuple(r[1:]) for r in got} == {i: (*w[:4], sha(w[4]), sha(texts[i] or "")) for i, w in want.items()} and len(got) == len(texts)
