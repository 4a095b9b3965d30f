"""Held-out accuracy on the given labels (a tenth of the toxic ones there name no toxic word), gradients, odd texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import labels, quality, toxicity
from weftline.llm.common import read_table, text_bytes

SF = "/root/testdata/sf0.1"


def auc(scores, marks):
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    one = marks == 1
    return (rank[one].mean() - (one.sum() - 1) / 2) / (~one).sum()


@pytest.mark.parametrize(("kind", "label", "folds", "left_out", "least"), [(quality, "quality", 5, 0, 0.97), (toxicity, "toxic", 4, 2, 0.9)])
def test_held_out(spark, kind, label, folds, left_out, least):
    docs, marks = read_table(spark, SF, "documents").select("doc_id", "text"), read_table(spark, SF, "labels")
    fold = labels.fold(F.col("doc_id"), folds)
    sample = labels.training_sample(docs, marks, label, fold != left_out, 1200)
    assert sample.count() <= 1200 and sample.columns == ["text", "label"]
    held = docs.join(marks.where(fold == left_out), "doc_id").limit(1000)
    got = kind.score(held.select("text", label), kind.fit(sample)).select(label, "score").toPandas()
    assert got["score"].between(0, 1).all()
    assert auc(got["score"].to_numpy(), got[label].to_numpy()) >= least


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_odd_texts(spark, odd_documents, no_documents, kind):
    sample = spark.createDataFrame([("bad words here idiot", 1), ("fine words here", 0), (None, 0), ("", 1)] * 5, "text string, label int")
    model = kind.fit(sample)
    scored = kind.score(odd_documents, model, step_bytes=3000)
    rows = scored.collect()
    assert len(rows) == odd_documents.count() and scored.columns.count("score") == 1 and all(0 <= r.score <= 1 for r in rows)
    same: dict = {}
    for r in rows:
        assert abs(same.setdefault(r.text, r.score) - r.score) < 1e-5  # alone or beside others
    assert kind.score(no_documents, model).count() == 0
    none = kind.fit(sample.limit(0))
    assert all(0 <= r.score <= 1 for r in kind.score(odd_documents, none).collect())


def test_training_sample_skips_what_it_cannot_use(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 1), (1, 5)], "doc_id long, quality int")
    got = labels.training_sample(docs, marks, "quality", F.lit(True), 10).collect()
    assert sorted((r.text or "", r.label) for r in got) == [("", 0), ("a", 1)]


def test_gradients_of_the_network():
    texts = [b"you idiot there", b"all is well with us", b"scum of it"]
    net = toxicity.train(texts, np.array([1, 0, 1]), epochs=1)
    for name in ("word", "char", "attend", "asked", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.inputs, net.offset, net.recur = ([p.astype(np.float64) for p in ps] for ps in (net.inputs, net.offset, net.recur))
    data, offsets = text_bytes(pa.array([t.decode() for t in texts]))
    count, keys, which, trigrams = toxicity.spell(data, offsets)
    text, start, length = toxicity.windows(count)
    steps = np.arange(int(length.max()))[:, None]
    index, mask = which[np.minimum(start + steps, len(which) - 1)], steps < length
    wanted, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        vectors, _ = net.embed(keys, trigrams)
        z = net.run(net.gates(vectors), index, mask).astype(np.float64)
        return float((weight * (np.logaddexp(0, z) - wanted * z)).sum())

    vectors, row = net.embed(keys, trigrams)
    grads = toxicity._gradients(net, vectors, row, trigrams, index, mask, wanted, weight)
    rng = np.random.default_rng(0)
    for name, holder in (("out", net.out), ("attend", net.attend), ("asked", net.asked), ("recur0", net.recur[0]), ("inputs1", net.inputs[1]), ("offset0", net.offset[0]), ("char", net.char)):
        for at in rng.integers(0, holder.size, 4) if name != "char" else trigrams[0][:4] * toxicity.CHAR:
            flat, step = holder.reshape(-1), 1e-2
            old = flat[at]
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * step) - np.asarray(grads[name]).reshape(-1)[at]) < 2e-2, name


def test_windows_overlap_and_cover():
    text, start, length = toxicity.windows(np.array([0, 1, 24, 25, 100]))
    for t, n, first in ((1, 1, 0), (2, 24, 1), (3, 25, 25), (4, 100, 50)):
        own = text == t
        covered = {i for s, m in zip(start[own], length[own], strict=True) for i in range(s - first, s - first + m)}
        assert covered == set(range(n))
    assert not (text == 0).any()


def test_sample_is_bounded_for_repeated_ids(spark):
    docs = spark.range(5000).select((F.col("id") % 50).alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    marks = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    got = labels.training_sample(docs, marks, "quality", F.lit(True), 10).collect()
    assert len(got) == 10 and len({r.text for r in got}) == 10


def test_windows_for_training_are_bounded_and_spread(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    got = toxicity.windows_of(spark.createDataFrame([(long, 1), ("short text", 0), (None, 0)], "text string, label int")).collect()
    sizes = sorted(len(bytes(r.words).split()) for r in got)
    assert sizes == [0, 2, toxicity.MOST_WINDOWS * toxicity.LENGTH]
    words = bytes(max(got, key=lambda r: len(r.words)).words).split()
    assert words[0] == b"w0" and words[-1] == b"w49999"


def test_the_network_learns_more_than_a_word_table():
    """A word is bad only beside another one: no table of single words can tell, windows can."""
    rng = np.random.default_rng(5)
    fill = [f"w{i}" for i in range(40)]
    texts, marks = [], []
    for k in range(700):
        words = rng.choice(fill, 20).tolist()
        at, y = int(rng.integers(0, 18)), k % 2
        # Both words are in every text; in bad ones they are neighbours.
        if y:
            words[at : at + 2] = ["green", "stone"]
        else:
            words[at], words[(at + 7) % 20] = "green", "stone"
        texts.append(" ".join(words))
        marks.append(y)
    marks = np.array(marks)
    net = toxicity.train([t.encode() for t in texts[:500]], marks[:500], epochs=40)
    scores = net.score(*text_bytes(pa.array(texts[500:])))
    assert auc(scores, marks[500:]) > 0.85
