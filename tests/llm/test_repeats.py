"""Repeated substrings against brute force; the indexes on their own."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import repeats
from weftline.llm.suffixes import RunLengthIndex, Suffixes, WaveletIndex


def repeated(units, width):
    times = Counter(tuple(u[i : i + width]) for u in units for i in range(len(u) - width + 1))
    return [[times[tuple(u[i : i + width])] > 1 for i in range(len(u) - width + 1)] for u in units]


def brute_spans(texts, unit, width):
    units = [(t or "").encode() if unit == "byte" else (t or "").encode().split() for t in texts]
    out = []
    for u, flags in zip(units, repeated(units, width), strict=True):
        covered = np.zeros(len(u) + 2, np.int8)
        for i in np.flatnonzero(flags):
            covered[i + 1 : i + width + 1] = 1
        out.append(tuple(np.flatnonzero(np.diff(covered)).tolist()))
    return out


def test_indexes_on_random_collections():
    rng = np.random.default_rng(0)
    for _ in range(150):
        letters, base = int(rng.integers(1, 6)), rng.integers(1, 6, 60)
        strings = []
        for _ in range(int(rng.integers(1, 8))):
            a = int(rng.integers(0, 40))
            s = base[a : a + int(rng.integers(0, 60))].copy() if rng.random() < 0.6 else rng.integers(1, letters + 1, int(rng.integers(0, 50)))
            if len(s):
                s[rng.integers(0, len(s))] = 1
            strings.append(s.tolist())
        symbols, width = np.concatenate([np.r_[np.array(s, np.int64), 0] for s in strings]), int(rng.integers(1, 12))
        end = np.cumsum([len(s) + 1 for s in strings]) - 1
        start = end - np.array([len(s) for s in strings])
        twice = (rng.random(len(strings)) < 0.3).astype(np.int64)  # given once, there twice
        all_of_them = strings + [s for s, t in zip(strings, twice, strict=True) if t]
        times = Counter(tuple(s[i:j]) for s in all_of_them for i in range(len(s)) for j in range(i + 1, len(s) + 1))
        own = RunLengthIndex(symbols, twice).statistics()
        for b, s in zip(start, strings, strict=True):  # lengths of the longest matches
            want = [max((j - i for j in range(i + 1, len(s) + 1) if times[tuple(s[i:j])] > 1), default=0) for i in range(len(s))]
            assert own[b : b + len(s)].tolist() == want
        covered = np.zeros(len(symbols), bool)
        for first, after, rows in zip(*WaveletIndex(symbols, twice).matches(symbols, start, end, width), strict=True):
            assert after - first >= width and times[tuple(symbols[first:after].tolist())] == rows
            covered[first : after - width + 1] = True
        for b, s in zip(start, strings, strict=True):
            n = len(s) - width + 1
            assert covered[b : b + max(n, 0)].tolist() == [times[tuple(s[i : i + width])] > 1 for i in range(n)]


def test_suffix_order():
    symbols = np.array([2, 1, 2, 1, 0, 2, 1, 0])
    got = Suffixes(symbols).order.tolist()
    key = lambda i: [x if x else (0, j) for j, x in enumerate(symbols[i:])]
    cut = lambda i: [(int(x), i + j if x == 0 else 0) for j, x in enumerate(symbols[i:])]
    assert got == sorted(range(len(symbols)), key=lambda i: cut(i)) and key(0)


@pytest.mark.parametrize(("unit", "kind", "width", "anchor"), [("byte", "runs", 30, 9), ("word", "wavelet", 7, 3)])
@pytest.mark.parametrize("crowded", [4000, 2])
def test_frames(odd_documents, no_documents, unit, kind, width, anchor, crowded):
    marked = repeats.mark(odd_documents, kind, unit, width, anchor, crowded=crowded, shard_units=2000, step_bytes=4000)
    kept = repeats.remove(marked, unit).withColumn("gone", repeats.removed_units()).collect()
    assert len(kept) == odd_documents.count() and marked.columns.count("spans") == 1 and "fp" in marked.columns
    rows = odd_documents.collect()
    want = Counter((r.doc_id, r.text, s) for r, s in zip(rows, brute_spans([r.text for r in rows], unit, width), strict=True))
    assert Counter((r.doc_id, r.text, tuple(r.spans)) for r in kept) == want
    for r in kept:
        parts = (r.text or "").encode() if unit == "byte" else (r.text or "").encode().split()
        covered = {i for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for i in range(a, b)}
        left = [parts[i : i + 1] if unit == "byte" else parts[i] for i in range(len(parts)) if i not in covered]
        assert bytes(r.kept) == (b"" if unit == "byte" else b" ").join(left) and r.gone == len(covered) and r.n_units == len(parts)
    assert repeats.remove(repeats.mark(no_documents, kind, unit, width, anchor), unit).count() == 0


def test_production_widths(odd_documents):
    rows = odd_documents.collect()
    for marked, unit, width in ((repeats.byte_repeats(odd_documents), "byte", 200), (repeats.word_repeats(odd_documents), "word", 35)):
        want = Counter(brute_spans([r.text for r in rows], unit, width))
        assert Counter(tuple(r.spans) for r in marked.collect()) == want


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


def test_words_of_equal_hashes_differ(spark):
    """A word and its mirror image whose polynomial hashes modulo 2^64 agree for every odd base."""
    one, other = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    lead = " ".join(f"w{i}" for i in range(34))
    frame = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marked = repeats.word_repeats(frame(f"{lead} {one}", f"{lead} {other}", "short")).orderBy("doc_id").collect()
    assert [r.spans for r in marked] == [[], [], []]
    marked = repeats.word_repeats(frame(f"{lead} {one}", f"{lead} {one} {other}")).orderBy("doc_id").collect()
    assert [r.spans for r in marked] == [[0, 35], [0, 35]]
    marked = repeats.byte_repeats(frame(one, other, one[:500])).orderBy("doc_id").collect()
    assert [tuple(r.spans) for r in marked] == brute_spans([one, other, one[:500]], "byte", 200)


@pytest.mark.parametrize(("unit", "kind", "width", "anchor"), [("byte", "runs", 30, 9), ("word", "wavelet", 7, 3)])
def test_a_crowded_anchor_is_spread(spark, unit, kind, width, anchor):
    """A line in many different texts, some of which agree beyond it: as brute force has it, in shards of any size."""
    rng = np.random.default_rng(2)
    line = "the very common line that stands there"
    texts = [" ".join([*map(str, rng.integers(0, 40, 12)), line, *map(str, rng.integers(0, 40, 12))]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = dict(enumerate(brute_spans(texts, unit, width)))
    for crowded in (8, 100_000):
        got = {r.doc_id: tuple(r.spans) for r in repeats.mark(df, kind, unit, width, anchor, crowded=crowded).collect()}
        assert got == want


def test_rows_repeated_many_times(spark):
    """20,000 copies of a row: each has the row's places once."""
    text = " ".join(f"w{i}" for i in range(120))
    df = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(text).alias("text")).unionByName(spark.createDataFrame([(2, text[:300])], "doc_id long, text string"))
    got = repeats.word_repeats(df).groupBy("doc_id", "spans").count().collect()
    assert sorted((r.doc_id, tuple(r.spans), r["count"]) for r in got) == [(1, (0, 120), 20_000), (2, (0, len(text[:300].split()) - (0 if text[300] == " " else 1)), 1)]


def test_the_text_that_lends_an_example_does_not_follow_the_order_of_rows(spark):
    """Marks are the same over any order and partitioning of the rows, as after a task that is run again."""
    rng = random.Random(8)
    shared = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(6)]
    rows = [(i, f"own {i} " + " ".join(rng.sample(shared, 2)) + f" end {i}") for i in range(80)]
    want = None
    for seed, parts in ((0, 1), (1, 3), (2, 7)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r.doc_id, r.spans) for r in repeats.word_repeats(df, crowded=5).collect())
        want = want or got
        assert got == want and any(s for _, s in got)
