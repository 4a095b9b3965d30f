"""Near-duplicates by similarity against all pairs; planted near copies that two bits of a fingerprint don't link."""

from __future__ import annotations

import random
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

import corpus_pipeline as pipeline
from weftline.llm import simhash, similar


def shingles(text, each=5):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + each]) for i in range(max(1, len(words) - each + 1))) if words else frozenset()


def brute(texts):
    sets = list({shingles(t) for t in texts})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root[find(i)] = find(j)
    return {s: find(i) for i, s in enumerate(sets)}


def test_odd_rows_against_all_pairs(odd_documents, no_documents):
    rows = odd_documents.collect()
    root = brute([r.text for r in rows])
    least: dict = {}
    for r in rows:
        k = root[shingles(r.text)]
        least[k] = min(least.get(k, r.doc_id), r.doc_id, key=lambda i: (i is None, i)) if k in least else r.doc_id
    kept = similar.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))
    assert similar.keep_one(no_documents).count() == 0


def test_stage_drops_planted_near_copies(spark):
    rng = random.Random(2)
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(150, 400))]
        rows.append((i, " ".join(words)))
        for k in range(2):  # one changed word in about 60: similarity of about 0.85
            near = [f"x{rng.randrange(3000)}" if j % 60 == 30 else w for j, w in enumerate(words)]
            rows.append((1000 + 2 * i + k, " ".join(near)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root = brute([t for _, t in rows])
    stage = dict(pipeline.STAGES)["simhash_near_dedup"]
    kept = {r.doc_id for r in stage(spark, docs, "").collect()}
    assert len(kept) == len(set(root.values())) and set(range(150)) <= kept
    assert len(kept) < 200 < simhash.keep_one(docs).count()


def test_unlike_texts_stay_though_a_chain_of_cells_joins_them():
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[a : a + 200]) for a in range(0, 200, 4)] + [" ".join(rng.sample(base, 200)) for _ in range(20)]
    found = similar.connect([similar.shingle_set(t.encode()) for t in texts])
    root = brute(texts)
    same = lambda of: sorted(sorted(i for i in range(len(texts)) if of[i] == k) for k in set(of))
    assert same(found) == same([root[shingles(t)] for t in texts])


def test_sets_that_share_half_their_hash_are_candidates_and_not_one(spark):
    """Two sets of one 64-bit key: in one group whether or not a cell joins them, and told apart by their texts."""
    nodes = spark.createDataFrame([(5, 1, 100, [1]), (5, 2, 7 << 30, [2]), (6, 1, 1 << 60, [3]), (8, 1, 3 << 50, [9]), (9, 1, 5 << 40, [9])], "key long, more long, fp long, cells array<long>")
    assert sorted(tuple(r) for r in similar.candidate_groups(nodes).collect()) == [(5, 5), (8, 8), (9, 8)]
    texts = ["one two three four five six", "quite another text with other words", "one two three four five six"]
    batch = pa.RecordBatch.from_pydict({"root": [5, 5, 5], "key": [5, 5, 5], "more": [1, 2, 1], "text": texts})
    (got,) = similar._verified(iter([batch]))
    assert got.to_pylist() == [{"key": 5, "more": m, "component": 5, "component_more": m} for m in (1, 2)]


def test_large_groups_are_split_with_the_same_result(spark, odd_documents):
    """Every group in blocks, each of a few texts, against groups in one task and all pairs."""
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert ids(similar.keep_one(odd_documents, most=0, block=3000)) == ids(similar.keep_one(odd_documents))
    rng = random.Random(7)
    base = [f"w{i}" for i in range(400)]
    # A chain in which only neighbours are similar, unlike texts that its cells hold too, and copies of one text.
    texts = [" ".join(base[a : a + 200]) for a in range(0, 200, 4)] + [" ".join(base[:150] + rng.sample(base, 60)) for _ in range(20)]
    for _ in range(60):
        words = base[100:300]
        for _ in range(2):
            words[rng.randrange(200)] = f"x{rng.randrange(1000)}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = brute(texts)
    least: dict = {}
    for i, t in enumerate(texts):
        least.setdefault(root[shingles(t)], i)
    assert ids(similar.keep_one(docs, most=0, block=1500)) == sorted(map(str, least.values()))


def test_no_task_gathers_a_large_group(spark, monkeypatch, tmp_path):
    """Three thousand near copies of one text: no task has more than two blocks of them (sets load 1,196 each)."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(3000):
        words = list(base)
        words[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words)))

    def counting(of):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            (tmp_path / uuid.uuid4().hex).write_text(str(sum(b.num_rows for b in held)))
            yield from of(iter(held))

        return run

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    for name in ("_led", "_crossed", "_verified"):
        monkeypatch.setattr(similar, name, counting(getattr(similar, name)))
    kept = similar.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), most=500_000, block=200_000)
    assert [r.doc_id for r in kept.collect()] == [0]
    met = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert met and max(met) <= 2 * 200_000 / 1196 * 1.3
