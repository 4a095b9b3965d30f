"""Each query of the training-data operators over whole small tables: its digest columns against brute force or the library."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from test_repeats import repeated
from test_simhash import fingerprint, roots

from weftline.llm import queries


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize(("name", "unit", "width"), [("op2_byte_repeats", "byte", 200), ("op10_word_repeats", "word", 35)])
def test_repeats(spark, sf, texts, name, unit, width):
    ids = list(texts)
    units = [texts[i].encode() if unit == "byte" else texts[i].encode().split() for i in ids]
    want = {}
    for i, u, flags in zip(ids, units, repeated(units, width), strict=True):
        gone = np.zeros(len(u) + 1, np.int32)
        for k in np.flatnonzero(flags):
            gone[k : k + width] = 1
        spans = int((np.diff(np.r_[0, gone]) == 1).sum())
        left = [x for x, g in zip(u, gone, strict=False) if not g]
        kept = bytes(left) if unit == "byte" else b" ".join(left)
        want[i] = (len(u), int(gone.sum()), *([spans] if unit == "byte" else []), sha(kept))
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] if unit == "byte" else ["n_words", "n_removed", "kept_sha256"]
    got = queries.QUERIES[name](spark, sf).collect()
    assert {r.doc_id: tuple(r[c] for c in columns) for r in got} == want and len(got) == len(texts)


@pytest.mark.parametrize(("name", "folds", "out", "label"), [("op4_quality", 5, 0, "quality"), ("op6_toxicity", 4, 2, "toxic")])
def test_classifiers(spark, sf, texts, name, folds, out, label):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    fitted = [(got[i].score, y) for i, y in marks.items() if i in got and not got[i].held_out]
    assert np.mean([s for s, y in fitted if y]) > np.mean([s for s, y in fitted if not y]) + 0.2


def test_sentencepiece(spark, sf, texts):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=queries.vocabulary_path("piece_bpe_32k.model"))
    for r in queries.op5_sentencepiece(spark, sf).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))


def test_simhash(spark, sf, texts):
    of = {i: fingerprint(t) for i, t in texts.items()}
    root = roots(set(of.values()))
    least: dict = {}
    for i, p in of.items():
        least[root[p]] = min(least.get(root[p], i), i)
    got = queries.op7_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", least[root[p]]) for i, p in of.items()}


def test_token_counts(spark, sf, texts):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.vocabulary_path("byte_bpe_50k.json"))
    for r in queries.op9_token_counts(spark, sf).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_nearest(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got: dict = {}
    for r in queries.op3_nearest(spark, sf).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = u @ u[q]
        found = [got[ids[q]][k] for k in sorted(got[ids[q]])]
        assert sorted(got[ids[q]]) == list(range(1, 1 + min(5, len(ids) - 1)))
        assert all(abs(s - scores[ids == i][0]) < 1e-12 for i, s in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        scores[q] = -2
        hits += len({i for i, _ in found} & set(ids[np.argsort(-scores)[:5]].tolist()))
    assert set(got) == set(ids[ids % 50 == 0].tolist()) and hits >= 0.9 * 5 * len(got)


def test_counts_of_queries():
    names = Counter(n.split("_")[0] for n in queries.QUERIES)
    assert all(names[f"op{n}"] >= 1 for n in range(1, 14))
