"""Encoding, decoding and counting against the libraries, with their public vocabularies."""

from __future__ import annotations

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from weftline.llm import fst_tokens, merges, pieces  # noqa: E402

MODEL, TABLE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(1)
    signs = list("abcdestrvlm'' \n\t  .,!019ÀéßñΣ你好 ́ ▁\r\x0b\x1c\x85\xa0 <>|²Ⅷ😀\x00") + ["the ", "'re", "'ll ", " 's", "<|endoftext|>", "<s>", "<unk>", "<0x0A>", "   ", "ing", "tion", "'ve"]
    made = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 5, 20, 60]))) for _ in range(3000)]
    return made + [" " * n for n in range(40)] + ["a" * n for n in range(40)] + ["ab" * 300, "x" * 5000]


def test_pieces_equal_the_library(strings):
    own, library = pieces.Codec(pieces.load_model(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for s in strings:
        ids = np.frombuffer(own.encode(s), np.int32)
        want = library.encode(s)
        assert ids.tolist() == want, repr(s)
        assert own.decode(ids) == library.decode(want), repr(s)


def test_counts_equal_the_library(strings):
    library = tokenizers.Tokenizer.from_file(TABLE)
    want = [len(e.ids) for e in library.encode_batch(strings, add_special_tokens=False)]
    assert fst_tokens.Counter(fst_tokens.load_tokenizer(TABLE)).count(strings) == want


def test_every_code_point_splits_as_in_the_library():
    """Each code point between a letter and a contraction, and alone between blanks; long texts of many such."""
    library, counter = tokenizers.Tokenizer.from_file(TABLE), fst_tokens.Counter(fst_tokens.load_tokenizer(TABLE))
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    for pattern in ("a{}'s {}9'll {} {}", "{}'re"):
        made = ["\n".join(pattern.replace("{}", c) for c in points[a : a + 64]) for a in range(0, len(points), 64)]
        want = [len(e.ids) for e in library.encode_batch(made, add_special_tokens=False)]
        got = [n for a in range(0, len(made), 500) for n in counter.count(made[a : a + 500])]
        assert got == want, [hex(64 * i) for i, (a, b) in enumerate(zip(got, want, strict=True)) if a != b][:20]


def test_state_maps_do_not_depend_on_chunks():
    rng = np.random.default_rng(2)
    classes = rng.integers(0, 12, 5000).astype(np.uint8)
    classes[-1] = fst_tokens.RESET
    state, marks = 0, np.zeros(len(classes) + 1, bool)
    for i, c in enumerate(classes):
        m = fst_tokens.MARKS[state, c]
        marks[i] |= bool(m & fst_tokens.HERE)
        if m & fst_tokens.BEFORE:
            marks[i - 1] = True
        state = fst_tokens.NEXT[state, c]
    for width in (1, 7, 128, 8192):
        assert (fst_tokens.starts(classes, width) == marks[:-1]).all()


def test_frames(spark, odd_documents, no_documents):
    model, spec = pieces.load_model(MODEL), fst_tokens.load_tokenizer(TABLE)
    library, counter = sentencepiece.SentencePieceProcessor(model_file=MODEL), tokenizers.Tokenizer.from_file(TABLE)
    rows = pieces.decode(pieces.encode(odd_documents, model, step_bytes=3000), model).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "")
    counted = fst_tokens.count_tokens(odd_documents, spec, step_bytes=3000)
    assert counted.columns.count("n_tokens") == 1 and "score" in counted.columns
    for r in counted.collect():
        assert r.n_tokens == len(counter.encode(r.text or "", add_special_tokens=False).ids) and r.n_bytes == len((r.text or "").encode())
    assert pieces.digests(pieces.decode(pieces.encode(no_documents, model), model), ["doc_id"]).count() == 0
    assert fst_tokens.count_tokens(no_documents, spec).count() == 0
    with pytest.raises(ValueError):
        fst_tokens.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_words_of_equal_hashes_are_told_apart(spark):
    """Two words whose polynomial hashes modulo 2^64 agree for every odd base, in one batch."""
    library = tokenizers.Tokenizer.from_file(TABLE)
    words = ["".join((a, b)[i.bit_count() & 1] for i in range(1024)) for a, b in ("ab", "ba")]
    want = [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    assert want[0] != want[1]
    counted = fst_tokens.count_tokens(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1), fst_tokens.load_tokenizer(TABLE))
    assert [r.n_tokens for r in counted.orderBy("doc_id").collect()] == want


def test_transitions_carry_the_counts(strings):
    """The transducer's running sum is the number of tokens of each prefix; compiling anew changes nothing."""
    counter = fst_tokens.Counter(fst_tokens.load_tokenizer(TABLE))
    own = counter.transducer
    small = type(own)(own.table, most=50)
    for word in ("abstraction", "'ll", "xxxxxxxxyz", "antidisestablishmentarianism", "ÀéßñΣ"):
        symbols = word.encode().decode("latin-1").translate(counter.letters)
        state, total = 0, 0
        for n, symbol in enumerate(symbols, 1):
            state, emitted = own.next.get((state, symbol)) or own.compile(state, symbol)
            total += emitted
            assert total == len(own.table.merge(symbols[:n])) == small.count(symbols[:n])


def test_one_worker_a_task_encodes_and_decodes(spark, odd_documents, no_documents, tmp_path):
    """One pass gives what the two give, and neither query keeps two Python workers, with two codecs, in one task."""
    import corpus_pipeline
    from weftline.llm import queries

    model = pieces.load_model(MODEL)
    one = pieces.encode_and_decode(odd_documents, model, step_bytes=3000)
    two = pieces.decode(pieces.encode(odd_documents, model), model)
    assert one.schema == two.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert pieces.encode_and_decode(no_documents, model).count() == 0
    odd_documents.select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (corpus_pipeline.sentencepiece_codec(spark, docs, str(tmp_path)), queries.op5_sentencepiece(spark, str(tmp_path))):
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_what_is_remembered_is_bounded_in_bytes(monkeypatch):
    """Wide stretches with many ids: a generation ends by its bytes, long before its entries are as many as may be."""
    monkeypatch.setattr(merges, "HELD_BYTES", 1 << 20, raising=False)
    made = []
    known = merges.Remembered(lambda key: made.append(key) or bytes(4 * len(key)))
    for i in range(20_000):
        assert known[f"{i:048d}"] == bytes(192)
    size = sum(len(k) + len(v) for generation in (known, known.older) for k, v in generation.items())
    assert 0 < size <= 2 << 20 and len(made) == 20_000
    assert known[f"{19_999:048d}"] and len(made) == 20_000  # the latest is still known


def test_a_task_leaves_nothing_it_remembered():
    """Idle workers are dealt tasks in turn, so all of them would fill: after a task a worker has the codec alone, and it
    gives the same ids in the next."""
    from types import SimpleNamespace

    shared, own, got = SimpleNamespace(value=("a test's model", pieces.load_model(MODEL))), [], []
    for _ in range(2):
        with pieces._shared_codec(shared) as codec:
            got.append(codec.encode("uncopyrightables, zxqjvkw and hethlytionou again"))
            assert codec.known and codec.table.pairs
        assert not codec.known and not codec.known.older and not codec.table.pairs
        own.append(codec)
    pieces.kept_by_worker.clear()
    assert own[0] is own[1] and got[0] == got[1] != b""
