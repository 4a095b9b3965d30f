"""SentencePiece encoding and decoding (merge type) by backtracking.

Spaces become U+2581 and one stands before the text. No piece has U+2581 after another character, so text can be cut
before each run of U+2581, and between letters and signs that no piece has beside a letter, without changing the result;
a worker remembers what short stretches gave. Within a stretch ``MergeTable.backtrack`` is exact.
"""

from __future__ import annotations

import contextlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, in_worker, kept_by_worker, slices, texts, with_arrays, without
from weftline.llm.merges import MergeTable, Remembered

MARK = "▁"
#: Kinds of pieces in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of stretches and their ids in each of two generations; a task begins without any.
HELD_BYTES = 48 << 20


def load_model(path: str) -> tuple:
    """Pieces of a model file as (piece, score, kind), small enough to go with each task. Other model kinds are refused."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not proto.trainer_spec.byte_fallback:
        raise ValueError("needs a merge-type model with byte fallback, identity normalization and a dummy prefix")
    return tuple((p.piece, p.score, p.type) for p in proto.pieces)


class Codec:
    def __init__(self, model: tuple):
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(model) if kind in (NORMAL, USER_DEFINED)}
        scores = {piece: -score for piece, score, kind in model if kind in (NORMAL, USER_DEFINED)}
        self.table = MergeTable(self.ids, lambda a, b: scores.get(a + b))
        self.byte_ids = {int(piece[1:-1], 16): i for i, (piece, _, kind) in enumerate(model) if kind == BYTE}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece has a space after another character")
        # ASCII signs that no piece has beside a letter: between those and letters text can be cut as well.
        numerals = re.escape("".join({c for p in self.ids for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
        letters = rf"[^\W\d_{numerals}]"
        letter = re.compile(letters)
        beside = {c for p in self.ids for pair in zip(p, p[1:], strict=False) if any(map(letter.match, pair)) for c in pair}
        signs = re.escape("".join(c for c in map(chr, range(128)) if not letter.match(c) and c not in beside)) or r"\b"
        self.cut = re.compile(rf"{MARK}*{letters}+(?=[{signs}{MARK}]|\Z)|{MARK}*[{signs}]+(?={letters}|{MARK}|\Z)|{MARK}*[^{MARK}]+|{MARK}+").findall
        self.out = [b"" if kind in (CONTROL, UNUSED) else bytes([int(piece[1:-1], 16)]) if kind == BYTE else b" \xe2\x81\x87 " if kind == UNKNOWN else piece.replace(MARK, " ").encode() for piece, _, kind in model]
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.known = Remembered(self.stretch, most_bytes=HELD_BYTES)

    def stretch(self, text: str) -> bytes:
        """Ids (int32, as bytes) of a stretch; U+2581 stands for spaces."""
        ids, known = array("i"), self.ids
        for token in self.table.backtrack(text):
            if token in known:
                ids.append(known[token])
            else:
                ids.extend([self.byte_ids[b] for b in token.encode("utf-8", "surrogatepass")])
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """All ids of a text as int32 bytes; empty for an empty text."""
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.cut(MARK + text.replace(" ", MARK))))

    def forget(self) -> None:
        """Drop what was remembered of texts; what comes of the model stays."""
        self.known.forget()
        self.table.forget()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: one leading space goes, bytes join to characters, malformed ones become U+FFFD."""
        out = self.out
        flat = b"".join([out[i] for i in ids.tolist()])
        try:
            text = flat.decode("utf-8")
        except UnicodeDecodeError:
            text = flat.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") and len(ids) and int(ids[0]) not in self.byte_of else text


@contextlib.contextmanager
def _shared_codec(broadcast) -> Iterator[Codec]:
    """One codec for a worker and model, kept over tasks. What it remembers of texts goes when a task ends: Spark deals tasks
    to all its idle workers in turn, and those of the stages before are more than run at a time."""
    key = broadcast.value[0]
    if kept_by_worker.get("codec of") != key:
        kept_by_worker["codec of"], kept_by_worker["codec"] = key, Codec(broadcast.value[1])
    try:
        yield kept_by_worker["codec"]
    finally:
        kept_by_worker["codec"].forget()


def _ship(df: DataFrame, model: tuple):
    bound_batches(df)
    return df.sparkSession.sparkContext.broadcast((hash(model), model))  # the vocabulary file bounds its size


def _ids_of(found: list[bytes]) -> pa.ListArray:
    """What ``Codec.encode`` gave for each row, as a column."""
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(g) // 4 for g in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))


def encode(df: DataFrame, model: tuple, text: str = "text", ids: str = "ids", step_bytes: int = 1_000_000) -> DataFrame:
    """Add ``ids`` (array<int>): all ids of the whole text, without begin or end ids. Null and empty texts give [].

    A column of the same name is replaced; other columns pass through. No shuffle, no limit on a text's length.
    """
    base = without(df, [ids])
    shared = _ship(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _shared_codec(shared) as c:
            for whole in batches:
                for batch in slices(whole, text, step_bytes):
                    yield with_arrays(batch, **{ids: _ids_of([c.encode(t) for t in texts(batch.column(text))])})

    return base.mapInArrow(in_worker("pieces", run), T.StructType([*base.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model: tuple, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text that the ids stand for; null or empty ids give ''."""
    base = without(df, [decoded])
    shared = _ship(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _shared_codec(shared) as c:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    column = batch.column(ids)
                    flat, out = column.flatten().to_numpy(zero_copy_only=False), []
                    ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))
                    start = 0
                    for end in ends.tolist():
                        out.append(c.decode(flat[start:end]))
                        start = end
                    yield with_arrays(batch, **{decoded: pa.array(out, pa.string())})

    return base.mapInArrow(in_worker("pieces", run), T.StructType([*base.schema.fields, T.StructField(decoded, T.StringType())]))


def encode_and_decode(df: DataFrame, model: tuple, text: str = "text", ids: str = "ids", decoded: str = "decoded", step_bytes: int = 1_000_000) -> DataFrame:
    """The columns of ``encode`` and of ``decode`` in one pass: a task has one Python worker with one codec, where the two
    one after the other have two workers, each of which comes to hold a codec and all it remembers."""
    base = without(df, [ids, decoded])
    shared = _ship(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _shared_codec(shared) as c:
            for whole in batches:
                for batch in slices(whole, text, step_bytes):
                    found = [c.encode(t) for t in texts(batch.column(text))]
                    back = pa.array([c.decode(np.frombuffer(g, np.int32)) for g in found], pa.string())
                    yield with_arrays(batch, **{ids: _ids_of(found), decoded: back})

    return base.mapInArrow(in_worker("pieces", run), T.StructType([*base.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]))


def digests(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of frames that have been encoded and decoded."""
    return encoded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
