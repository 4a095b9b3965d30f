"""Quality classifier: supervised subword embeddings.

Hashed words, pairs of neighbouring words and character n-grams (over bytes, word bounds included) have learned vectors; a
document is the average of its vectors, a softmax layer scores it. A pair is hashed by the difference of its words' hashes,
so all pairs of equal words have one vector. Trained by stochastic gradient descent in numpy, a
document at a time with a falling rate, on a bounded sample; a step changes the vectors of that document's buckets only.
The output layer is linear in the average, so for scoring each vector is reduced to what it adds to the difference of
the two logits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, in_worker, slices, text_bytes, with_arrays, without
from weftline.llm.repeats import powers

ORDERS = (1, 2, 3, 4)
_MIX = np.random.default_rng(11).integers(1, 2**62, (256,), np.int64).astype(np.uint64)
_BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs of words and each n-gram order: (text of each feature, its bucket). All share one table."""
    n = len(data)
    if not n:
        return
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    blank = _BLANK[data]
    starts = ~blank
    starts[1:] &= blank[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(starts)
    shift = np.uint64(64 - bits)
    mixed = _MIX[data]
    if len(first):
        place = np.arange(n) - np.repeat(np.r_[0, first], np.diff(np.r_[0, first, n]))
        word = np.add.reduceat(np.where(blank, np.uint64(0), mixed * powers(int(place.max()) + 1)[0][place]), first)
        of = owner[first]
        yield of, ((word * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32)
        together = np.flatnonzero(of[1:] == of[:-1])
        pair = (word[together] - word[together + 1]) * np.uint64(0xE7037ED1A0B428DB)
        yield of[together], (pair >> shift).astype(np.int32)
    rolled = mixed.copy()
    for order in range(1, max(ORDERS) + 1):
        if n < order:
            return
        if order > 1:
            rolled = rolled[:-1] * np.uint64(0x100000001B3) + mixed[order - 1 :]
        if order in ORDERS:
            inside = owner[: n - order + 1] == owner[order - 1 :]
            hashed = ((rolled + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)) >> shift
            yield owner[: n - order + 1][inside], hashed[inside].astype(np.int32)


@dataclass(frozen=True)
class Model:
    """What each bucket adds, the intercept, the bucket bits and the kinds' number."""

    weight: np.ndarray
    intercept: float
    bits: int

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for owner, bucket in features(data, offsets, self.bits):
            total += np.bincount(owner, self.weight[bucket], len(total))
            count += np.bincount(owner, minlength=len(total))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.intercept, -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, width: int = 16, epochs: int = 10, rate: float = 60.0, seed: int = 3) -> Model:
    """``rows``: (buckets, shares that add up to 1, label). Softmax cross-entropy by stochastic gradient descent: one document
    a step, the rate falling to nothing in a line. Shares are small, so the vectors' rate is large; the output layer's is
    a thousandth of it. Buckets that no document has stay at the origin and say nothing."""
    rng = np.random.default_rng(seed)
    vectors, out = np.zeros((1 << bits, width), np.float32), rng.normal(0, 1 / np.sqrt(width), (width, 2)).astype(np.float32)
    prior = np.log(np.maximum(np.bincount([r[2] for r in rows], minlength=2), 0.5))
    bias, steps, done = (prior - prior.mean()).astype(np.float32), max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            bucket, share, label = rows[i]
            now = np.float32(rate * (1 - done / steps))
            done += 1
            mean = share @ vectors[bucket]
            z = mean @ out + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[label] -= 1
            back = out @ g
            out -= np.float32(1e-3) * now * np.outer(mean, g)
            bias -= np.float32(1e-3) * now * g
            vectors[bucket] -= now * np.outer(share, back)
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]), bits)


def bags(df: DataFrame, bits: int, text: str = "text", label: str = "label") -> DataFrame:
    """(buckets, shares as bytes; label): at most 2^bits numbers for a text of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, 600_000):
                data, offsets = text_bytes(batch.column(text))
                kinds = list(features(data, offsets, bits))
                buckets, shares = [], []
                for i in range(batch.num_rows):
                    own = np.concatenate([b[np.searchsorted(o, i) : np.searchsorted(o, i, "right")] for o, b in kinds] or [np.zeros(0, np.int32)])
                    at, n = np.unique(own, return_counts=True)
                    buckets.append(at.astype(np.int32).tobytes())
                    shares.append((n / max(1, n.sum())).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.binary()), pa.array(shares, pa.binary()), batch.column(label).cast(pa.int32())], names=["buckets", "shares", "label"])

    return df.select(text, label).mapInArrow(in_worker("quality", run), "buckets binary, shares binary, label int")


def fit(sample: DataFrame, bits: int = 18, **how) -> Model:
    """Fit on a sample whose size the caller bounds (its bags come to the driver). No rows: every score is a half."""
    rows = [(np.frombuffer(r[0], np.int32), np.frombuffer(r[1], np.float32), r[2]) for r in bags(sample, bits).collect()]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))  # whatever order tasks end in
    return train(rows, bits, **how)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score", step_bytes: int = 600_000) -> DataFrame:
    """Add ``out`` (double, 0 to 1) for each whole text; null and empty texts get what the intercept gives.

    A clashing column is replaced, others pass through; no shuffle, nothing is read but the text.
    """
    base = without(df, [out])
    bound_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2^bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, step_bytes):
                yield with_arrays(batch, **{out: pa.array(shared.value.score(*text_bytes(batch.column(text))))})

    return base.mapInArrow(in_worker("quality", run), T.StructType([*base.schema.fields, T.StructField(out, T.DoubleType())]))


def decided(scored: DataFrame, at_least: float = 0.3, out: str = "predicted") -> DataFrame:
    return scored.withColumn(out, (F.col("score") >= at_least).cast("int"))
