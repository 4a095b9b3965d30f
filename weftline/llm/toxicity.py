"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Words are runs without ASCII white space; of a word its letters count, lower-cased (digits and signs are left out, and a
word of these alone has no letters). A word enters by a learned vector (words of the training sample; others share a zero
vector) and by the average of learned vectors of its character trigrams. All overlapping windows of ``LENGTH`` words,
``STRIDE`` apart and one at the end, are scored; a text's score is that of its worst window. Only texts are labelled: the
first epochs take windows of each text at random, the later ones the windows that are worst by then (multiple-instance
learning). All weights start at random.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, in_worker, slices, text_bytes, with_arrays, without
from weftline.llm.repeats import powers

LENGTH, STRIDE, HIDDEN, WORD, CHAR, CHAR_BITS = 24, 12, 12, 8, 8, 12
#: Of a training text at most so many windows come to the driver, evenly spread over the whole text.
MOST_WINDOWS = 128
f32 = np.float32
_MIX = np.random.default_rng(21).integers(1, 2**62, (256,), np.int64).astype(np.uint64)
_BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))
_FOLD = np.zeros(256, np.uint8)  # letters, and bytes of letters beyond ASCII; 0 for what a word's spelling leaves out
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def spell(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words of texts: (words in each text; 64-bit keys of the distinct words; for each word its place among those; and
    for each distinct word its trigram buckets, flat, with lengths)."""
    n, texts = len(data), len(offsets) - 1
    empty = np.zeros(0, np.int64)
    if not n:
        return np.zeros(texts, np.int64), np.zeros(0, np.uint64), empty, [empty, empty]
    owner = np.repeat(np.arange(texts, dtype=np.int32), np.diff(offsets))
    blank = _BLANK[data]
    starts = ~blank
    starts[1:] &= blank[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(starts)
    if not len(first):
        return np.zeros(texts, np.int64), np.zeros(0, np.uint64), empty, [empty, empty]
    letters = _FOLD[data]
    place = np.cumsum(letters > 0, dtype=np.int32)
    base = place[first] - (letters[first] > 0)
    place -= np.repeat(np.r_[np.int32(0), base], np.diff(np.r_[0, first, n])) + 1
    values = _MIX[letters] * powers(max(1, int(place.max()) + 1))[0][np.maximum(place, 0)]
    values[letters == 0] = 0
    keys = np.add.reduceat(values, first)
    distinct, where, which = np.unique(keys, return_index=True, return_inverse=True)
    ends = np.r_[first[1:], n][where]
    sizes = (ends - first[where]).astype(np.int64)
    flat = np.repeat(first[where] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    spelled = letters[flat]
    of = np.repeat(np.arange(len(distinct)), sizes)[spelled > 0]
    spelled = spelled[spelled > 0].astype(np.uint32)
    length = np.bincount(of, minlength=len(distinct))
    # Each word between two marks (1), so that a word of n letters has n trigrams.
    lead = np.r_[0, np.cumsum(length)[:-1]]
    left, right = np.r_[np.uint32(1), spelled[:-1]], np.r_[spelled[1:], np.uint32(1)]
    some = length > 0
    left[lead[some]], right[(lead + length - 1)[some]] = 1, 1
    trigram = ((left * np.uint32(0x9E3779B1) + spelled * np.uint32(0x85EBCA77) + right * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - CHAR_BITS)
    return np.bincount(owner[first], minlength=texts), distinct, which, [trigram.astype(np.int64), length]


def windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each window of texts with so many words, words numbered over all texts."""
    per = np.where(count > 0, 1 + np.maximum(0, -(-(count - LENGTH) // STRIDE)), 0)
    text = np.repeat(np.arange(len(count)), per)
    k = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    start = np.minimum(k * STRIDE, np.maximum(0, count[text] - LENGTH))
    return text, start + (np.cumsum(count) - count)[text], np.minimum(count[text], LENGTH)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += f32(1)
    return np.reciprocal(x, out=x)


@dataclass
class Network:
    """Weights; ``keys`` are the sorted keys of known words, whose vectors follow the zero vector in ``word``."""

    keys: np.ndarray
    word: np.ndarray
    char: np.ndarray
    inputs: list = field(default_factory=list)  # by direction: (WORD + CHAR, 3 HIDDEN)
    offset: list = field(default_factory=list)  # by direction: 3 HIDDEN
    recur: list = field(default_factory=list)  # by direction: (HIDDEN, 3 HIDDEN)
    attend: np.ndarray | None = None  # (2 HIDDEN, HIDDEN)
    asked: np.ndarray | None = None  # HIDDEN
    out: np.ndarray | None = None  # 2 HIDDEN
    bias: np.ndarray | None = None  # 1
    scale: tuple[float, float] = (1.0, 0.0)

    def known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, at + 1, 0) if len(self.keys) else np.zeros(len(keys), np.int64)

    def embed(self, keys: np.ndarray, trigrams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of distinct words, and their rows in ``word``."""
        flat, length = trigrams
        row = self.known(keys)
        of = np.repeat(np.arange(len(keys)), length)
        char = np.stack([np.bincount(of, self.char[flat, j], len(keys)) for j in range(CHAR)], axis=1) / np.maximum(length, 1)[:, None]
        return np.concatenate([self.word[row], char.astype(f32)], axis=1), row

    def run(self, gates: list[np.ndarray], index: np.ndarray, mask: np.ndarray, tape: list | None = None) -> np.ndarray:
        """Logits of windows. ``gates``: by direction the input part of each distinct word's gates; ``index``: (steps,
        windows) places of words; ``mask``: whether a window has a word there."""
        steps, n = index.shape
        states = np.empty((steps, n, 2 * HIDDEN), f32)
        for d in (0, 1):
            h, half = np.zeros((n, HIDDEN), f32), slice(d * HIDDEN, (d + 1) * HIDDEN)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, hr = gates[d][index[t]], h @ self.recur[d]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + hr[:, : 2 * HIDDEN])
                z, r, hc = zr[:, :HIDDEN], zr[:, HIDDEN:], hr[:, 2 * HIDDEN :]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * hc)
                new = c + z * (h - c)
                if not mask[t].all():
                    new = np.where(mask[t][:, None], new, h)
                if tape is not None:
                    tape.append((d, t, h, z, r, c, hc))
                h = new
                states[t, :, half] = h
        u = np.tanh(states @ self.attend)
        e = np.where(mask, u @ self.asked, f32(-30))
        e = np.exp(e - e.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = (a[:, :, None] * states).sum(axis=0)
        if tape is not None:
            tape.append((states, u, a, pooled))
        return pooled @ self.out + self.bias[0]

    def gates(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors @ self.inputs[d] + self.offset[d] for d in (0, 1)]

    def window_logits(self, which: np.ndarray, gates: list[np.ndarray], start: np.ndarray, length: np.ndarray, block: int = 8192) -> np.ndarray:
        out = np.empty(len(start), f32)
        order = np.argsort(length, kind="stable") if len(length) and length.min() < LENGTH else np.arange(len(start))
        for s in range(0, len(start), block):
            i = order[s : s + block]
            steps = np.arange(int(length[i].max()))[:, None]
            mask = steps < length[i]
            out[i] = self.run(gates, which[np.minimum(start[i] + steps, len(which) - 1)], mask)
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A score between 0 and 1 for each text; texts without words get the least a window can get from the bias."""
        count, keys, which, trigrams = spell(data, offsets)
        worst = np.full(len(count), -30.0)
        if len(which):
            text, start, length = windows(count)
            logits = self.window_logits(which, self.gates(self.embed(keys, trigrams)[0]), start, length)
            np.maximum.at(worst, text, logits)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * worst + b, -60, 60)))


def _gradients(net: Network, vectors: np.ndarray, row: np.ndarray, trigrams: list[np.ndarray], index: np.ndarray, mask: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Back-propagation through time of the weighted logistic loss of windows."""
    gates, tape = net.gates(vectors), []
    logit = net.run(gates, index, mask, tape)
    states, u, a, pooled = tape.pop()
    g = (weight * (1 / (1 + np.exp(-logit)) - wanted)).astype(f32)
    grads = {"out": pooled.T @ g, "bias": g.sum(keepdims=True)}
    d_pooled = g[:, None] * net.out
    d_a = (states * d_pooled).sum(axis=2)
    d_e = a * (d_a - (a * d_a).sum(axis=0)) * mask
    d_u = d_e[:, :, None] * net.asked * (1 - u * u)
    grads["asked"] = np.tensordot(d_e, u, ((0, 1), (0, 1)))
    grads["attend"] = np.tensordot(states, d_u, ((0, 1), (0, 1)))
    d_states = a[:, :, None] * d_pooled + d_u @ net.attend.T
    d_gates = [np.zeros((len(vectors), 3 * HIDDEN)) for _ in (0, 1)]
    recur, carry = [np.zeros_like(w) for w in net.recur], [0, 0]
    for d, t, h, z, r, c, hc in reversed(tape):
        d_h = d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN] + carry[d]
        live = mask[t][:, None]
        on = d_h * live
        d_c = on * (1 - z) * (1 - c * c)
        d_z = on * (h - c) * z * (1 - z)
        d_r = d_c * hc * r * (1 - r)
        d_x = np.concatenate([d_z, d_r, d_c], axis=1)
        d_hr = np.concatenate([d_z, d_r, d_c * r], axis=1)
        recur[d] += h.T @ d_hr
        carry[d] = on * z + d_hr @ net.recur[d].T + d_h * ~live
        for j in range(3 * HIDDEN):
            d_gates[d][:, j] += np.bincount(index[t], d_x[:, j], len(vectors))
    d_vectors = sum(d_gates[d] @ net.inputs[d].T for d in (0, 1))
    for d in (0, 1):
        grads |= {f"recur{d}": recur[d], f"inputs{d}": vectors.T @ d_gates[d], f"offset{d}": d_gates[d].sum(axis=0)}
    word = np.stack([np.bincount(row, d_vectors[:, j], len(net.word)) for j in range(WORD)], axis=1)
    word[0] = 0
    flat, length = trigrams
    share = (d_vectors[:, WORD:] / np.maximum(length, 1)[:, None])[np.repeat(np.arange(len(vectors)), length)]
    return grads | {"word": word, "char": np.stack([np.bincount(flat, share[:, j], 1 << CHAR_BITS) for j in range(CHAR)], axis=1)}


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, at_random: int = 4, batch: int = 256, rate: float = 0.01, seed: int = 9) -> Network:
    """Fit on texts and 0/1 labels. Without both labels every score is the share of label 1."""
    rng = np.random.default_rng(seed)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    count, keys, which, trigrams = spell(np.frombuffer(b"".join(texts), np.uint8), offsets)
    labels = np.asarray(labels, np.int64)
    text_of = np.repeat(np.arange(len(texts)), count)
    pairs = np.unique(text_of * max(1, len(keys)) + which)
    kept = np.flatnonzero(np.bincount(pairs % max(1, len(keys)), minlength=len(keys)) >= 2)  # words of two texts or more
    n = rng.normal
    word = n(0, 0.1, (len(kept) + 1, WORD)).astype(f32)
    word[0] = 0
    net = Network(keys[kept], word, n(0, 0.1, (1 << CHAR_BITS, CHAR)).astype(f32))
    for _ in (0, 1):
        net.inputs.append(n(0, 0.3, (WORD + CHAR, 3 * HIDDEN)).astype(f32))
        net.offset.append(np.zeros(3 * HIDDEN, f32))
        net.recur.append(n(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(f32))
    net.attend, net.asked, net.out, net.bias = n(0, 0.4, (2 * HIDDEN, HIDDEN)).astype(f32), n(0, 0.4, HIDDEN).astype(f32), n(0, 0.4, 2 * HIDDEN).astype(f32), np.array([-1.0], f32)
    share = labels.mean() if len(labels) else 0.5
    if not len(which) or share in (0, 1):
        net.scale = (0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
        return net
    parameters = {"out": net.out, "bias": net.bias, "asked": net.asked, "attend": net.attend, "word": net.word, "char": net.char}
    parameters |= {f"{name}{d}": getattr(net, name)[d] for name in ("inputs", "offset", "recur") for d in (0, 1)}
    moments = {k: (np.zeros(p.shape, f32), np.zeros(p.shape, f32)) for k, p in parameters.items()}
    text, start, length = windows(count)
    step = 0
    for epoch in range(epochs):
        logits = rng.random(len(start)) if epoch < at_random else net.window_logits(which, net.gates(net.embed(keys, trigrams)[0]), start, length)
        order = np.lexsort((-logits, text))
        place = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        picked = order[place < (2 if epoch < at_random else 1)]
        others = np.flatnonzero(labels[text] == 0)
        chosen = rng.permutation(np.r_[picked, rng.choice(others, min(len(others), len(picked)), replace=False)])
        weight = np.where(labels[text] == 1, min(3.0, 0.5 / share), 1.0)
        for s in range(0, len(chosen), batch):
            i = chosen[s : s + batch]
            steps = np.arange(LENGTH)[:, None]
            places, index = np.unique(which[np.minimum(start[i] + steps, len(which) - 1)], return_inverse=True)
            sizes = trigrams[1][places]
            at = np.repeat((np.cumsum(trigrams[1]) - trigrams[1])[places] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            part = [trigrams[0][at], sizes]
            vectors, row = net.embed(keys[places], part)
            grads = _gradients(net, vectors, row, part, index.reshape(LENGTH, -1), steps < length[i], labels[text[i]], weight[i] / len(i))
            step += 1
            for k, p in parameters.items():
                m, v = moments[k]
                m += f32(0.1) * (grads[k].astype(f32) - m)
                v += f32(0.01) * (grads[k].astype(f32) ** 2 - v)
                p -= f32(rate * (1 - 0.9 * epoch / epochs)) * (m / f32(1 - 0.9**step)) / (np.sqrt(v / f32(1 - 0.99**step)) + f32(1e-6))
    # Slope and intercept of the texts' worst windows.
    logits = net.window_logits(which, net.gates(net.embed(keys, trigrams)[0]), start, length)
    worst = np.full(len(count), -30.0)
    np.maximum.at(worst, text, logits)
    a, b, x, y = 1.0, 0.0, np.clip(worst, -12, 12), np.clip(labels, 0.01, 0.99)
    for _ in range(400):
        p = 1 / (1 + np.exp(-(a * x + b)))
        a -= 0.05 * (((p - y) * x).mean() + 0.01 * (a - 1))
        b -= 0.3 * (p - y).mean()
    net.scale = (float(max(a, 0.05)), float(b))
    return net


def windows_of(sample: DataFrame) -> DataFrame:
    """The sample (text, label) with each text cut to ``MOST_WINDOWS`` windows, evenly spread over the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 600_000):
                out = []
                for t in batch.column("text").cast(pa.large_binary()).to_pylist():
                    words = (t or b"").split()
                    if len(words) > MOST_WINDOWS * LENGTH:
                        starts = np.linspace(0, len(words) - LENGTH, MOST_WINDOWS).astype(np.int64)
                        words = [w for s in starts.tolist() for w in words[s : s + LENGTH]]
                    out.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("label").cast(pa.int32())], names=["words", "label"])

    bound_batches(sample)
    return sample.select("text", "label").mapInArrow(in_worker("toxicity", run), "words binary, label int")


def fit(sample: DataFrame, **how) -> Network:
    """Fit on a sample (text, label) whose rows the caller bounds; of each at most ``MOST_WINDOWS`` windows come to the driver."""
    rows = sorted(((r[1], bytes(r[0])) for r in windows_of(sample).collect()), key=lambda r: r)  # whatever order tasks end in
    return train([t for _, t in rows], np.array([y for y, _ in rows], np.int64), **how)


def score(df: DataFrame, net: Network, text: str = "text", out: str = "score", step_bytes: int = 1_000_000) -> DataFrame:
    """Add ``out`` (double, 0 to 1): the worst of all windows of the whole text; null and empty texts get the least.

    A clashing column is replaced, others pass through; no shuffle, nothing is read but the text.
    """
    base = without(df, [out])
    bound_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(net)  # bounded by the words of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, step_bytes):
                yield with_arrays(batch, **{out: pa.array(shared.value.score(*text_bytes(batch.column(text))).astype(np.float64))})

    return base.mapInArrow(in_worker("toxicity", run), T.StructType([*base.schema.fields, T.StructField(out, T.DoubleType())]))
