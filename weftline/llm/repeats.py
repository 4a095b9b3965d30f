"""Repeated substrings over a whole corpus, by indexes that each see only what can match.

A window is ``width`` consecutive units (bytes or words) of one text. Of the anchors (runs of ``anchor`` units) in a
window the one with the least hash is chosen, the leftmost of equals, so equal windows choose equal anchors. Windows of
a text that choose the same place make one stretch. Stretches go to the shard of their anchor, which thus holds
every window that can equal theirs:

1. stretches are counted by content before they are sent, so copies of any number are one row with a count;
2. of each content whose anchor occurs at least twice, one example is cut out of its text and put into the shard's
   index as often as it occurs (twice at most: a third copy changes nothing); the index, in which each of its texts is
   streamed, tells which windows occur elsewhere, by the units themselves;
3. what was marked goes back to all stretches of that content, and from there to the texts, a chunk of texts at a time.

An anchor that very many different contents share (a common line) would make one large shard. Such anchors are found
beforehand in a sample of the texts; windows that choose one of them are stretches of their own whose anchor is the whole
window, so that they are spread over all shards. Hashes of units and anchors only decide where something is sent;
contents are told apart by 96 bits of their bytes' hash, rows by 96 bits of id and text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, in_worker, kept_by_worker, row_keys, slices, text_bytes, with_arrays, without
from weftline.llm.suffixes import RunLengthIndex, WaveletIndex, string_ends

_MIX = np.random.default_rng(31).integers(1, 2**63 - 1, (256,), np.int64).astype(np.uint64)
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLANK = np.isin(np.arange(256), (32, 9, 10, 11, 12, 13))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """1, B, B^2, ... and their inverses, modulo 2^64."""
    if len(kept_by_worker.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            kept_by_worker[name] = np.multiply.accumulate(p)
    return kept_by_worker["up"][:n], kept_by_worker["down"][:n]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, text) of the words of texts laid end to end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_BLANK[data]
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, "right") - 1


@dataclass
class Units:
    """Units of some texts: a value each (for anchors only; different units may share it), where each text's units begin,
    and where each unit's bytes are in ``data``, in which there is one byte at most between a text's units."""

    value: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    first: np.ndarray
    after: np.ndarray


def bytes_as_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    place = np.arange(len(data))
    return Units(_MIX[data], offsets, data, place, place + 1)


def words_as_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    first, after, text = word_bounds(data, offsets)
    counts = np.bincount(text, minlength=len(offsets) - 1) if len(first) else np.zeros(len(offsets) - 1, np.int64)
    bounds = np.r_[0, np.cumsum(counts)]
    if not len(first):
        return Units(np.zeros(0, np.uint64), bounds, data, first, after)
    up, down = powers(len(data) + 1)
    total = np.r_[np.uint64(0), np.cumsum(_MIX[data] * up[:-1])]
    value = scramble((total[after] - total[first]) * down[first] + (after - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    # Words one space apart, whatever stood between them.
    size = after - first + 1
    begin = np.cumsum(size) - size
    single = data[np.minimum(np.repeat(first - begin, size) + np.arange(size.sum()), len(data) - 1)]
    single[begin + size - 1] = 32
    return Units(value, bounds, single, begin, begin + size - 1)


UNITS: dict[str, Callable[[np.ndarray, np.ndarray], Units]] = {"byte": bytes_as_units, "word": words_as_units}

#: A stretch's content, as it is told apart: 96 bits of a 128-bit hash of its bytes.
CONTENT = np.dtype([("c1", "<i8"), ("c2", "<i4"), ("rest", "<i4")])


def contents(units: Units, begin: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``CONTENT`` of units begin..after-1."""
    view = memoryview(np.ascontiguousarray(units.data))
    parts = [view[x:y] for x, y in zip(units.first[begin].tolist(), units.after[after - 1].tolist(), strict=True)]
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), CONTENT)


def stretches(units: Units, width: int, anchor: int, crowded: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first unit within it, windows, anchor hash, content) of each stretch; ``crowded``: sorted hashes of anchors
    whose windows are stretches of their own."""
    value, offsets = units.value, units.offsets
    n = len(value)
    nothing = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, CONTENT))
    if n < width:
        return nothing
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * up[:n], out=total[1:])
    anchors = scramble((total[anchor:] - total[: n - anchor + 1]) * down[: n - anchor + 1])
    places = max(1, n.bit_length())
    least = anchors >> np.uint64(places) << np.uint64(places) | np.arange(len(anchors), dtype=np.uint64)
    span, reach = width - anchor + 1, 1  # the least of each run of ``span`` anchors
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    size = np.diff(offsets)
    per = np.maximum(0, size - width + 1)
    text = np.repeat(np.arange(len(size)), per)
    if not len(text):
        return nothing
    start = offsets[text] + np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    place = (least[start] & np.uint64((1 << places) - 1)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    single = np.zeros(len(start), bool)
    if len(crowded):
        single = crowded[np.minimum(np.searchsorted(crowded, anchors[place]), len(crowded) - 1)] == anchors[place]
        new |= single
    head = np.flatnonzero(new)
    windows = np.diff(np.r_[head, len(start)])
    first, place = start[head], place[head]
    content = contents(units, first, first + windows - 1 + width)
    chosen = np.where(single[head], content["c1"].view(np.uint64), anchors[place])
    return text[head], first - offsets[text[head]], windows, chosen, content


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs(flags: np.ndarray) -> np.ndarray:
    """Bounds (first, after) of the runs of True, flat."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edges.astype(np.int32)


def marked_by_index(kind: str, unit: str, width: int, payloads: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    """For each content the windows that occur elsewhere, as runs. ``counts``: how often each content occurs as a whole."""
    if unit == "byte":
        symbols = np.frombuffer(b"\x00".join(payloads) + b"\x00", np.uint8).astype(np.int64) + 1
        symbols[np.cumsum([len(p) + 1 for p in payloads]) - 1] = 0
    else:  # a number for each different word of the shard, by its bytes
        number: dict[bytes, int] = {}
        listed: list[int] = []
        for p in payloads:
            listed += [number.setdefault(w, len(number) + 1) for w in p.split(b" ")]
            listed.append(0)
        symbols = np.array(listed, np.int64)
    start, end = string_ends(symbols)
    twice = (counts > 1).astype(np.int64)
    if kind == "runs":
        repeated = RunLengthIndex(symbols, twice).statistics() >= width
    else:
        edges = np.zeros(len(symbols) + 1, np.int32)
        first, after, _ = WaveletIndex(symbols, twice).matches(symbols, start, end, width)
        np.add.at(edges, first, 1)
        np.add.at(edges, after - width + 1, -1)
        repeated = np.cumsum(edges[:-1]) > 0
    return [_runs(repeated[s:e]) for s, e in zip(start.tolist(), (end - width + 1).tolist(), strict=True)]


#: Which share of the rows is looked at for crowded anchors, and how many of these are sent to all tasks at most (8 bytes
#: each; were there more, the most crowded ones: any other then has less than a millionth of all contents).
LOOKED_AT, MOST_CROWDED = 16, 1_000_000

_MORE = np.dtype([("k1", "<i8"), ("k2", "<i4"), ("first", "<i4")])


def _grouped(content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by content, where in it each different content begins)."""
    order = np.lexsort((content["c2"], content["c1"]))
    got = content[order]
    new = np.ones(len(order), bool)
    new[1:] = (got["c1"][1:] != got["c1"][:-1]) | (got["c2"][1:] != got["c2"][:-1])
    return order, np.flatnonzero(new)


def mark(df: DataFrame, kind: str, unit: str, width: int, anchor: int, text: str = "text", id_col: str = "doc_id", out: str = "spans", shard_units: int = 300_000, crowded: int = 4000, step_bytes: int = 600_000) -> DataFrame:
    """Add ``out`` (array<int>): first and after-last unit of each maximal run of units that a repeated window covers, flat.

    ``kind``: "runs" (run-length index) or "wavelet" (FM-index). Null texts count as empty. Rows equal in id and text
    repeat each other like any two texts do. Columns pass through; a clashing ``out`` is replaced; an empty table gives no
    rows. ``crowded``: about how many different contents an anchor may have before its windows are sent one by one.
    """
    as_units = UNITS[unit]
    bound_batches(df)
    k1, k2 = row_keys(F.col(id_col), F.col(text))
    base = without(df, [out, "__k1", "__k2"]).withColumns({"__k1": k1, "__k2": k2})
    keyed = base.select("__k1", "__k2", F.col(text).alias("text"))
    context = df.sparkSession.sparkContext

    def cut(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for whole in batches:
            for batch in slices(whole, "text", step_bytes):
                keys = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("__k1", "__k2")]
                of, first, windows, a, c = stretches(as_units(*text_bytes(batch.column("text"))), width, anchor, known)
                yield a, c, keys[0][of], keys[1][of], first.astype(np.int32), windows.astype(np.int32)

    def gathered(batches: Iterator[pa.RecordBatch], known: np.ndarray, most: int = 250_000) -> Iterator[tuple[np.ndarray, ...]]:
        parts, rows = [], 0
        for part in cut(batches, known):
            parts.append(part)
            rows += len(part[0])
            if rows > most:
                yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                parts, rows = [], 0
        if rows:
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    # 0. Anchors with very many different contents, from a sample of the texts.
    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, c, *_ in gathered(batches, np.zeros(0, np.uint64)):
            order, head = _grouped(c)
            one = order[head]
            yield pa.RecordBatch.from_arrays([_signed(a[one]), pa.array(c["c1"][one])], names=["a", "c1"])

    sample = keyed.where(F.pmod("__k1", F.lit(LOOKED_AT)) == 0)
    kinds = sample.mapInArrow(in_worker("repeats", looked_at), "a long, c1 long").distinct().groupBy("a").count()
    full = kinds.where(F.col("count") > crowded / LOOKED_AT).orderBy(F.desc("count")).limit(MOST_CROWDED).select("a")
    shared = context.broadcast(np.sort(full.toArrow()["a"].to_numpy().astype(np.int64).view(np.uint64)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, c, k1, _, first, windows in gathered(batches, shared.value):
            order, head = _grouped(c)
            one = order[head]
            columns = [_signed(a[one]), pa.array(c["c1"][one]), pa.array(c["c2"][one]), pa.array(np.diff(np.r_[head, len(order)]).astype(np.int64)), *[pa.array(x[one]) for x in (k1, first, windows)]]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "c1", "c2", "n", "k1", "first", "windows"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each content of a chunk of whole texts: its first place, and the others packed in ``more``."""
        task = TaskContext.get()
        for number, (_, c, k1, k2, first, _) in enumerate(gathered(batches, shared.value)):
            chunk = xxhash.xxh3_64_intdigest(f"{task.partitionId() if task else 0} {number}") - (1 << 63)
            order, head = _grouped(c)
            one, last = order[head], np.r_[head[1:], len(order)]
            all_places = np.empty(len(order), _MORE)
            all_places["k1"], all_places["k2"], all_places["first"] = k1[order], k2[order], first[order]
            more = [None if y == x + 1 else all_places[x + 1 : y].tobytes() for x, y in zip(head.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c["c1"][one]), pa.array(c["c2"][one]), pa.array(np.full(len(one), chunk)), *[pa.array(x[one]) for x in (k1, k2, first)], pa.array(more, pa.binary())], names=["c1", "c2", "chunk", "k1", "k2", "first", "more"])

    # 1. Contents and how often they occur; those whose anchor occurs once only match nothing.
    sent = keyed.mapInArrow(in_worker("repeats", counted), "a long, c1 long, c2 int, n long, k1 long, first int, windows int").repartition("a")
    # The text that lends the example is the one of least key, in whatever order rows come: a task that is run again after
    # lost map output names the same. Equal contents have equally many windows; of their places in that text any will do.
    example = [F.min("k1").alias("k1"), F.min_by("first", "k1").alias("first"), F.min("windows").alias("windows")]
    counts = sent.groupBy("a", "c1", "c2").agg(F.sum("n").alias("n"), *example)
    met = counts.withColumn("all", F.sum("n").over(Window.partitionBy("a"))).where(F.col("all") > 1)
    # 2. One example of each: any text with that key in which the content stands at that place.
    wanted = met.groupBy("k1").agg(F.collect_list(F.struct("a", "c1", "c2", "n", "first", "windows")).alias("wanted"))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for whole in batches:
            for batch in slices(whole, text, step_bytes):
                keys = list(zip(batch.column("__k1").to_pylist(), batch.column("__k2").to_pylist(), strict=True))
                fresh = [i for i, k in enumerate(keys) if k not in done and not done.add(k)]  # repeated rows have one example
                batch = batch.take(pa.array(fresh, pa.int64()))
                units = as_units(*text_bytes(batch.column(text)))
                lists = batch.column("wanted")
                flat = lists.flatten()
                of = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
                first, windows = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("first", "windows"))
                begin = units.offsets[of] + first
                there = np.flatnonzero(begin + windows + width - 1 <= units.offsets[of + 1])
                begin, after = begin[there], (begin + windows + width - 1)[there]
                own, c1, c2 = contents(units, begin, after), flat.field("c1").to_numpy()[there], flat.field("c2").to_numpy()[there]
                right = (own["c1"] == c1) & (own["c2"] == c2)  # not so only where rows share a key by chance
                begin, after, there = begin[right], after[right], there[right]
                payload = [units.data[x:y].tobytes() for x, y in zip(units.first[begin].tolist(), units.after[after - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[flat.field(x).take(pa.array(there)) for x in ("a", "c1", "c2", "n")], pa.array(payload, pa.binary())], names=["a", "c1", "c2", "n", "payload"])

    cut_out = base.join(wanted, F.col("__k1") == F.col("k1")).drop("k1").mapInArrow(in_worker("repeats", examples), "a long, c1 long, c2 int, n long, payload binary")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole anchors, until there are about ``shard_units``; a content met twice (from repeated rows) counts once."""

        def emit(rows: list) -> pa.RecordBatch:
            got = marked_by_index(kind, unit, width, [r[3] for r in rows], np.array([r[2] for r in rows]))
            some = [i for i, g in enumerate(got) if len(g)]
            columns = [pa.array([rows[i][0] for i in some], pa.int64()), pa.array([rows[i][1] for i in some], pa.int32())]
            bounds = list(accumulate((len(got[i]) for i in some), initial=0))
            runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([got[i] for i in some]) if some else np.zeros(0, np.int32)))
            return pa.RecordBatch.from_arrays([*columns, runs], names=["c1", "c2", "runs"])

        rows, volume, last, seen = [], 0, None, set()
        for batch in batches:
            for a, c1, c2, n, payload in zip(*[batch.column(x).to_pylist() for x in ("a", "c1", "c2", "n", "payload")], strict=True):
                if a != last:
                    if volume > shard_units * (1 if unit == "byte" else 6):
                        yield emit(rows)
                        rows, volume = [], 0
                    last, seen = a, set()
                if (c1, c2) not in seen:
                    seen.add((c1, c2))
                    rows.append((c1, c2, n, payload))
                    volume += len(payload)
        if rows:
            yield emit(rows)

    marks = cut_out.repartition("a").sortWithinPartitions("a").mapInArrow(in_worker("repeats", indexed), "c1 long, c2 int, runs array<int>")
    # 3. Back to all stretches of such contents, and to their texts.
    places = keyed.mapInArrow(in_worker("repeats", placed), "c1 long, c2 int, chunk long, k1 long, k2 int, first int, more binary")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What of a chunk's places was marked, as one row of spans for each text."""

        def emit(rows: pa.Table) -> pa.RecordBatch:
            more, runs = rows["more"].combine_chunks(), rows["runs"].combine_chunks()
            others = np.frombuffer(b"".join(m for m in more.to_pylist() if m), _MORE)
            of = np.r_[np.arange(len(more)), np.repeat(np.arange(len(more)), pa.compute.fill_null(pa.compute.binary_length(more), 0).to_numpy() // _MORE.itemsize)]
            k1, k2, first = (np.r_[rows[n].to_numpy(), others[n]] for n in ("k1", "k2", "first"))
            # Each place has the runs of its content, counted from its first unit.
            size = pa.compute.list_value_length(runs).to_numpy() // 2
            start, flat = np.cumsum(size) - size, runs.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
            place = np.repeat(np.arange(len(of)), size[of])
            pick = np.arange(len(place)) + np.repeat(start[of] - (np.cumsum(size[of]) - size[of]), size[of])
            lo, hi = first[place] + flat[pick, 0], first[place] + flat[pick, 1] + width - 1
            order = np.lexsort((lo, k2[place], k1[place]))
            k1, k2, lo, hi = k1[place][order], k2[place][order], lo[order].astype(np.int64), hi[order].astype(np.int64)
            new_text = np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
            text_of = np.cumsum(new_text) - 1
            far = np.int64(1 << 32)  # texts one behind the other, so that one running maximum serves all
            reach = np.maximum.accumulate(hi + text_of * far)
            new = new_text | np.r_[True, lo[1:] + text_of[1:] * far > reach[:-1]]
            head = np.flatnonzero(new)
            ends = reach[np.r_[head[1:], len(lo)] - 1] - text_of[head] * far
            spans = np.stack([lo[head], ends], axis=1).astype(np.int32)
            bounds = np.r_[0, np.cumsum(2 * np.bincount(text_of[head]))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(spans.ravel()))
            return pa.RecordBatch.from_arrays([pa.array(k1[new_text]), pa.array(k2[new_text]), lists], names=["k1", "k2", "spans"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cuts = np.flatnonzero(chunk[1:] != chunk[:-1]) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(chunk)].tolist(), strict=True):
                if b > a:
                    if held and held[-1].column("chunk")[0].as_py() != int(chunk[a]):
                        yield emit(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield emit(pa.Table.from_batches(held))

    met_again = places.join(marks, ["c1", "c2"]).select("chunk", "k1", "k2", "first", "more", "runs").repartition("chunk").sortWithinPartitions("chunk")
    by_text = met_again.mapInArrow(in_worker("repeats", merged), "k1 long, k2 int, spans array<int>")
    covered = by_text.groupBy("k1").agg(F.collect_set(F.struct("k2", "spans")).alias("covered"))  # a set: repeated rows have the same spans

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = []
            for row, k2 in zip(batch.column("covered").to_pylist(), batch.column("__k2").to_pylist(), strict=True):
                column.append(next((x["spans"] for x in row or () if x["k2"] == k2), []))
            yield with_arrays(batch.drop_columns(["covered"]), **{out: pa.array(column, pa.list_(pa.int32()))})

    joined = base.join(covered, F.col("__k1") == F.col("k1"), "left").drop("k1")
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return joined.mapInArrow(in_worker("repeats", spans), schema).drop("__k1", "__k2")


def remove(marked: DataFrame, unit: str, text: str = "text", spans: str = "spans", kept: str = "kept", units: str = "n_units") -> DataFrame:
    """Add ``kept`` (binary: remaining bytes, or remaining words joined by one space) and ``n_units`` of the whole text."""
    base = without(marked, [kept, units])
    bound_batches(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, 1_000_000):
                out, sizes = [], []
                for t, s in zip(batch.column(text).cast(pa.large_binary()).to_pylist(), batch.column(spans).to_pylist(), strict=True):
                    parts = (t or b"") if unit == "byte" else (t or b"").split()
                    sizes.append(len(parts))
                    edges = [0, *s, len(parts)] if s else [0, len(parts)]
                    left = [parts[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    out.append(b"".join(left) if unit == "byte" else b" ".join([w for ws in left for w in ws]))
                yield with_arrays(batch, **{kept: pa.array(out, pa.binary()), units: pa.array(sizes, pa.int64())})

    return base.mapInArrow(in_worker("repeats", run), T.StructType([*base.schema.fields, T.StructField(kept, T.BinaryType()), T.StructField(units, T.LongType())]))


def removed_units(spans: str = "spans"):
    """Number of units in flat spans, as an expression."""
    s = F.col(spans)
    return F.aggregate(F.transform(s, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)


def byte_repeats(df: DataFrame, width: int = 200, anchor: int = 32, **how) -> DataFrame:
    """Spans of bytes under repeated ``width``-byte strings, by run-length indexes."""
    return mark(df, "runs", "byte", width, anchor, **how)


def word_repeats(df: DataFrame, width: int = 35, anchor: int = 8, **how) -> DataFrame:
    """Spans of words under repeated runs of ``width`` words, by FM-indexes with wavelet trees."""
    return mark(df, "wavelet", "word", width, anchor, **how)
