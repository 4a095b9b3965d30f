"""Token counts of byte-level BPE by finite-state transducers.

The splitting pattern of the tokenizer is compiled to a deterministic transducer over character classes (``NEXT`` and
``MARKS``). A batch of texts is cut into equal chunks; each chunk's state map (state in -> state out) is computed for
all chunks at once, the maps are composed by a parallel prefix scan, and a second sweep from the now known states marks
where tokens of the pattern start, so nothing depends on where chunks are cut. Each such stretch is read by the merge
transducer (``CountTransducer``), whose transitions carry the emitted-token counts; a stretch that was read before is one
composed arc with its count, known by the stretch itself. A text's count is the sum of its arcs.
"""

from __future__ import annotations

import hashlib
import json
import string
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, in_worker, kept_by_worker, slices, texts, with_arrays, without
from weftline.llm.merges import CountTransducer, MergeTable, Remembered

#: Character classes. The pattern's contractions are 's 't 'm 'd 're 've 'll (fixed values, lower case only).
LETTER, ENDS, R, V, L, E, NUMBER, BLANK, SPACE, APOSTROPHE, OTHER, RESET = range(12)
#: States: what the last character left open.
BEGIN, WORD, DIGITS, SIGNS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, BLANK1, SPACE1, BLANKS, SPACES = range(12)
HERE, BEFORE = 1, 2  # marks: a stretch starts at this character, at the one before


def _compile() -> tuple[np.ndarray, np.ndarray]:
    nxt, marks = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    fresh = {LETTER: WORD, ENDS: WORD, R: WORD, V: WORD, L: WORD, E: WORD, NUMBER: DIGITS, BLANK: BLANK1, SPACE: SPACE1, APOSTROPHE: QUOTE, OTHER: SIGNS}
    run = {WORD: {LETTER, ENDS, R, V, L, E}, DIGITS: {NUMBER}, SIGNS: {OTHER, APOSTROPHE}}
    for state in range(12):
        for c, opened in fresh.items():
            to, mark = opened, HERE  # unless something goes on, a new stretch starts here
            if state in run and c in run[state]:
                to, mark = state, 0
            elif state == QUOTE:
                if c == ENDS:
                    to, mark = BEGIN, 0
                elif c in (R, V, L):
                    to, mark = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[c], 0
                elif c in run[SIGNS]:
                    to, mark = SIGNS, 0
            elif state in (QUOTE_R, QUOTE_V, QUOTE_L):
                if c == (L if state == QUOTE_L else E):
                    to, mark = BEGIN, 0
                elif c in run[WORD]:
                    to, mark = WORD, BEFORE
                else:
                    mark = HERE | BEFORE
            elif state in (BLANK1, SPACE1, BLANKS, SPACES):
                many = state in (BLANKS, SPACES)
                if c in (BLANK, SPACE):
                    to, mark = (BLANKS if c == BLANK else SPACES), 0
                else:  # the last white space leaves a longer run; a blank goes with what follows
                    mark = (BEFORE if many else 0) | (0 if state in (BLANK1, BLANKS) else HERE)
                    if state in (BLANK1, BLANKS) and c == APOSTROPHE:
                        to = SIGNS
            nxt[state, c], marks[state, c] = to, mark
        nxt[state, RESET] = BEGIN
        marks[state, RESET] = HERE | (BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    return nxt, marks


NEXT, MARKS = _compile()


def class_runs(split: Callable[[str], list[tuple[str, tuple[int, int]]]], step: int = 4096) -> list[tuple[int, int, int]]:
    """(first, last, class) of runs of code points beyond ASCII, as a tokenizer's own splitter has them.

    Laid end to end, code points part into runs of one class; what each run goes on with tells which. No table of
    this Python's is asked, whose version of Unicode may be another.
    """
    runs = []
    for a in range(0x80, sys.maxunicode + 1, step):
        points = [i for i in range(a, min(a + step, sys.maxunicode + 1)) if not 0xD800 <= i <= 0xDFFF]
        for _, (x, y) in split("".join(map(chr, points))) if points else []:
            c = chr(points[x])
            goes_on = lambda lead: split(lead + c)[-1][1] == (0, 2)  # noqa: B023, E731
            runs.append((points[x], points[y - 1], LETTER if goes_on("a") else NUMBER if goes_on("1") else OTHER if goes_on("!") else SPACE))
    return runs


def class_table(runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Class of each code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for first, last, kind in runs:
        table[first : last + 1] = kind
    for chars, k in ((string.ascii_letters, LETTER), (string.digits, NUMBER), ("\t\n\v\f\r", SPACE), ("stmd", ENDS), ("r", R), ("v", V), ("l", L), ("e", E), (" ", BLANK), ("'", APOSTROPHE)):
        for c in chars:
            table[ord(c)] = k
    return table


def starts(classes: np.ndarray, width: int = 128) -> np.ndarray:
    """Whether a stretch starts at each character; RESET stands before each text and after the last."""
    n = len(classes)
    rows = -(-n // width)
    padded = np.full(rows * width, RESET, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, width).T)
    flat = NEXT.ravel()
    # Each chunk's state map; from then on the prefix scan composes maps of chunks 1, 2, 4, ... apart.
    maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (rows, 12)).copy()
    for column in columns:
        maps = flat[maps * np.uint8(12) + column[:, None]]
    step = 1
    while step < rows:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = maps[:-1, BEGIN]
    marks, out = MARKS.ravel(), np.empty((width, rows), np.uint8)
    for j, column in enumerate(columns):
        at = state * np.uint8(12) + column
        out[j], state = marks[at], flat[at]
    got = out.T.ravel()[:n]
    here = got & HERE != 0
    here[:-1] |= got[1:] & BEFORE != 0
    return here


def load_tokenizer(path: str) -> dict:
    """Merges, added tokens and character classes of a byte-level BPE tokenizer file; other kinds are refused.

    Classes come from the library's splitter, once, on the driver; workers are sent them.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec.get("normalizer"):
        raise ValueError("needs a byte-level BPE tokenizer with the usual pattern and no normalizer")
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    return {"merges": merges, "vocabulary": sorted(model["vocab"]), "added": sorted(t["content"] for t in spec["added_tokens"]), "classes": class_runs(Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such files: printable ones for themselves, the rest from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Counter:
    def __init__(self, spec: dict):
        order = {tuple(m.split(" ")): i for i, m in enumerate(spec["merges"])}
        self.transducer = CountTransducer(MergeTable({p: 0 for p in spec["vocabulary"]}, lambda a, b: order.get((a, b))))
        self.letters = dict(enumerate(byte_letters()))
        self.added = spec["added"]
        self.arcs = Remembered(self.arc)
        self.classes = class_table(spec["classes"])

    def arc(self, stretch: str) -> int:
        symbols = stretch.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return self.transducer.count(symbols)

    def count(self, documents: list[str]) -> list[int]:
        """Tokens of each text. Added tokens' strings count one each and part the text, as the library has it by default."""
        counts = [0] * len(documents)
        owners, segments = [], []
        for i, text in enumerate(documents):
            parts = [text]
            for special in self.added:
                if special in text:
                    counts[i] += sum(p.count(special) for p in parts)
                    parts = [q for p in parts for q in p.split(special)]
            for p in parts:
                if p:
                    owners.append(i)
                    segments.append(p)
        if not segments:
            return counts
        joined = "\n".join(segments) + "\n"  # a place for RESET after each; it also pushes out what is pending
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes[points]
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        classes[ends] = RESET
        here = starts(classes)
        first = np.r_[0, ends[:-1] + 1]
        here[first] = True
        cuts = np.flatnonzero(here)
        after = np.r_[cuts[1:], len(classes)]
        stretches = [joined[a:b] for a, b in zip(cuts.tolist(), after.tolist(), strict=True)]
        emitted = np.fromiter(map(self.arcs.__getitem__, stretches), np.int64, len(stretches))
        emitted[np.searchsorted(cuts, ends)] = 0  # a RESET itself
        for owner, n in zip(owners, np.add.reduceat(emitted, np.searchsorted(cuts, first)).tolist(), strict=True):
            counts[owner] += n
        return counts


def _shared_counter(key: str, spec: dict) -> Counter:
    """One counter for a worker and vocabulary, kept over tasks."""
    if kept_by_worker.get("counter of") != key:
        kept_by_worker["counter of"], kept_by_worker["counter"] = key, Counter(spec)
    return kept_by_worker["counter"]


def count_tokens(df: DataFrame, spec: dict, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", step_bytes: int = 2_000_000) -> DataFrame:
    """Add ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text; null counts as empty, which has no tokens.

    Columns of these names are replaced, others pass through. No shuffle; memory follows ``step_bytes`` or the longest text.
    """
    base = without(df, [n_bytes, n_tokens])
    bound_batches(df)
    shared = df.sparkSession.sparkContext.broadcast((hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest(), spec))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _shared_counter(*shared.value)
        for whole in batches:
            for batch in slices(whole, text, step_bytes):
                size = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).cast(pa.int64())
                yield with_arrays(batch, **{n_bytes: size, n_tokens: pa.array(counter.count(texts(batch.column(text))), pa.int64())})

    return base.mapInArrow(in_worker("fst_tokens", run), T.StructType([*base.schema.fields, T.StructField(n_bytes, T.LongType()), T.StructField(n_tokens, T.LongType())]))
