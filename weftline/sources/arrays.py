"""JSON arrays in files of any size, read in parallel.

A file is read in pieces between commas, which any split can start with. What a split makes of its text depends on what
came before only in two ways: whether it starts inside a string, and how deep in brackets. So each split is summed up for both
cases of the first (how it turns the string state and the depth, how low it gets, how many commas it has at each depth), the
sums are composed over the splits of a file, and then all splits are cut at the commas of depth one at the same time. Only
elements that reach over a split's end are put together by a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.strictjson import ROW_TYPE, Malformed, read_row
from weftline.plans.durable import keep
from weftline.sources.fileindex import PLACE, at_place, running, runs

COMMA, QUOTE, BACKSLASH = b",", 34, 92
#: White space of JSON.
BLANK = b" \t\r\n"
_SIDE = [T.StructField("deep", T.LongType()), T.StructField("low", T.LongType()), T.StructField("commas", T.MapType(T.LongType(), T.LongType()))]
SUMMARY = T.StructType([T.StructField("place", PLACE), T.StructField("turn", T.LongType()), T.StructField("marks", T.LongType()), *[T.StructField(n, T.StructType(_SIDE)) for n in ("outside", "inside")]])
CUT = T.StructType([T.StructField("place", PLACE), T.StructField("element", T.LongType()), T.StructField("starts", T.BooleanType()), T.StructField("ends", T.BooleanType()), T.StructField("raw", T.StringType())])


class Marks(NamedTuple):
    """What counts in a text of pieces: for each bracket and comma its place, how many quotes stand before it, and +1, -1 or 0."""

    data: bytes
    at: np.ndarray
    quotes: np.ndarray
    step: np.ndarray
    turns: int


def marks(pieces: list[bytes]) -> Marks:
    """A comma stands behind each piece; so no escape reaches over a piece's end."""
    data = COMMA.join(pieces) + COMMA
    b = np.frombuffer(data, np.uint8)
    slashes = b == BACKSLASH
    escaped = np.zeros(len(b), bool)
    if slashes.any():  # what follows an odd run of backslashes
        first = np.flatnonzero(slashes & ~np.r_[False, slashes[:-1]])
        after = np.flatnonzero(np.r_[False, slashes[:-1]] & ~slashes)
        escaped[after[(after - first) % 2 == 1]] = True
    quotes = np.flatnonzero((b == QUOTE) & ~escaped)
    step = np.zeros(256, np.int64)
    step[[91, 123]], step[[93, 125]] = 1, -1
    at = np.flatnonzero((step[b] != 0) | (b == COMMA[0]))
    return Marks(data, at, np.searchsorted(quotes, at), step[b[at]], len(quotes))


def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, value) to one row a split: see the module."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(SUMMARY)
    now, row = None, None

    def done() -> pa.RecordBatch:
        sides = [{"deep": s["deep"], "low": s["low"], "commas": list(s["commas"].items())} for s in row["sides"]]
        return pa.RecordBatch.from_pylist([{"place": dict(zip(PLACE.names, now, strict=True)), "turn": row["turn"] % 2, "marks": row["marks"], "outside": sides[0], "inside": sides[1]}], schema)

    for batch in batches:
        for split, rows in runs(batch):
            if split != now:
                if now is not None:
                    yield done()
                now, row = split, {"turn": 0, "marks": 0, "sides": [{"deep": 0, "low": None, "commas": Counter()} for _ in range(2)]}
            pieces = rows.column("value").cast(pa.large_binary()).to_pylist()
            m = marks(pieces)
            row["marks"] += sum(len(p.strip(BLANK)) for p in pieces)
            for inside, side in enumerate(row["sides"]):
                out = (m.quotes + row["turn"] + inside) % 2 == 0
                step = m.step[out]
                depth = side["deep"] + np.cumsum(step)
                if len(lows := depth[step != 0]):
                    side["low"] = min(int(lows.min()), side["low"] if side["low"] is not None else int(lows.min()))
                side["commas"].update(Counter(depth[step == 0].tolist()))
                side["deep"] += int(step.sum())
            row["turn"] += m.turns
    if now is not None:
        yield done()


def placed_splits(summaries: DataFrame) -> DataFrame:
    """(place, inside, level, element): the state in which each split that still belongs to its file's array starts, and how
    many elements ended before it. A file whose array does not close stops the run; blank files have none."""
    by_file = Window.partitionBy("place.path").orderBy("place.start")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    stated = summaries.withColumn("inside_now", earlier("turn") % 2)
    side = stated.withColumn("side", F.when(F.col("inside_now") == 1, F.col("inside")).otherwise(F.col("outside")))
    level = side.withColumn("level", earlier("side.deep"))
    closes = F.coalesce(F.col("level") + F.col("side.low") <= 0, F.lit(False))
    counted = level.withColumns({"closes": closes.cast("long"), "ended": F.coalesce(F.element_at("side.commas", 1 - F.col("level")), F.lit(0))})
    whole = Window.partitionBy("place.path")
    open_file = (F.sum("closes").over(whole) == 0) & (F.sum("marks").over(whole) > 0)
    path = F.when(open_file, F.raise_error(F.concat(F.lit("the array does not end in "), "place.path"))).otherwise(F.lit(False))
    found = counted.select("place", F.col("inside_now").alias("inside"), "level", earlier("ended").alias("element"), earlier("closes").alias("closed"), "marks", path.alias("open"))
    return found.where("not open and closed = 0").drop("closed", "open")


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, value, inside, level, element) to the elements of each split, or what it has of them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(CUT)
    now, held, state = None, [], None
    out: list[tuple] = []

    def emit() -> pa.RecordBatch:
        rows = [dict(zip(CUT.names, (dict(zip(PLACE.names, p, strict=True)), *rest), strict=True)) for p, *rest in out]
        out.clear()
        return pa.RecordBatch.from_pylist(rows, schema)

    def give(ends: bool) -> None:
        out.append((now, state["element"], state["starts"], ends, COMMA.join(held).decode("utf-8", "replace")))
        held.clear()

    for batch in batches:
        for split, rows in runs(batch):
            if split != now:
                if held:
                    give(False)
                inside, level, element = (rows.column(n)[0].as_py() for n in ("inside", "level", "element"))
                now = split
                # A split at depth one, outside strings, starts behind a comma that parts elements; a file, behind its bracket.
                state = {"turn": inside, "level": level, "element": element, "starts": level == 0 or (level == 1 and not inside), "opened": level > 0, "closed": False}
            if state["closed"]:
                continue
            pieces = rows.column("value").cast(pa.large_binary()).to_pylist()
            if not state["opened"]:
                if not pieces[0].lstrip(BLANK):
                    if len(pieces) == 1:
                        continue  # nothing of the file yet, or all of a blank one
                    raise Malformed("a comma before the array")
                if not pieces[0].lstrip(BLANK).startswith(b"["):
                    raise Malformed("the file does not begin with an array")
                pieces[0] = pieces[0].lstrip(BLANK)[1:]
                state |= {"opened": True, "level": 1}
            m = marks(pieces)
            out_of_strings = (m.quotes + state["turn"]) % 2 == 0
            depth = state["level"] + np.cumsum(np.where(out_of_strings, m.step, 0))
            ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
            behind = np.searchsorted(m.at, ends)  # each piece's comma among the marks
            parting = out_of_strings[behind] & (depth[behind] == 1)
            zero = np.flatnonzero(out_of_strings & (m.step < 0) & (depth == 0))
            last = int(np.searchsorted(ends, m.at[zero[0]])) if len(zero) else len(pieces)
            for i, piece in enumerate(pieces[:last]):
                held.append(piece)
                if parting[i]:
                    give(True)
                    state |= {"element": state["element"] + 1, "starts": True}
            if len(zero):
                close = int(m.at[zero[0]])
                if m.data[close : close + 1] != b"]":
                    raise Malformed("the array ends with another bracket")
                held.append(m.data[int(ends[last - 1]) + 1 if last else 0 : close])
                if state["element"] or not state["starts"] or COMMA.join(held).strip(BLANK):
                    give(True)
                held.clear()
                state["closed"] = True
            else:
                state |= {"turn": (state["turn"] + m.turns) % 2, "level": int(depth[-1])}
        if out:
            yield emit()
    if held:
        give(False)
    if out:
        yield emit()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_type

    nothing = dict.fromkeys(ROW_TYPE.names) | {"error": "nothing stands before or after a comma"}
    for batch in batches:
        raw = [r.strip(" \t\r\n") for r in batch.column("raw").to_pylist()]
        parsed = [read_row(r) if r else nothing for r in raw]
        yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("element"), pa.array(raw), pa.array(parsed, to_arrow_type(ROW_TYPE))], names=["place", "element", "raw", "parsed"])


def array_elements(spark: SparkSession, path: str, place: list) -> DataFrame:
    """(logical_index, raw, parsed) of all elements of the arrays in the files of a path, in the order of files.

    Strict as the lines are; any fault, also in an element that no one asks for, stops the read. What follows the closing
    bracket is not looked at. ``place``: the columns that tell a split.
    """
    text = spark.read.option("lineSep", ",").text(path).select("value", F.struct(*place).alias("place"))
    summaries = keep(text.mapInArrow(summarised, SUMMARY))
    splits = keep(placed_splits(summaries))
    count = splits.count()
    found = keep(at_place(text, splits, count).select("place", "value", "inside", "level", "element").mapInArrow(cut, CUT))
    whole = found.where("starts and ends").select("place", "element", "raw")
    torn = found.where("not (starts and ends)").groupBy("place.path", "element")
    parts = torn.agg(F.min("place").alias("place"), F.array_sort(F.collect_list(F.struct("place.start", "raw"))).alias("parts"))
    joined = parts.select("place", "element", F.array_join(F.transform("parts", lambda p: p["raw"]), ",").alias("raw"))
    schema = T.StructType([*CUT.fields[:2], CUT["raw"], T.StructField("parsed", ROW_TYPE)])
    read = keep(whole.unionByName(joined).mapInArrow(_read, schema))
    wrong = read.where("parsed.error is not null").orderBy("place.path", "element").select("parsed.error").first()
    if wrong:
        raise Malformed(f"an element of the array is no JSON: {wrong[0]}")
    files = F.struct("place.append", "place.part", "place.path").alias("file")
    sizes = running(read.groupBy(files).agg(F.count("*").alias("n")), ["file"], ["n"])
    return read.withColumn("file", files).join(sizes, "file").select((F.col("before_n") + F.col("element")).alias("logical_index"), "raw", "parsed")
