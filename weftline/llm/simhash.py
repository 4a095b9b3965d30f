"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of 16 four-bit segments. The Manhattan distance of two such vectors
is never above the fingerprints' Hamming distance, so fingerprints that differ in at most two bits lie within
Manhattan distance two. That range join is done on the grid of integer vectors: two points within distance two share
a cell among the points themselves and their neighbours one step down or up in one segment. Pairs that meet in a cell
are verified on all 64 bits. A cell crowded with fingerprints is split by a second grid over other segments (bits 16 apart),
in which such pairs meet as well. Where a cell of both grids is still crowded, its fingerprints lie close together, and it
is resolved without pairs: each fingerprint is joined to the 64 that differ in one bit, and all that meet in one of those
are within two bits of each other, so a star of links to the least of them says the same as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, cut_lineage, in_worker, slices, with_arrays, without
from weftline.llm.graph import components

SEGMENTS, WIDTH = 16, 4
#: Rows that a cell may have before it is split by the second grid, and a cell of that one before stars resolve it; all exact.
CROWDED = 200


def shingle_hashes(text: bytes, words_each: int, seed: int) -> np.ndarray:
    words = text.lower().split()
    n = len(words) - words_each + 1
    if n <= 0:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    firsts = np.r_[0, ends[: n - 1] + 1].tolist()
    shingles = [joined[a:b] for a, b in zip(firsts, ends[words_each - 1 :].tolist(), strict=True)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 8192):
        counts += np.unpackbits(hashes[a : a + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", words_each: int = 3, seed: int = 42, step_bytes: int = 1_000_000) -> DataFrame:
    """Add ``fp`` (long, the 64 bits as signed): bit i is 1 if it is set in over half of the shingles' hashes.

    A-Z are lower-cased, words are runs without ASCII white space, repeats count; fewer words than a shingle has make
    one shingle; none (null or blank text) give 0. ``text`` leaves the result; a clashing ``fp`` is replaced.
    """
    base = without(df, [out])
    bound_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, step_bytes):
                prints = np.zeros(batch.num_rows, np.uint64)
                for i, t in enumerate(batch.column(text).cast(pa.large_binary()).to_pylist()):
                    prints[i] = fingerprint_of(shingle_hashes(t or b"", words_each, seed))
                yield with_arrays(batch.drop_columns([text]), **{out: pa.array(prints.view(np.int64))})

    schema = T.StructType([f for f in base.schema.fields if f.name != text] + [T.StructField(out, T.LongType())])
    return base.mapInArrow(in_worker("simhash", run), schema)


def _bit(i: int) -> int:
    return (1 << i) - (1 << 64 if i == 63 else 0)


#: Bits of each segment: four neighbours in the first grid, four that are 16 apart in the second (as signed longs).
SEGMENT_BITS = [[sum(_bit(WIDTH * i + b) for b in range(WIDTH)) for i in range(SEGMENTS)], [sum(_bit(i + SEGMENTS * b) for b in range(WIDTH)) for i in range(SEGMENTS)]]


def _grid(rows: DataFrame, which: int, cell: str, kind: str) -> DataFrame:
    """Rows (fp, ..) once for a fingerprint's own cell (kind 0) and for those one step down (1) or up (2) in a segment."""
    passed = rows.columns
    counts = rows.select("*", *[F.bit_count(F.col("fp").bitwiseAND(F.lit(m))).cast("long").alias(f"s{i}") for i, m in enumerate(SEGMENT_BITS[which])])
    own = counts.withColumn("own", sum((F.shiftleft(F.col(f"s{i}"), 3 * i) for i in range(1, SEGMENTS)), F.col("s0")))
    at = lambda c, k: F.struct(c.alias("cell"), F.lit(k).cast("byte").alias("kind"))
    down = [F.when(F.col(f"s{i}") > 0, at(F.col("own") - F.lit(1 << 3 * i).cast("long"), 1)) for i in range(SEGMENTS)]
    up = [F.when(F.col(f"s{i}") < WIDTH, at(F.col("own") + F.lit(1 << 3 * i).cast("long"), 2)) for i in range(SEGMENTS)]
    return own.select(*passed, F.explode(F.array(at(F.col("own"), 0), *down, *up)).alias("c")).where("c is not null").select(*passed, F.col("c.cell").alias(cell), F.col("c.kind").alias(kind))


def _sized(grid: DataFrame, cells: list[str]) -> DataFrame:
    return grid.join(grid.groupBy(*cells).agg(F.count("*").alias("n")), cells)


def _pairs(light: DataFrame, cells: list[str], kinds: list[str], bits: int) -> DataFrame:
    """Fingerprints that meet in a cell and differ in at most so many bits. Of the kinds in which two can meet, each pair
    within two steps has one of these: own and own, own or up and down, down and down."""
    a = light.select(*cells, F.col("fp").alias("u"), *[F.col(k).alias(f"u_{k}") for k in kinds])
    b = light.where(f"{kinds[0]} < 2").select(*cells, F.col("fp").alias("v"), *[F.col(k).alias(f"v_{k}") for k in kinds])
    first = f"((u_{kinds[0]} = v_{kinds[0]} and u < v) or (v_{kinds[0]} = 1 and u_{kinds[0]} <> 1))"
    others = [f"((u_{k} = v_{k} and u_{k} < 2) or ((u_{k} = 1) <> (v_{k} = 1)))" for k in kinds[1:]]
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits
    return a.join(b, cells).where(" and ".join([first, *others])).where(near).select("u", "v")


def links(nodes: DataFrame, bits: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(u, v) over distinct fingerprints: enough links within ``bits`` (at most 2) to connect all that are within it."""
    if not 0 <= bits <= 2:
        raise ValueError("the grid covers distances up to two bits")
    sized = _sized(_grid(nodes.select("fp"), 0, "cell", "kind"), ["cell"])
    pairs = _pairs(sized.where(F.col("n") <= crowded), ["cell"], ["kind"], bits)
    split = _sized(_grid(sized.where(F.col("n") > crowded).select("fp", "cell", "kind"), 1, "cell2", "kind2"), ["cell", "cell2"])
    fine = _pairs(split.where(F.col("n") <= crowded), ["cell", "cell2"], ["kind", "kind2"], bits)
    crowd = split.where(F.col("n") > crowded).select("fp").distinct()
    one = [F.col("fp").bitwiseXOR(F.lit(_bit(i)).cast("long")) for i in range(64)]
    if bits == 1:  # neighbours themselves
        stars = crowd.select(F.col("fp").alias("u"), F.explode(F.array(*one)).alias("v")).join(crowd.select(F.col("fp").alias("v")), "v").select("u", "v")
    else:
        around = crowd.select("fp", F.explode(F.array(F.col("fp"), *(one if bits == 2 else []))).alias("at"))
        centre = around.groupBy("at").agg(F.min("fp").alias("v"), F.max("fp").alias("top")).where("v < top").select("at", "v")
        stars = around.join(centre, "at").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(fine).unionByName(stars)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = 2, crowded: int = CROWDED, **shingling) -> DataFrame:
    """(id, fp, root, component_id) for each row: component_id is the least id reachable over links of ``bits`` or fewer.

    Texts without words have fingerprint 0 and link like any other. Null ids never are a component's least id; where a
    component has no other, component_id is null. Repeated rows stay; an empty table gives no rows.
    """
    prints = cut_lineage(fingerprints(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", "fp", **shingling))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes.select("fp"), bits, crowded)).withColumnRenamed("v", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "root", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component only the row with the least id; all columns stay.

    Repeated rows of that id count once; of a component without any id one row stays.
    """
    found = cut_lineage(near_duplicates(df, id_col, text, **how))
    first = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    groups = first.groupBy(id_col, "root").agg(F.count("*").alias("copies"))
    single = groups.where(F.col(id_col).isNotNull() & (F.col("copies") == 1)).select(id_col)
    kept = df.join(single, id_col, "left_semi")
    several = groups.where(F.col(id_col).isNull() | (F.col("copies") > 1))
    if several.isEmpty():
        return kept.select(df.columns)
    again = df.join(several.select(F.col(id_col).alias("__id")).distinct(), F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    marked = fingerprints(again.withColumn("__text", F.col(text)), "__text", "__fp")
    root_of = found.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("component_id").alias("__least")).distinct()
    rest = marked.join(root_of, "__fp").where(F.col(id_col).eqNullSafe(F.col("__least"))).dropDuplicates(["__root"])
    return kept.select(df.columns).unionByName(rest.select(df.columns))
