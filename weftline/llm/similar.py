"""Near-duplicates by similarity: the Jaccard index of two texts' sets of five-word shingles is 0.8 or more.

Candidates are found in two ways. The SimHash operator links fingerprints of the five-word shingles that differ in two bits
at most (``simhash.links``); at 0.8 most fingerprints differ in more, so min-hash signatures find the others: texts that
agree in all rows of a band meet in a cell. Each cell, and each fingerprint, links its members to the least of them, which is
linear in its size; components of those links are groups in which all candidates lie. The texts of a group of bounded load
are gathered once and every candidate pair is checked on the sets themselves, unless earlier checks have connected the
two. A larger group is never gathered (``split``): its members are first checked against one leader each, then what is
still apart in a cell by pairs of bounded blocks. With 24 bands of 6 rows a pair at 0.8 shares a cell with a chance of
0.9993, at 0.9 of all but 1e-7.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, cut_lineage, in_worker, row_keys, set_aside, slices
from weftline.llm.graph import components
from weftline.llm.simhash import fingerprint_of, links, shingle_hashes

WORDS, LEAST, SEED = 5, 0.8, 42
BANDS, ROWS, BITS = 24, 6, 2
_DRAWN = np.random.default_rng(SEED)
_TIMES = (_DRAWN.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_PLUS = _DRAWN.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
#: Signatures that agree in less than this share of rows are not compared as sets: six deviations below 0.8.
DISTANT = 0.6
#: A set's load is its number of shingles and a constant for its signature. A group above MOST is split; a block has BLOCK.
EACH, MOST, BLOCK = 1000, 8_000_000, 1_000_000
#: Rounds in which each member of a large group that is still apart from some leader of its cells is checked against one.
LEADERS = 3


def shingle_set(text: bytes) -> np.ndarray:
    """Hashes of the different shingles, sorted; fewer words than a shingle has make one, none make an empty set."""
    return np.unique(shingle_hashes(text, WORDS, SEED))


def fingerprint(shingles: np.ndarray) -> int:
    """SimHash fingerprint of a set of shingles."""
    return fingerprint_of(shingles)


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(low), 2048):
        np.minimum(least, (low[a : a + 2048] * _TIMES + _PLUS).min(axis=1), out=least)
    return least


def cells(signed: np.ndarray) -> list[int]:
    """A signed 64-bit name for each band's rows."""
    data = signed.tobytes()
    names = [xxhash.xxh64_intdigest(data[4 * ROWS * b : 4 * ROWS * (b + 1)], b) for b in range(BANDS)]
    return np.array(names, np.uint64).view(np.int64).tolist()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def near(signed: np.ndarray, size: np.ndarray, i: int, others: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Those of ``others`` whose signature and size do not rule out that they are similar to ``i``."""
    fits = (signed[others] == signed[i]).mean(axis=1) >= DISTANT
    return others[fits & (np.minimum(size[others], size[i]) >= least * np.maximum(size[others], size[i]))]


def connect(sets: list[np.ndarray], least: float = LEAST) -> list[int]:
    """For each set the first one that it is connected to by candidate pairs that are similar."""
    signed, prints = np.array([signature(s) for s in sets]), np.array([fingerprint(s) for s in sets], np.uint64)
    size, root = np.array([len(s) for s in sets]), list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def check(i: int, others: np.ndarray) -> None:
        for j in near(signed, size, i, others, least).tolist():
            a, b = find(i), find(j)
            if a != b and jaccard(sets[i], sets[j]) >= least:
                root[max(a, b)] = min(a, b)

    held: dict[int, list[int]] = defaultdict(list)
    for i in range(len(sets)):
        mine = cells(signed[i])
        if some := {j for c in mine if c in held for j in (held[c][0], held[c][-1])}:
            check(i, np.array(sorted(some)))
        for c in mine:
            held[c].append(i)
        if len(close := np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= BITS)):
            check(i, close)
    done: set[tuple[int, ...]] = set()
    for found in held.values():
        if len(found) < 3 or tuple(found) in done:
            continue
        done.add(tuple(found))
        members = np.array(found)
        for k in range(1, len(members)):
            of = np.array([find(j) for j in found])
            if (of == of[0]).all():
                break
            if len(others := members[:k][of[:k] != of[k]]):
                check(int(members[k]), others)
    return [find(i) for i in range(len(sets))]


def sketches(df: DataFrame, step_bytes: int = 1_000_000) -> DataFrame:
    """(row, id, text) to (row, id, key, more, fp, size, cells): key and more are 128 bits of the set's hash, fp its fingerprint, size
    its number of shingles; a text without words is in no cell."""
    bound_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", step_bytes):
                keys, prints, sizes, where = [], [], [], []
                for t in batch.column("text").cast(pa.large_binary()).to_pylist():
                    shingles = shingle_set(t or b"")
                    keys.append(xxhash.xxh3_128_intdigest(shingles.tobytes(), SEED))
                    prints.append(fingerprint(shingles))
                    sizes.append(len(shingles))
                    where.append(cells(signature(shingles)) if len(shingles) else [])
                low = (1 << 64) - 1
                key, more, fp = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in ([k & low for k in keys], [k >> 64 for k in keys], prints))
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), key, more, fp, pa.array(sizes, pa.int64()), pa.array(where, pa.list_(pa.int64()))], names=["row", "id", "key", "more", "fp", "size", "cells"])

    schema = T.StructType([df.schema["row"], df.schema["id"], T.StructField("key", T.LongType()), T.StructField("more", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("size", T.LongType()), T.StructField("cells", T.ArrayType(T.LongType()))])
    return df.select("row", "id", "text").mapInArrow(in_worker("similar", run), schema)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's (root, key, more, text) to (key, more, component), the component named by one of its sets' hashes."""
    texts: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for key, more, text in zip(batch.column("key").to_pylist(), batch.column("more").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
            if (key, more) not in texts:
                texts[key, more] = shingle_set(text or b"")
    keys = sorted(texts)
    first = connect([texts[k] for k in keys])
    columns = [[k for k, _ in keys], [m for _, m in keys], [keys[i][0] for i in first], [keys[i][1] for i in first]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "more", "component", "component_more"])


def print_links(nodes: DataFrame) -> DataFrame:
    """(key, fp, ..) to (u, v): keys whose fingerprints are the same, or are linked."""
    prints = cut_lineage(nodes.groupBy("fp").agg(F.min("key").alias("v")))
    same = nodes.join(prints, "fp").where("key <> v").select(F.col("key").alias("u"), "v")
    name = lambda a, b: prints.select(F.col("fp").alias(a), F.col("v").alias(b))
    linked = links(prints.select("fp"), BITS).withColumnsRenamed({"u": "a", "v": "b"}).join(name("a", "u"), "a").join(name("b", "v"), "b").select("u", "v")
    return same.unionByName(linked)


def candidate_groups(nodes: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """(key, fp, cells) to (key, root): all keys that meet another in a cell or are linked by their fingerprints
    (``print_links``, unless given), by components.

    Keys of 64 bits are enough here, where sets only become candidates: different sets of one key are in one group.
    """
    placed = nodes.select("key", F.explode("cells").alias("cell"))
    centre = placed.groupBy("cell").agg(F.min("key").alias("v"), F.max("key").alias("top")).where("v < top").select("cell", "v")
    stars = placed.join(centre, "cell").where("key <> v").select(F.col("key").alias("u"), "v")
    linked = print_links(nodes) if linked is None else linked
    rooted = cut_lineage(components(stars.unionByName(linked)).select(F.col("v").alias("key"), "root"))
    shared = nodes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.col("key").alias("root"))
    return rooted.unionByName(rooted.select(F.col("root").alias("key"), "root").unionByName(shared.join(rooted, "key", "left_anti")).distinct())


def _sets(batches: Iterator[pa.RecordBatch], *names: str) -> tuple[list[np.ndarray], list[tuple]]:
    """The shingle sets of a task's texts, and what the named columns hold beside them."""
    sets, beside = [], []
    for batch in batches:
        sets += [shingle_set(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        beside += zip(*(batch.column(n).to_pylist() for n in names), strict=True)
    return sets, beside


def _edges(found: list[tuple[tuple, tuple]]) -> pa.RecordBatch:
    node = pa.struct([("key", pa.int64()), ("more", pa.int64())])
    columns = [pa.array([pair[k] for pair in found], node) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A leader and some of its followers (node, lead, text) to the edges (u, v) of those that are similar to it."""
    sets, beside = _sets(batches, "node", "lead")
    signed, size = np.array([signature(s) for s in sets]), np.array([len(s) for s in sets])
    leads = np.array([lead for _, lead in beside], bool)
    i = int(np.flatnonzero(leads)[0])
    yield _edges([(beside[j][0], beside[i][0]) for j in near(signed, size, i, np.flatnonzero(~leads)).tolist() if jaccard(sets[i], sets[j]) >= LEAST])


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two blocks of a cell, or one with itself (node, comp, band, side, text), to edges that join their components.

    A pair that meets in several cells is checked in the first only; links of fingerprints (band -1) where no cell has both.
    """
    sets, beside = _sets(batches, "node", "comp", "band", "side")
    signed, size = np.array([signature(s) for s in sets]), np.array([len(s) for s in sets])
    names, band, side = np.array([cells(s) for s in signed]), beside[0][2], np.array([b[3] for b in beside])
    two = len(set(side.tolist())) == 2
    comps = [(b[1]["key"], b[1]["more"]) for b in beside]
    number = {c: k for k, c in enumerate(dict.fromkeys(comps))}
    of, found = np.array([number[c] for c in comps]), []
    for i in range(1, len(sets)):
        same = names[:i] == names[i]
        here = ~same.any(axis=1) if band < 0 else same.argmax(axis=1) == band
        here &= of[:i] != of[i]
        if two:
            here &= side[:i] != side[i]
        for j in near(signed, size, i, np.flatnonzero(here)).tolist():
            if of[i] != of[j] and jaccard(sets[i], sets[j]) >= LEAST:
                found.append((beside[i][0], beside[j][0]))
                of[of == of[i]] = of[j]
    yield _edges(found)


def split(nodes: DataFrame, texts: DataFrame, linked: DataFrame, block: int = BLOCK) -> DataFrame:
    """Components of similar candidates in groups of any size: ``nodes`` (node, load, cells; node a struct of key and more),
    their ``texts`` (node, text), links of fingerprints (u, v: keys) to (node, comp).

    Candidates are the pairs of a cell and the pairs linked. For some rounds each member is checked against the leader of one
    of its cells, drawn by a hash, that is in another component than itself, which is linear and joins most copies. Cells
    that still hold several components are then checked wholly, by pairs of blocks of bounded load: a block has members of one
    large component, or whole small ones, and blocks of the same component do not meet. A leader's followers are split too.
    """
    edge = "u struct<key:long,more:long>, v struct<key:long,more:long>"
    ends = linked.select(F.xxhash64("u", "v").alias("cell"), F.explode(F.array("u", "v")).alias("key"))
    by_link = nodes.select("node", "load", F.col("node.key").alias("key")).join(ends, "key").select("node", "load", F.lit(-1).alias("band"), "cell")
    placed = nodes.select("node", "load", F.posexplode("cells").alias("band", "cell")).unionByName(by_link)
    shared = placed.groupBy("band", "cell").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("band", "cell")
    placed = cut_lineage(placed.join(shared, ["band", "cell"]))
    joined, home = None, nodes.select("node", F.col("node").alias("comp"))

    def parts(load: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(load / F.lit(block))).cast("long")

    def merged(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        every = cut_lineage(found if joined is None else joined.unionByName(found))
        roots = components(every).select(F.col("v").alias("node"), F.col("root").alias("comp"))
        return every, cut_lineage(nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")))

    def apart() -> DataFrame:
        at = placed.join(home, "node")
        mixed = at.groupBy("band", "cell").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("band", "cell")
        return at.join(mixed, ["band", "cell"])

    for k in range(LEADERS):
        at = cut_lineage(apart())
        lead = at.groupBy("band", "cell").agg(F.min(F.struct(F.xxhash64(F.lit(k), "node").alias("h"), "node", "comp")).alias("lead"))
        follows = cut_lineage(at.join(lead, ["band", "cell"]).where(F.col("lead.comp") != F.col("comp")).groupBy("node", "load").agg(F.min("lead").alias("lead")).select("node", "load", F.col("lead.node").alias("by")))
        if follows.isEmpty():
            break
        pieces = follows.groupBy("by").agg(parts(F.sum("load")).alias("n"))
        follows = follows.join(pieces, "by").select(F.struct("by", F.pmod(F.xxhash64("node"), F.col("n")).alias("piece")).alias("task"), "node", F.lit(False).alias("lead"))
        leaders = follows.select("task", F.col("task.by").alias("node"), F.lit(True).alias("lead")).distinct()
        joined, home = merged(follows.unionByName(leaders).join(texts, "node").groupBy("task").applyInArrow(_led, edge))

    at = cut_lineage(apart())
    own = at.groupBy("band", "cell", "comp").agg(F.sum("load").alias("own"))
    small = own.groupBy("band", "cell").agg(F.sum(F.when(F.col("own") < block, F.col("own")).otherwise(0)).alias("small"))
    large, none = F.col("own") >= block, F.struct(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("more"))
    pack = F.when(large, F.pmod(F.xxhash64("node"), parts(F.col("own")))).otherwise(F.pmod(F.xxhash64("comp"), parts(F.col("small"))))
    name = F.struct(large.alias("large"), F.when(large, F.col("comp")).otherwise(none).alias("of"), pack.alias("pack"))
    at = cut_lineage(at.join(own, ["band", "cell", "comp"]).join(small, ["band", "cell"]).select("band", "cell", "node", "comp", name.alias("block")))
    others = at.select("band", "cell", F.col("block").alias("other")).distinct()
    meet = at.join(others, ["band", "cell"]).where(~(F.col("block.large") & F.col("other.large") & (F.col("block.of") == F.col("other.of"))))
    task = F.struct("band", "cell", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    sent = meet.select(task.alias("task"), "node", "comp", "band", (F.col("block") <= F.col("other")).alias("side")).join(texts, "node")
    return merged(sent.groupBy("task").applyInArrow(_crossed, edge))[1]


def keep_one(frame: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The rows of ``frame`` without near-duplicates: of texts connected by similarity only the row with the least id; all
    columns stay, whatever their names.

    Letters A-Z count as lower case, words are runs without ASCII white space; texts without words are alike. A
    component without any id keeps one row; repeated rows count once. Groups of candidates above a load of ``most`` are
    split into blocks, with the same result.
    """
    df, restored = set_aside(frame, [id_col, text])
    row = F.struct(*[k.alias(n) for k, n in zip(row_keys(F.col(id_col), F.col(text)), ("a", "b"), strict=True)])
    drawn = cut_lineage(sketches(df.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    nodes = cut_lineage(drawn.groupBy("key", "more").agg(F.min(order).alias("best"), F.min("fp").alias("fp"), (F.min("size") + EACH).alias("load"), F.min("cells").alias("cells")))
    linked = cut_lineage(print_links(nodes))
    groups = cut_lineage(candidate_groups(nodes, linked))
    large = cut_lineage(groups.join(nodes, "key").groupBy("root").agg(F.sum("load").alias("load")).where(F.col("load") > most).select("root"))
    chosen = groups.join(large, "root", "left_anti").join(nodes, "key").select(F.col("best.row").alias("row"), "key", "more", "root")
    sent = df.select(row.alias("row"), F.col(text).alias("text")).join(chosen, "row").select("root", "key", "more", "text")
    checked = cut_lineage(sent.groupBy("root").applyInArrow(_verified, "key long, more long, component long, component_more long"))
    if not large.isEmpty():
        node = F.struct("key", "more").alias("node")
        mine = cut_lineage(groups.join(large, "root").join(nodes, "key").select(node, "load", "cells", F.col("best.row").alias("row")))
        texts = cut_lineage(df.select(row.alias("row"), F.col(text).alias("text")).join(mine, "row").select("node", "text").dropDuplicates(["node"]))
        found = split(mine, texts, linked, block).select("node.*", F.col("comp.key").alias("component"), F.col("comp.more").alias("component_more"))
        checked = checked.unionByName(found)
    named = nodes.join(checked, ["key", "more"], "left").select(F.coalesce("component", "key").alias("component"), F.coalesce("component_more", "more").alias("component_more"), "best")
    kept = named.groupBy("component", "component_more").agg(F.min("best").alias("best")).select(F.col("best.row").alias("__row"))
    copies = drawn.groupBy(F.col("row").alias("__row")).agg(F.count("*").alias("__copies"))
    kept = cut_lineage(kept.join(copies, "__row"))
    marked = df.withColumn("__row", row)
    once = marked.join(kept.where("__copies = 1").select("__row"), "__row", "left_semi").select(*df.columns)
    several = kept.where("__copies > 1").select("__row")
    if several.isEmpty():
        return restored(once)
    return restored(once.unionByName(marked.join(several, "__row", "left_semi").dropDuplicates(["__row"]).select(*df.columns)))
