"""Fill-in-middle: texts cut in three at seeded places and put together anew, over an index of distinct texts.

Texts are grouped by their SHA-256, and a group is taken for one text only if its least and greatest member are the same
(else the run stops); they travel packed, as that pass is all that is shuffled of them. Documents travel as an id, a digest
and where they are to be cut, and meet the index by digest. Rows of one text come one behind the other: the first lists
where the text's code points begin, in bytes (Elias-Fano), and each selects its own two bytes from that list.

A text that very many rows share would make one task of the join: such digests are counted first (``HOT_SHARE`` of them at
most, by arithmetic), and their rows and their index entry are spread by a salt.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bound_batches, cut_lineage, set_aside

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A digest is hot if more than one row in so many has it, so there are fewer than this; each is spread over SPREAD salts.
HOT_SHARE, SPREAD = 500, 64

_HEAD = struct.Struct("<qqq")
_EVERY = 1024  # entries from one known place of the upper bits to the next
_STEP = 1 << 20


def boundaries(text: bytes) -> bytes:
    """Elias-Fano list of the first byte of each code point and of the text's end: lower bits packed, upper bits in unary,
    and the place of every so-manyth entry in these."""
    flat = np.frombuffer(text, np.uint8)
    pieces = range(0, len(flat), _STEP)
    begins = lambda a: (flat[a : a + _STEP] & 0xC0) != 0x80
    n = sum(int(np.count_nonzero(begins(a))) for a in pieces) + 1
    low = max(0, (len(flat) // n).bit_length() - 1)
    upper, lower = np.zeros(n + (len(flat) >> low), np.uint8), np.zeros(n * low, np.uint8)
    known, done = [], 0
    for at in [*(np.flatnonzero(begins(a)) + a for a in pieces), np.array([len(flat)])]:
        place = (at >> low) + np.arange(done, done + len(at))
        upper[place] = 1
        if low:
            lower[done * low : (done + len(at)) * low] = ((at[:, None] >> np.arange(low)) & 1).ravel()
        known.append(place[-done % _EVERY :: _EVERY])
        done += len(at)
    marks = np.concatenate(known).astype("<i8")
    return _HEAD.pack(n, low, len(marks)) + marks.tobytes() + np.packbits(lower, bitorder="little").tobytes() + np.packbits(upper, bitorder="little").tobytes()


def select(listed: bytes, i: int) -> int:
    """The ith entry (from 0) of such a list."""
    n, low, known = _HEAD.unpack_from(listed)
    if not 0 <= i < n:
        raise IndexError(i)
    lows = _HEAD.size + 8 * known
    upper = np.frombuffer(listed, np.uint8, offset=lows + (n * low + 7) // 8)
    place = struct.unpack_from("<q", listed, _HEAD.size + 8 * (i // _EVERY))[0]
    want = i % _EVERY
    at = place // 8  # bits of this byte before the known place don't count
    want += int(upper[at] & ((1 << place % 8) - 1)).bit_count()
    while True:
        some = np.cumsum(np.bitwise_count(upper[at : at + 512]), dtype=np.int64)
        if want < some[-1]:
            break
        want -= int(some[-1])
        at += 512
    byte = int(np.searchsorted(some, want, side="right"))
    want -= int(some[byte - 1]) if byte else 0
    bit = np.flatnonzero(np.unpackbits(upper[at + byte : at + byte + 1], bitorder="little"))[want]
    high = 8 * (at + byte) + int(bit) - i
    bits = np.unpackbits(np.frombuffer(listed, np.uint8, (i * low % 8 + low + 7) // 8, lows + i * low // 8), bitorder="little")[i * low % 8 :][:low] if low else ()
    return (high << low) | sum(int(b) << k for k, b in enumerate(bits))


@F.arrow_udf(returnType=T.BinaryType())
def _packed(text: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack(t or b"") for t in text.cast(pa.large_binary()).to_pylist()], pa.binary())


@F.arrow_udf(returnType=T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
def _opened(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Packed texts and two places in code points: the text, and the places in bytes. One list serves a run of equal texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    last, text, listed = None, b"", b""
    for packed, first, second in columns:
        rows = []
        for p, i, j in zip(packed.to_pylist(), first.to_pylist(), second.to_pylist(), strict=True):
            if p != last:
                last, text = p, unpack(p)
                listed = boundaries(text)
            rows.append((text, select(listed, i), select(listed, j)))
        yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.binary()), *[pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)]], names=["bytes", "a", "b"])


def text_index(texts: DataFrame) -> DataFrame:
    """(key, text) to (key, packed), a row for each distinct text. Texts of one key that are not the same stop the run."""
    one = texts.select("key", _packed("text").alias("packed")).groupBy("key").agg(F.min("packed").alias("least"), F.max("packed").alias("most"))
    same = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.raise_error(F.lit("two different texts share a digest")))
    return one.select("key", same.alias("packed"))


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the id: the first groups of the SHA-256 of ``seed:id`` (nothing for a null id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, digest=lambda t: F.unhex(F.sha2(t, 256))) -> DataFrame:
    """The rows with ``text`` replaced by n, form, prefix_chars, middle_chars and output; other columns stay.

    Cuts are drawn over the code points from the id, so rows of one id and text are cut alike. Plain (the text as it is, the
    two counts null): empty texts, texts with one of the marks, and ``100 - plain_from`` in a hundred. A null text counts as
    empty, a null id as the empty string. Columns whose names clash with the new ones are replaced; an empty table gives no
    rows.
    """
    bound_batches(df)
    new = ("n", "form", "prefix_chars", "middle_chars", "output")
    old = [c for c in df.columns if c.lower() not in new]
    carried, _ = set_aside(df.select(*[F.col(f"`{c}`") for c in old]), [id_col, text])
    names = {o: n for o, n in zip(old, carried.columns, strict=True) if n != text}
    whole = F.coalesce(F.col(text), F.lit(""))
    one, two, three, four = draws(F.col(id_col), seed)
    first, second = F.pmod(one, F.col("n") + 1), F.pmod(two, F.col("n") + 1)
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    form = F.when((F.col("n") == 0) | marked | (three % 100 >= plain_from), "plain").when(four % 100 < spm_below, "spm").otherwise("psm")
    keyed = carried.withColumns({"key": digest(whole), "n": F.length(whole).cast("long")})
    drawn = keyed.withColumns({"form": form, "first": F.least(first, second), "second": F.greatest(first, second), "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))})
    thin = cut_lineage(drawn.drop(text))
    counts = cut_lineage(thin.groupBy("key").agg(F.count("*").alias("rows")))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("rows") * HOT_SHARE > total).select("key"))
    index = text_index(carried.select(digest(whole).alias("key"), whole.alias("text")))
    spread = index.join(hot, "key", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    met = thin.join(hot, "key", "left_anti").join(index, "key")
    met = met.unionByName(thin.join(hot, "key", "left_semi").join(spread, ["key", "salt"]).select(met.columns))
    cut = met.withColumn("cut", _opened("packed", "first", "second"))
    size, a, b = F.octet_length("cut.bytes"), F.col("cut.a").cast("int"), F.col("cut.b").cast("int")
    prefix, middle, suffix = (F.substring(F.col("cut.bytes"), x + 1, y - x) for x, y in ((F.lit(0), a), (a, b), (b, size)))
    mark = lambda m: F.lit(m).cast("binary")
    psm = F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle)
    spm = F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle)
    plain = F.col("form") == "plain"
    made = {
        "output": F.when(plain, F.col("cut.bytes")).otherwise(F.when(F.col("form") == "spm", spm).otherwise(psm)).cast("string"),
        "prefix_chars": F.when(~plain, F.col("first")),
        "middle_chars": F.when(~plain, F.col("second") - F.col("first")),
    }
    return cut.withColumns(made).select(*[F.col(f"`{n}`").alias(o) for o, n in names.items()], *new)


def rebuilt(output: Column, form: Column) -> Column:
    """The text that an output of that form was made from. Its parts hold no mark, and no mark can arise where parts meet."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "plain", output).when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(F.concat(at(1), at(3), at(2)))


def oracle_sql(seed: int = 1) -> str:
    """The digests of all documents in DuckDB SQL."""
    h = lambda k: f"CAST('0x' || substr(d, {8 * k + 1}, 8) AS BIGINT)"
    return f"""WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
        cut AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, least({h(0)} % (length(t) + 1), {h(1)} % (length(t) + 1)) AS a, greatest({h(0)} % (length(t) + 1), {h(1)} % (length(t) + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h(2)} % 100 >= 90 THEN 'plain' WHEN {h(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256 FROM parts"""
