"""Input rows from JSONL or a JSON array, and the engine's own JSONL tables."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import strictjson
from weftline.functions import text as X
from weftline.plans.durable import keep
from weftline.sources import arrays
from weftline.sources.commits import APPEND, committed_rows, exists, folders_of
from weftline.sources.fileindex import at_place, counted_lines, split_index

#: Columns of the engine's own rows; '' stands for absent.
OUTPUT_FIELDS = ("task_id", "status", "user", "generated_item_json", "answer_model", "assistant", "text")
SHOWN_ERRORS = 5
_NO_ERROR = T.StructType([T.StructField("error", T.StringType())])
#: Where a line stands (see ``file_place``).
LINE = T.StructType([T.StructField(n, T.StringType() if n == "path" else T.LongType()) for n in ("append", "part", "path", "start", "line")])


def sniff(spark: SparkSession, path: str) -> str:
    """"array" if the first byte that is not ASCII white space is ``[``, else "lines"; a blank file is an error."""
    head = spark.read.text(path).where(F.regexp_replace("value", r"[ \t\n\x0B\f\r]+", "") != "").limit(1).first()
    if head is None:
        raise ValueError(f"{path} is empty")
    return "array" if head["value"].lstrip(" \t\n\x0b\x0c\r").startswith("[") else "lines"


def file_place(numbers: dict[str, int] | None = None) -> list[Column]:
    """Where a row of a file scan stands: the number of its append (``numbers``: by folder; 0 without them) and part (0 where
    a file's path has none), path, start of the split.

    Spark packs splits into tasks by size, so a task's number says nothing about the order of files.
    """
    path = F.col("_metadata.file_path")
    append = F.lit(0).cast("long")
    if numbers:
        known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
        append = F.element_at(known, F.regexp_extract(path, rf"/({APPEND}[0-9a-f]{{32}})/", 1)).cast("long")
    part = F.coalesce(F.nullif(F.regexp_extract(path, r"/part-(\d+)-[^/]*\z", 1), F.lit("")).cast("long"), F.lit(0).cast("long"))
    return [append.alias("append"), part.alias("part"), path.alias("path"), F.col("_metadata.file_block_start").alias("start")]


def lines_of(spark: SparkSession, path: str, after: int = 0) -> tuple[list[str], list[Column]]:
    """What to read of a path, and where its rows stand: folders that a commit names (``after``: commits with a greater number
    only), or, where the path was not written by this engine, all files. Nothing for a missing path."""
    folders = folders_of(spark, path, after)
    if folders is None:
        return ([path] if exists(spark, path) else []), file_place()
    return [f"{path}/{f}" for f in folders], file_place(folders)


def dense_index(df: DataFrame, out: str = "logical_index") -> DataFrame:
    """Number rows 0, 1, ... in the order of partitions without a global sort: counts by partition, then offsets.

    The driver holds one number for each partition, not for each row.
    """
    placed = df.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    counts = placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__at").alias("first")).orderBy("__part").collect()
    offsets = [(r["__part"], before - r["first"]) for r, before in zip(counts, accumulate((r["n"] for r in counts), initial=0), strict=False)]
    known = df.sparkSession.createDataFrame(offsets, "__part int, __shift long")
    return placed.join(F.broadcast(known), "__part").withColumn(out, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def input_window(rows: DataFrame, start: int = 0, limit: int | None = None, index: str = "logical_index") -> DataFrame:
    """Rows from ``start`` on, ``limit`` at most, by a dense index."""
    kept = rows.where(F.col(index) >= start)
    return kept if limit is None else kept.where(F.col(index) < start + limit)


def read_rows(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> tuple[DataFrame, dict]:
    """(logical_index, raw, parsed) of the window, and a report of lines that are no JSON (how many, the first few with their
    numbers among the lines that are not blank).

    Such lines take no index, and those behind the window's last row are not reported; in an array any fault fails the load.
    """
    kind = sniff(spark, path)
    if limit == 0:
        kept = T.StructType([T.StructField("logical_index", T.LongType()), T.StructField("raw", T.StringType()), T.StructField("parsed", strictjson.ROW_TYPE)])
        return spark.createDataFrame([], kept), {"invalid": 0, "first": []}
    if kind == "array":
        return input_window(arrays.array_elements(spark, path, file_place()), start, limit), {"invalid": 0, "first": []}
    rows, index = indexed_lines(spark, path, start, limit)
    bad = invalid_lines(rows, index, start, limit)
    first = bad.orderBy("line_number").limit(SHOWN_ERRORS).collect()
    invalid = bad.count() if len(first) == SHOWN_ERRORS else len(first)
    good = rows.where("parsed.error is null").withColumn("logical_index", F.col("before_valid") + F.col("rank"))
    return input_window(good, start, limit).select("logical_index", "raw", "parsed"), {"invalid": invalid, "first": [f"line {r['line_number']}: {r['error']}" for r in first]}


def indexed_lines(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, index) of a file of JSON lines, each line parsed once. lines: raw, parsed, its place, how many lines and valid
    lines of its split stand before it, and of all splits before; only of splits that reach into the window. index: the
    running sums of all splits (``split_index``)."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.struct(*file_place()).alias("place")).where(F.trim("raw") != "")
    fields = [*lines.schema.fields, T.StructField("parsed", strictjson.ROW_TYPE), T.StructField("line", T.LongType()), T.StructField("rank", T.LongType())]
    parsed = keep(lines.mapInArrow(counted_lines(strictjson.read_row, strictjson.ROW_TYPE), T.StructType(fields)))
    index = keep(split_index(parsed, F.col("parsed.error").isNull()))
    reached = index if limit is None else index.where(F.col("before_valid") < start + limit)
    return at_place(parsed, reached, index.count()), index


def invalid_lines(rows: DataFrame, index: DataFrame, start: int = 0, limit: int | None = None) -> DataFrame:
    """(line_number, error, raw) of the lines that are no JSON, up to the window's last row; numbers count from 1."""
    bad = rows.where("parsed.error is not null")
    if limit is not None:
        bad = bad.where(F.col("before_valid") + F.col("rank") < start + limit)
    return bad.select((F.col("before_lines") + F.col("line") + 1).alias("line_number"), F.col("parsed.error").alias("error"), "raw")


def ordered_lines(lines: DataFrame) -> DataFrame:
    """Add ``logical_index`` to rows (raw, place) of a file scan, in the order of files."""
    fields = [lines.schema["raw"], lines.schema["place"], T.StructField("parsed", _NO_ERROR), T.StructField("line", T.LongType()), T.StructField("rank", T.LongType())]
    counted = keep(lines.select("raw", "place").mapInArrow(counted_lines(lambda _: {"error": None}, _NO_ERROR), T.StructType(fields)))
    index = keep(split_index(counted, F.lit(True)))
    return at_place(counted, index, index.count()).select("raw", (F.col("before_valid") + F.col("rank")).alias("logical_index"))


def read_output(spark: SparkSession, paths: list[str], after: dict[str, int] | None = None) -> DataFrame:
    """The engine's rows from files in a fixed order, with file_rank and line_no (appends in their order, and in each the lines
    in theirs); a missing file counts as empty. ``after``: per path, appends with a greater number only.

    ``rewritten_user`` is read as ``user``; a bad line, or one without task_id or status, fails the read.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*OUTPUT_FIELDS, "rewritten_user")])
    parts = []
    for rank, path in enumerate(paths):
        files, place = lines_of(spark, path, (after or {}).get(path, 0))
        if not files:
            continue
        rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(files, mode="FAILFAST")
        checked = [F.when(F.col(n).isNull(), F.raise_error(F.lit(f"a row without {n}"))).otherwise(F.col(n)).alias(n) for n in ("task_id", "status")]
        user = F.coalesce("user", "rewritten_user", F.lit("")).alias("user")
        rest = [F.coalesce(n, F.lit("")).alias(n) for n in OUTPUT_FIELDS[3:]]
        line = F.struct(*place, F.monotonically_increasing_id().alias("line"))
        parts.append(rows.select(*checked, user, *rest, F.lit(rank).alias("file_rank"), line.alias("line_no")))
    if not parts:
        fields = [T.StructField(n, T.StringType()) for n in OUTPUT_FIELDS]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("file_rank", T.IntegerType()), T.StructField("line_no", LINE)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows of finished runs for the exports: text fields ('' for what is no text), expected_answer, and line_no.

    Blank lines are passed over, a missing path gives no rows, a line that is no JSON object stops the read.
    """
    files, place = lines_of(spark, path)
    if not files:
        return spark.createDataFrame([], T.StructType([*strictjson.RECORD_TYPE.fields[:-1], T.StructField("line_no", LINE)]))
    lines = spark.read.option("recursiveFileLookup", "true").text(files)
    kept = lines.select("value", F.struct(*place, F.monotonically_increasing_id().alias("line")).alias("line_no")).where(X.strip(F.col("value")) != "")
    read = kept.select(strictjson.parse_record("value").alias("r"), "line_no")
    wrong = F.raise_error(F.concat(F.lit("invalid line: "), F.col("r.error")))
    first = F.when(F.col("r.error").isNotNull(), wrong).otherwise(F.col("r.task_id")).alias("task_id")
    return read.select(first, *[F.col(f"r.{n}").alias(n) for n in strictjson.RECORD_TYPE.names[1:-1]], "line_no")


def line_counts(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, lines) of written files: by their manifests where they have them, else counted."""
    known = {p: committed_rows(spark, p) for p in paths}
    said = spark.createDataFrame([(p, n) for p, n in known.items() if n is not None], "path string, lines long")
    rest = [p for p in paths if known[p] is None]
    for path in rest:
        one = spark.read.option("recursiveFileLookup", "true").text(path).agg(F.count("*").alias("lines")).select(F.lit(path).alias("path"), "lines")
        said = said.unionByName(one)
    return said
