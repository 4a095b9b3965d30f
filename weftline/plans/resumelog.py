"""The rows of earlier runs as a log: a sorted snapshot of all appends up to some point, and the appends since."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import resume
from weftline.sources import commits, scans

#: Appends since the last snapshot, of all files together, from which on a resume makes a new one.
COMPACT_AFTER = 16
PAYLOAD = ["user", "generated_item_json", "answer_model", "assistant", "text"]


def _place(paths: dict[str, str]) -> str:
    """Where snapshots lie: beside the folders of the files."""
    return posixpath.join(posixpath.dirname(posixpath.dirname(next(iter(paths.values())))), "resume")


def snapshots(spark: SparkSession, paths: dict[str, str]) -> list[commits.Commit]:
    """The snapshots that still count, oldest first: none of their files was started anew since."""
    begun = {name: _begun(spark, posixpath.dirname(p)) for name, p in paths.items()}
    return [c for c in commits.commits(spark, _place(paths)) or [] if all(c.since.get(n, 0) == begun[n] for n in paths)]


def _begun(spark: SparkSession, place: str) -> int:
    """The number of a folder's last reset."""
    found = commits.commits(spark, place, whole=True) or []
    return max((c.number for c in found if c.reset), default=0)


def read_log(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, int]:
    """(rows with file_rank and line_no, appends that were read): the snapshot, a row for each task and file, and what was
    appended since."""
    snapshot = next(reversed(snapshots(spark, paths)), None)
    through = {p: snapshot.through.get(name, 0) for name, p in paths.items()} if snapshot else {}
    later = sum(len(commits.folders_of(spark, p, through.get(p, 0)) or ()) for p in paths.values())
    rows = scans.read_output(spark, list(paths.values()), through)
    if snapshot is None:
        return rows, later
    held = spark.read.parquet(f"{_place(paths)}/{snapshot.folders['snapshot']}")
    before = F.struct(*[F.lit("" if f.name == "path" else 0).cast(f.dataType).alias(f.name) for f in scans.LINE.fields])
    return held.withColumn("line_no", before).select(rows.columns).unionByName(rows), later


def compact(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Make a snapshot of everything appended so far, sorted by task. A file keeps its own row of a task, as later files go
    before earlier ones whenever they were written. Another writer may go on meanwhile: its appends stay for the next time."""
    numbers = {name: max((commits.folders_of(spark, p) or {}).values(), default=0) for name, p in paths.items()}
    rows, _ = read_log(spark, paths)
    reached = F.create_map(*[x for rank, name in enumerate(paths) for x in (F.lit(rank), F.lit(numbers[name]).cast("long"))])
    known = rows.where(F.col("line_no.append") <= F.element_at(reached, F.col("file_rank")))
    merged = resume.merge(known, PAYLOAD, ["task_id", "file_rank"], order=("line_no",))
    folder = f"snapshot-{uuid.uuid4().hex}"
    sorted_rows = merged.repartitionByRange("task_id").sortWithinPartitions("task_id", "file_rank")
    sorted_rows.write.parquet(f"{_place(paths)}/{folder}")
    commits.commit(spark, _place(paths), folders={"snapshot": folder}, through=numbers, since={n: _begun(spark, posixpath.dirname(p)) for n, p in paths.items()})
    return merged


def earlier_rows(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The merged rows of all earlier runs; where many appends have gathered, a snapshot is made first."""
    rows, later = read_log(spark, paths)
    if later >= COMPACT_AFTER:
        compact(spark, paths)
        rows, _ = read_log(spark, paths)
    return resume.merge(rows, PAYLOAD)
