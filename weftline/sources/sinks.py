"""Where results go: the layout of an output folder, appends, and exports as JSON lines."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.durable import keep
from weftline.sources import commits
from weftline.sources.scans import OUTPUT_FIELDS

SPLITS = ("success", "failed")


def layout(jsonl_path: str) -> dict[str, str]:
    """Folders for generated, right and wrong rows, from the folder and stem of the configured path."""
    folder, name = posixpath.split(jsonl_path)
    base = posixpath.join(folder, posixpath.splitext(name)[0])
    return {"generate": f"{base}/generate/tasks.jsonl", "success": f"{base}/done/success.jsonl", "failed": f"{base}/done/failed.jsonl"}


def _sparse(rows: DataFrame, *more: str) -> DataFrame:
    """Empty strings become absent, but for task_id and status."""
    kept = [F.col(n) if n in ("task_id", "status") else F.nullif(F.col(n), F.lit("")).alias(n) for n in OUTPUT_FIELDS]
    return rows.select(*kept, *more)


def append_rows(rows: DataFrame, path: str) -> int:
    """Add rows to a path, in one pass; how many there were. They count once all are written (``commits``)."""
    return commits.append(_sparse(rows).withColumn("split", F.lit("rows")), {"rows": path}, "split")["rows"]


def prepare(spark: SparkSession, paths: dict[str, str], resume: bool) -> None:
    """Start anew unless the run resumes."""
    if not resume:
        commits.restart(spark, list(paths.values()))


def append_routed(graded: DataFrame, paths: dict[str, str], correct: str = "correct") -> dict[str, int]:
    """Right and wrong rows to their files, in one pass and one commit; how many of each. A row that is neither stops the run."""
    split = F.when(F.col(correct), SPLITS[0]).when(~F.col(correct), SPLITS[1])
    routed = graded.withColumn("split", split)
    return commits.append(_sparse(routed, "split"), {n: paths[n] for n in SPLITS}, "split")


def write_export(rows: DataFrame, path: str, text_path: str | None = None, order: tuple[str, ...] = ()) -> None:
    """Write an export, and its texts alone; in the given order over part files (their names) and lines. Sorted once: where
    two files are written, both come from the kept rows."""
    made = rows.orderBy(*order).drop(*order) if order else rows
    if text_path:
        made = keep(made)
        made.select("text").write.mode("overwrite").json(text_path)
    made.write.mode("overwrite").json(path)


def summary_line(counts: dict[str, int]) -> str:
    """The run's counters on one line."""
    names = ("samples", "total_tasks", "resumed_generated", "generated_now", "answered_success", "answered_failed", "skipped_generate", "skipped_answer")
    return " ".join(f"{n}={counts.get(n, 0)}" for n in names)
