"""The exports of finished runs: training rows of both splits, finished rows, reference answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators import exports
from weftline.plans.durable import keep
from weftline.sources import scans, sinks


def system_prompt(spark: SparkSession, system: str = "", system_file: str = "") -> str:
    """The system prompt, stripped: given, or a file's content, but not both."""
    if system and system_file:
        raise ValueError("use either --system or --system-file, not both")
    if system_file:
        return spark.read.text(system_file, wholetext=True).first()[0].strip()
    return system.strip()


def training_rows(spark: SparkSession, success_path: str, failed_path: str | None, system: str = "") -> DataFrame:
    """Both splits' rows, with split_rank and line_no: success comes first, each in its file's order."""
    out = None
    for rank, (split, path) in enumerate((("success", success_path), ("failed", failed_path))):
        if path:
            made = exports.convert(scans.read_records(spark, path), split, system=system or None)
            one = made.select("task_id", "source_split", X.strip(F.col("status")).alias("source_status"), X.strip(F.col("answer_model")).alias("answer_model"), X.strip(F.col("expected_answer")).alias("expected_answer"), "user", "assistant", "text", F.lit(rank).alias("split_rank"), "line_no")
            out = one if out is None else out.unionByName(one)
    return out


def export_training(spark: SparkSession, success_path: str, failed_path: str, output: str, text_output: str, system: str = "", system_file: str = "", skip_failed: bool = False) -> dict[str, int]:
    """Write both splits' training rows and their texts alone; how many there are of each split, and in all."""
    rows = keep(training_rows(spark, success_path, None if skip_failed else failed_path, system_prompt(spark, system, system_file)))
    sinks.write_export(rows, output, text_output, ("split_rank", "line_no"))
    counts = {r["source_split"]: r["n"] for r in rows.groupBy("source_split").agg(F.count("*").alias("n")).collect()}
    counts = {split: counts.get(split, 0) for split in ("success", "failed")}
    return counts | {"total": sum(counts.values())}


def export_done(spark: SparkSession, path: str, output: str, text_output: str) -> dict[str, int]:
    """Write finished rows as user, assistant and text, and the texts alone; the lines of both files."""
    rows = scans.read_records(spark, path)
    there = rows.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in ("user", "rewritten_user", "assistant")})
    sinks.write_export(exports.done_training(there, ("line_no",)), output, text_output, ("line_no",))
    return {r["path"]: r["lines"] for r in scans.line_counts(spark, output, text_output).collect()}


def export_reference_answers(spark: SparkSession, path: str, output: str, subset_output: str, size: int = 8000, seed: int = 0) -> dict[str, int]:
    """Write the reference answers of all tasks, and a random subset of them; the lines of both files."""
    rows = keep(exports.reference_answers(scans.read_records(spark, path)))
    sinks.write_export(rows, output)
    sinks.write_export(exports.sample(rows, size, seed), subset_output)
    return {r["path"]: r["lines"] for r in scans.line_counts(spark, output, subset_output).collect()}
