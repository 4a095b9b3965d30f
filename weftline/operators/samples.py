"""Input rows to samples: user prompt, id, meta."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.strictjson import structured_prompts


def sample_id(task: Column, sample: Column, repeat: Column, attempt: Column, completions: Column, index: Column) -> Column:
    """The id from the parts that are there; all parts are scalars, blank ones null."""
    by_task = F.when(sample.isNull(), task).otherwise(F.concat_ws("_", task, sample, completions))
    by_sample = F.when(repeat.isNull() & attempt.isNull(), F.concat(F.lit("sample_"), sample)).otherwise(F.concat_ws("_", sample, repeat, attempt))
    return F.when(task.isNotNull(), by_task).when(sample.isNotNull(), by_sample).otherwise(F.format_string("sample_%06d", index))


def extract_user(context: Column, structured: Column | None = None) -> Column:
    """Single turn, else the first structured prompt that reads as one, else the whole text unescaped.

    ``structured``: prompts found in a JSON context, as a JSON array (see ``structured_prompts``).
    """
    ways = [X.single_turn(context)]
    if structured is not None:
        prompts = F.transform(F.from_json(structured, "array<string>"), lambda p: X.prompt_user(p))
        ways.append(F.try_element_at(F.filter(prompts, lambda p: p.isNotNull()), F.lit(1)))
    return F.coalesce(*ways, X.trim(X.unescape(context)))


def to_samples(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, rejects) of rows with logical_index and parsed: a blank prompt is a reject with its reason."""
    p = lambda n: F.col(f"parsed.{n}")
    context = F.coalesce(p("context"), p("text"), F.lit(""))
    ids = sample_id(p("task_id"), p("sample_index"), p("repeat_index"), p("pass_index"), p("completions_id"), F.col("logical_index"))
    looked = rows.withColumn("__context", context)
    # Only texts that could be JSON go to the parser.
    structured = F.when(F.contains("__context", F.lit("{")), structured_prompts("__context"))
    made = looked.withColumn("__structured", structured).select(
        "logical_index",
        ids.alias("sample_id"),
        X.sanitize(extract_user(F.col("__context"), F.col("__structured"))).alias("source_user"),
        p("meta").alias("source_meta"),
        X.blank_to_null(X.trim(p("ref_answer"))).alias("ref_answer"),
    )
    blank = F.col("source_user") == ""
    return made.where(~blank), made.where(blank).select("logical_index", F.lit("source user content is empty").alias("reason"))
