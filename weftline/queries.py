"""A query for each operator over derived input views, and the same in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.fixtures import fixture, with_views
from weftline.functions import strictjson
from weftline.functions import text as X
from weftline.operators import candidates, exports, grading, resume, samples
from weftline.plans import export, prompts
from weftline.plans.durable import keep, shared_folder
from weftline.sources import scans, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = with_views(sql, *views) if views else sql
        return f

    return add


# The text rules in DuckDB's SQL, written out from their definitions.
# Fixed values, written here once more: white space, separators of labels, signs that comparison drops, the expert lead.
W = r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SEP = W + r",.;:()\[\]{}，。；：（）【】"
SIGNS = r"\x{21}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7E}，。：；！？（）【】“”‘’、"
LEAD = "You are a very talented expert in "


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_trim(c: str) -> str:
    return f"regexp_replace({c}, {q(rf'\A[{W}]+|[{W}]+\z')}, '', 'g')"


def sql_unescape(c: str) -> str:
    """Each backslash with the character behind it, from the left; DuckDB has no function for it, so pairs are parted first."""
    x = "x"
    for code, char in (("n", "chr(10)"), ("r", "chr(13)"), ("t", "chr(9)"), ('"', "chr(34)"), ("/", "chr(47)")):
        x = f"replace({x}, chr(92) || '{code}', {char})"
    return f"array_to_string(list_transform(string_split({c}, chr(92) || chr(92)), lambda x: {x}), chr(92))"


def sql_norm(c: str) -> str:
    return f"lower(regexp_replace({c}, {q(f'[{W}{SIGNS}]')}, '', 'g'))"


def sql_sanitize(c: str) -> str:
    return sql_trim(f"regexp_replace({sql_trim(c)}, {q(rf'\A(?:{LEAD}[^.]*\.[{W}]*)+')}, '')")


def sql_label(c: str) -> str:
    tokens = f"list_transform(regexp_split_to_array({c}, {q(f'[{SEP}]')}), lambda x: regexp_replace(x, '^[^A-Za-z0-9]+|[^A-Za-z0-9]+$', '', 'g'))"
    first = f"list_filter({tokens}, lambda x: regexp_full_match(x, '[A-Za-z]'))[-1]"
    second = f"list_filter(regexp_extract_all({c}, '[A-Za-z]+'), lambda x: length(x) = 1)[-1]"
    return f"upper(coalesce({first}, {second}))"


def sql_last_line(c: str) -> str:
    lines = f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: {sql_trim('x')}), lambda x: x <> '')"
    return f"coalesce({lines}[-1], '')"


def sql_correct(e: str, a: str) -> str:
    return f"CASE WHEN {sql_label(e)} IS NOT NULL THEN {sql_label(a)} IS NOT DISTINCT FROM {sql_label(e)} ELSE {sql_norm(e)} = {sql_norm(sql_last_line(a))} END"


def sql_think(a: str) -> str:
    inner = sql_trim(f"regexp_extract({a}, '(?s)<think>(.*?)(?:</think>|\\z)', 1)")
    return f"CASE WHEN NOT contains({a}, '<think>') THEN '' WHEN {inner} = '' THEN '<think>' || chr(10) || '</think>' ELSE '<think>' || chr(10) || {inner} || chr(10) || '</think>' END"


@query("grade_route", f"SELECT split, count(*) AS n, CAST(sum(CASE WHEN split = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS with_text FROM (SELECT CASE WHEN {sql_correct('expected', 'assistant')} THEN 'success' ELSE 'failed' END AS split FROM fx5) GROUP BY split", "fx5")
def grade_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = grading.grade(fixture(spark, sf_dir, "fx5"), F.lit("question"))
    return graded.groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("text") != "").alias("with_text"))


@query("canonical_label", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_label('assistant')} AS label FROM fx5 UNION ALL SELECT doc_id, -1, 0, 0, {sql_label('text')} FROM documents", "fx5")
def canonical_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fixture(spark, sf_dir, "fx5").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.label(F.col("assistant")).alias("label"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = lambda n: F.lit(n).cast("long")
    return a.unionByName(docs.select(F.col("doc_id").alias("l_orderkey"), F.lit(-1).alias("l_linenumber"), number(0).alias("l_partkey"), number(0).alias("l_suppkey"), X.label(F.col("text")).alias("label")))


@query("predicted_answer", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce({sql_label('assistant')}, {sql_last_line('assistant')}) AS predicted, {sql_last_line('assistant')} AS last_line FROM fx5", "fx5")
def predicted_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("assistant")
    return fixture(spark, sf_dir, "fx5").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.predicted(F.col("expected"), a).alias("predicted"), X.last_line(a).alias("last_line"))


@query("normalize_text", f"SELECT doc_id, {sql_norm('text')} AS norm FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", X.norm(F.col("text")).alias("norm"))


@query("preview_text", f"SELECT doc_id, CASE WHEN length({sql_trim('text')}) <= 120 THEN {sql_trim('text')} ELSE substr({sql_trim('text')}, 1, 120) || '...' END AS preview FROM documents")
def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", X.preview(F.col("text"), 120).alias("preview"))


_ASKED = "trim(replace(replace(context, 'User:', 'user'), 'Assistant:', 'reply'))"
_LEAD = "CASE WHEN logical_index % 2 = 0 THEN 'You are a very talented expert in math.  ' ELSE '' END || 'You are a very talented expert in law. ' || context"


@query("sanitize_prompt", f"SELECT logical_index, {sql_sanitize('raw')} AS cleaned FROM (SELECT logical_index, {_LEAD} AS raw FROM fx1) t", "fx1")
def sanitize_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx1").select("logical_index", X.sanitize(F.expr(_LEAD)).alias("cleaned"))


_ESCAPED = "CASE WHEN logical_index % 3 = 0 THEN replace(context, chr(10), '\\n') WHEN logical_index % 3 = 1 THEN context || chr(10) || 'User: more' ELSE context END"
_SPARK_ESCAPED = _ESCAPED.replace("'\\n'", "'\\\\n'")
_ONE = f"CASE WHEN starts_with(n, chr(10) || 'User:') AND len(string_split(n, chr(10) || 'User:')) = 2 AND len(string_split(n, chr(10) || 'Assistant:')) = 2 THEN nullif({sql_trim(chr(114) + 'egexp_extract(n, ' + q('(?s)\\A\\nUser:(.*?)\\nAssistant:') + ', 1)')}, '') END"


@query("extract_user_single_turn", f"SELECT logical_index, {_ONE} AS user_text FROM (SELECT logical_index, chr(10) || {sql_trim(sql_unescape(_ESCAPED))} AS n FROM fx1) t", "fx1")
def extract_user_single_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx1").select("logical_index", X.single_turn(F.expr(_SPARK_ESCAPED)).alias("user_text"))


_MANY = f"coalesce({_ONE}, CASE WHEN starts_with(n, chr(10) || 'User:') THEN nullif({sql_trim(chr(114) + 'egexp_extract(n, ' + q('(?s)\\A\\nUser:(.*?)(?:\\nAssistant:|\\z)') + ', 1)')}, '') END)"


@query("extract_user_prompt_multi_turn", f"SELECT logical_index, {_MANY} AS prompt_user, coalesce({_ONE}, substr(n, 2)) AS extracted FROM (SELECT logical_index, chr(10) || {sql_trim(sql_unescape(_ESCAPED))} AS n FROM fx1) t", "fx1")
def extract_user_prompt_multi_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.expr(_SPARK_ESCAPED)
    return fixture(spark, sf_dir, "fx1").select("logical_index", X.prompt_user(c).alias("prompt_user"), samples.extract_user(c).alias("extracted"))


_PARTS = {"t": "CASE WHEN logical_index % 2 = 0 THEN CAST(task_id AS STRING) END", "s": "CASE WHEN logical_index % 3 <> 0 THEN CAST(sample_index AS STRING) END", "r": "CASE WHEN logical_index % 5 < 3 THEN '1' END", "p": "CASE WHEN logical_index % 7 < 4 THEN '2' END", "c": "CASE WHEN logical_index % 4 = 0 THEN 'c' || ref_answer END"}


@query("sample_id", f"""SELECT logical_index, CASE WHEN t IS NOT NULL AND s IS NOT NULL THEN concat_ws('_', t, s, c) WHEN t IS NOT NULL THEN t
    WHEN s IS NOT NULL AND (r IS NOT NULL OR p IS NOT NULL) THEN concat_ws('_', s, r, p) WHEN s IS NOT NULL THEN 'sample_' || s ELSE 'sample_' || lpad(CAST(logical_index AS STRING), 6, '0') END AS sample_id
    FROM (SELECT logical_index, {", ".join(f"{v} AS {k}" for k, v in _PARTS.items())} FROM fx1) t""", "fx1")
def sample_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fixture(spark, sf_dir, "fx1").select("logical_index", *[F.expr(v).alias(k) for k, v in _PARTS.items()])
    return parts.select("logical_index", samples.sample_id(*[F.col(c) for c in "tsrpc"], F.col("logical_index")).alias("sample_id"))


@query("meta_projection", """SELECT logical_index, '{"ref_answer":"' || ref_answer || '","sample_index":"' || sample_index || '","task_id":"' || task_id || '"}' AS meta FROM fx1""", "fx1")
def meta_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx1")
    raw = F.to_json(F.struct(F.col("task_id").cast("string").alias("task_id"), F.col("sample_index").cast("string").alias("sample_index"), "ref_answer", F.lit("dropped").alias("other")))
    return rows.select("logical_index", strictjson.parse_row(raw)["meta"].alias("meta"))


@query("input_window", "SELECT logical_index, task_id FROM (SELECT row_number() OVER (ORDER BY logical_index) - 1 AS logical_index, task_id FROM fx1 WHERE logical_index % 5 <> 2) t WHERE logical_index >= 20 AND logical_index < 70", "fx1")
def input_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx1").where("logical_index % 5 <> 2").orderBy("logical_index").drop("logical_index")
    return scans.input_window(scans.dense_index(rows), 20, 50).select("logical_index", "task_id")


_MERGED = """, merged AS (SELECT tid, arg_max(status, file_rank * 1000000000 + line_no) AS status, coalesce(arg_max(user_text, file_rank * 1000000000 + line_no) FILTER (WHERE user_text <> ''), '') AS user_text,
    coalesce(arg_max(answer, file_rank * 1000000000 + line_no) FILTER (WHERE answer <> ''), '') AS answer, coalesce(arg_max(assistant, file_rank * 1000000000 + line_no) FILTER (WHERE assistant <> ''), '') AS assistant FROM fx4 GROUP BY tid)"""
_EXPECTED = ", expected AS (SELECT task_id || '_' || sample_index AS sample_id, v AS variant_index, task_id || '_' || sample_index || '_q00' || v AS task_id FROM fx1, unnest([0, 1, 2]) AS u(v))"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.merge(fixture(spark, sf_dir, "fx4"), ["user_text", "answer", "assistant"], key="tid")


def _planned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """Samples, what earlier runs have of them, and the variants of each."""
    samples = fixture(spark, sf_dir, "fx1").select(F.concat_ws("_", "task_id", "sample_index").alias("sample_id"))
    return samples, _merged(spark, sf_dir).withColumnRenamed("tid", "task_id"), 3


@query("resume_merge", _MERGED + " SELECT * FROM merged", "fx4")
def resume_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


@query("status_counts", _MERGED + " SELECT count(*) FILTER (WHERE status = 'generated') AS generated, count(*) FILTER (WHERE status = 'done') AS done FROM merged", "fx4")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.status_counts(_merged(spark, sf_dir))


@query("resume_plan_missing", _MERGED + _EXPECTED + " SELECT task_id, sample_id, variant_index FROM expected WHERE task_id NOT IN (SELECT tid FROM merged)", "fx4")
def resume_plan_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.missing(*_planned(spark, sf_dir))


@query("resume_plan_pending", _MERGED + _EXPECTED + " SELECT task_id, sample_id, variant_index, user_text FROM expected JOIN merged ON tid = task_id WHERE status = 'generated'", "fx4")
def resume_plan_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.pending(*_planned(spark, sf_dir)).select("task_id", "sample_id", "variant_index", "user_text")


@query("resume_plan_accepted", _MERGED + _EXPECTED + " SELECT task_id, sample_id, variant_index, status FROM expected JOIN merged ON tid = task_id", "fx4")
def resume_plan_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.accepted(*_planned(spark, sf_dir)).select("task_id", "sample_id", "variant_index", "status")


@query("open_samples", _MERGED + _EXPECTED + " SELECT sample_id, count(*) AS missing FROM expected WHERE task_id NOT IN (SELECT tid FROM merged) GROUP BY sample_id", "fx4")
def open_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.open_samples(*_planned(spark, sf_dir))


_CANDIDATE = "CASE pos % 11 WHEN 0 THEN '  ' WHEN 3 THEN 'Assistant: ' || user_text WHEN 5 THEN 'Source, text!' ELSE user_text END"
_ANSWER = "CASE pos % 7 WHEN 2 THEN '' WHEN 4 THEN 'Assistant: B' ELSE answer END"


@query("local_reject_reason", f"""SELECT pos, CASE WHEN u = '' THEN '{candidates.REASONS['user_empty']}' WHEN a = '' THEN '{candidates.REASONS['answer_empty']}'
    WHEN starts_with(u, 'Assistant:') THEN '{candidates.REASONS['user_role']}' WHEN starts_with(a, 'Assistant:') THEN '{candidates.REASONS['answer_role']}'
    WHEN {sql_norm('u')} = 'sourcetext' THEN '{candidates.REASONS['identical']}' END AS reason
    FROM (SELECT pos, {sql_sanitize(_CANDIDATE)} AS u, {sql_trim(_ANSWER)} AS a FROM fx2) t""", "fx2")
def local_reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, answer = X.sanitize(F.expr(_CANDIDATE)), X.trim(F.expr(_ANSWER))
    return fixture(spark, sf_dir, "fx2").select("pos", user.alias("u"), answer.alias("a")).select("pos", candidates.reject_reason(F.col("u"), F.col("a"), F.lit("source text")).alias("reason"))


def sql_option(t: str, one: str) -> str:
    e = f"regexp_extract(' ' || regexp_replace({t}, {q(f'([{W}:：])')}, '\\1\\1', 'g'), {q(f'(?s)^.*?[{W}:：][{one}{one.lower()}]\\.([{W}].*)$')}, 1)"
    return f"regexp_replace({e}, {q(f'(?s)[{W}:：][A-Da-d]\\.[{W}].*$')}, '')"


_OPTION = "CASE letter " + " ".join(f"WHEN '{o}' THEN {sql_option('user_text', o)}" for o in "ABCD") + " END"


@query("option_text", f"SELECT sample_key, letter, {sql_norm(_OPTION)} AS option_norm FROM fx3, unnest(['A', 'B', 'C', 'D']) AS u(letter)", "fx3")
def option_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = fixture(spark, sf_dir, "fx3").select("sample_key", "user_text", F.explode(F.array(*map(F.lit, "ABCD"))).alias("letter"))
    return each.select("sample_key", "letter", X.norm(X.option_text(F.col("user_text"), F.col("letter"))).alias("option_norm"))


_CHANGED = "CASE WHEN sample_key % 2 = 0 THEN replace(user_text, 'B. ', 'B. x') ELSE user_text END"


@query("ref_answer_reuse", f"SELECT sample_key, {sql_norm(sql_option('user_text', 'B'))} = {sql_norm(sql_option(_CHANGED, 'B'))} AS same_letter, false AS other_letter, false AS no_reference FROM fx3", "fx3")
def ref_answer_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    reuse = lambda answer, reference: X.reuses_reference(F.col("user_text"), F.expr(_CHANGED), F.lit(answer), F.lit(reference))
    return fixture(spark, sf_dir, "fx3").select("sample_key", reuse(" b.", "B.").alias("same_letter"), reuse("A", "B").alias("other_letter"), reuse("B", " ").alias("no_reference"))


_DEDUP = f", marked AS (SELECT sample_id, pos, {sql_norm('user_text')} AS norm, answer FROM fx2), ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id, norm ORDER BY pos) > 1 OR norm IN (SELECT norm FROM marked m WHERE m.sample_id = marked.sample_id AND m.pos % 9 = 4) AS is_duplicate FROM marked)"


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx2")
    taken = rows.where("pos % 9 = 4").select("sample_id", X.norm(F.col("user_text")).alias("norm"))
    return candidates.dedup(rows, "sample_id", "pos", "user_text", taken)


@query("dedup_candidates", _DEDUP + " SELECT sample_id, pos, is_duplicate FROM ranked", "fx2")
def dedup_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(spark, sf_dir).select("sample_id", "pos", "is_duplicate")


@query("allocate_variants", _DEDUP + """, survivors AS (SELECT sample_id, pos, row_number() OVER (PARTITION BY sample_id ORDER BY pos) AS k FROM ranked WHERE NOT is_duplicate),
    missing AS (SELECT sample_id, v AS variant_index, row_number() OVER (PARTITION BY sample_id ORDER BY v) AS k FROM (SELECT DISTINCT sample_id FROM fx2) s, unnest(range(0, 24, 2)) AS u(v))
    SELECT s.sample_id, pos, CAST(variant_index AS INTEGER) AS variant_index FROM survivors s JOIN missing m ON s.sample_id = m.sample_id AND s.k = m.k""", "fx2")
def allocate_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _deduped(spark, sf_dir)
    missing = fixture(spark, sf_dir, "fx2").select("sample_id").distinct().select("sample_id", F.explode(F.sequence(F.lit(0), F.lit(22), F.lit(2))).alias("variant_index"))
    return candidates.allocate(found.where("not is_duplicate"), missing).select("sample_id", "pos", "variant_index")


@query("feedback_message_all", f""", reasons AS (SELECT sample_id, pos % 3 AS stage, pos, '#' || pos || ' rejected' AS reason FROM fx2),
    r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY stage, pos) AS k FROM reasons)
    SELECT sample_id, '{candidates.FEEDBACK_LEAD}' || string_agg(reason, '{candidates.FEEDBACK_JOIN}' ORDER BY k) FILTER (WHERE k <= 8) AS feedback, count(*) AS rejected FROM r GROUP BY sample_id""", "fx2")
def feedback_message_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reason for every row of fx2."""
    reasons = fixture(spark, sf_dir, "fx2").select("sample_id", (F.col("pos") % 3).alias("stage"), "pos", F.concat(F.lit("#"), F.col("pos").cast("string"), F.lit(" rejected")).alias("reason"))
    return candidates.feedback(reasons, "sample_id")


@query("validator_permutation_check_all", """, v AS (SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS n FROM fx2),
    w AS (SELECT sample_id, n, CASE WHEN substr(sample_id, 4) IN ('1', '5') AND i = 0 THEN n WHEN substr(sample_id, 4) IN ('2', '7') AND i = 0 AND n > 1 THEN 1 ELSE i END AS i FROM v)
    SELECT sample_id, any_value(n) AS n, CASE WHEN max(i) >= any_value(n) THEN 'validator returned out-of-range item index' WHEN count(DISTINCT i) < count(*) THEN 'validator returned duplicate item index' END AS fault FROM w GROUP BY sample_id""", "fx2")
def validator_permutation_check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every row of fx2."""
    at = candidates.ranked_wide(fixture(spark, sf_dir, "fx2").select("sample_id", "pos"), "sample_id", "pos", "i").withColumn("i", F.col("i") - 1)
    sizes = at.groupBy("sample_id").agg(F.count("*").alias("n"))
    key = F.substring("sample_id", 4, 10)
    wrong = F.when(key.isin("1", "5") & (F.col("i") == 0), F.col("n")).when(key.isin("2", "7") & (F.col("i") == 0) & (F.col("n") > 1), 1).otherwise(F.col("i"))
    return candidates.verdict_faults(at.join(sizes, "sample_id").select("sample_id", wrong.alias("index")), sizes, "sample_id")


@query("run_summary", f"SELECT count(*) FILTER (WHERE NOT s AND c) AS success, count(*) FILTER (WHERE NOT s AND NOT c) AS failed, count(*) FILTER (WHERE s) AS skipped FROM (SELECT {sql_correct('expected', 'assistant')} AS c, l_partkey % 10 = 0 AS s FROM fx5) t", "fx5")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grading.answer_stats(grading.grade(fixture(spark, sf_dir, "fx5")), F.col("l_partkey") % 10 == 0)


def _export_sql(split: str) -> str:
    a, e = sql_trim("assistant"), "expected_answer"
    made = f"CASE WHEN {a} <> '' THEN {a} ELSE {e} END" if split == "success" else f"CASE WHEN {sql_think(a)} <> '' THEN {sql_think(a)} || chr(10) || chr(10) || {e} ELSE {e} END"
    return f"""SELECT tid AS task_id, '{split}' AS source_split, expected_answer, {sql_trim('user_text')} AS "user", {made} AS assistant,
        'User: ' || {sql_trim('user_text')} || chr(10) || chr(10) || 'Assistant: ' || {made} AS text
        FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY line_no) AS k FROM fx6 WHERE split = '{split}') t WHERE (tid = '' OR k = 1) AND {sql_trim('user_text')} <> ''"""


def _export(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx6").where(F.col("split") == split).withColumnsRenamed({"tid": "task_id", "user_text": "user"})
    return exports.convert(rows, split).select("task_id", "source_split", "expected_answer", "user", "assistant", "text")


@query("export_success", " " + _export_sql("success"), "fx6")
def export_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir, "success")


@query("export_failed", " " + _export_sql("failed"), "fx6")
def export_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir, "failed")


@query("export_union", f" SELECT source_split, count(*) AS n, count(DISTINCT task_id) AS ids FROM ({_export_sql('success')} UNION ALL {_export_sql('failed')}) t GROUP BY source_split", "fx6")
def export_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _export(spark, sf_dir, "success").unionByName(_export(spark, sf_dir, "failed"))
    return both.groupBy("source_split").agg(F.count("*").alias("n"), F.count_distinct("task_id").alias("ids"))


@query("export_done", """ SELECT user_text AS "user", assistant, 'User: ' || coalesce(user_text, 'null') || chr(10) || 'Assistant: ' || assistant AS text FROM fx6 WHERE split = 'success'""", "fx6")
def export_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "fx6").withColumn("status", F.when(F.col("split") == "success", "done").otherwise("generated"))
    odd = F.col("line_no") % 2 == 1
    return exports.done_training(rows.select("status", "assistant", F.when(odd, F.col("user_text")).alias("user"), F.when(~odd, F.col("user_text")).alias("rewritten_user")))


_REFERENCE = r""" SELECT task_id, trim_user AS "user", ref AS assistant, 'User: ' || trim_user || chr(10) || 'Assistant: ' || ref AS text FROM (SELECT tid AS task_id, arg_max(user_text, line_no) AS u, regexp_replace(regexp_replace(u, '\A\s+', ''), '\s+\z', '') AS trim_user, arg_max(expected_answer || CASE WHEN line_no % 6 = 0 THEN 'x' ELSE '' END, line_no) AS ref FROM fx6 GROUP BY tid) t WHERE u <> '' AND regexp_full_match(ref, '[ABCD]')"""


@query("export_ref_answer", _REFERENCE, "fx6")
def export_ref_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.concat("expected_answer", F.when(F.col("line_no") % 6 == 0, "x").otherwise(""))
    return exports.reference_answers(fixture(spark, sf_dir, "fx6").select(F.col("tid").alias("task_id"), F.col("user_text").alias("user"), ref.alias("ref_answer"), "line_no"))


@query("export_ref_sample", f""" SELECT * FROM ({_REFERENCE}) t QUALIFY row_number() OVER (ORDER BY md5('7:' || task_id)) <= 150""", "fx6")
def export_ref_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded random subset of the reference answers."""
    return exports.sample(export_ref_answer(spark, sf_dir), 150, seed=7)


@query("merge_output", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 3 = 0 THEN {sql_trim('assistant')} WHEN l_suppkey % 3 = 1 THEN '<think>' || chr(10) || expected || chr(10) || '</think>' ELSE '<think>' || chr(10) || expected || chr(10) || '</think>' || chr(10) || chr(10) || {sql_trim('assistant')} END AS merged FROM fx5", "fx5")
def merge_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("l_suppkey") % 3
    merged = X.merged_output(F.when(kind != 0, F.concat(F.lit(" "), "expected")), F.when(kind != 1, F.col("assistant")).otherwise("  "))
    return fixture(spark, sf_dir, "fx5").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", merged.alias("merged"))


@query("answer_prompt", f"SELECT pos, md5(user_text || {q(prompts.ANSWER_RULES)}) AS prompt_md5 FROM fx2", "fx2")
def answer_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx2").select("pos", F.md5(prompts.answer_prompt(F.col("user_text")).cast("binary")).alias("prompt_md5"))


_PROFILE = prompts.load_profile()


_USERS = "list_filter([context, 'v' || sample_index, ref_answer], lambda x, i: i <= logical_index % 4)"
_ACCEPTED = f"""CASE WHEN logical_index % 4 = 0 THEN '[]' ELSE '[' || chr(10) || array_to_string(list_transform({_USERS}, lambda x: '  {{' || chr(10) || '    "user": ' || to_json(x) || chr(10) || '  }}'), ',' || chr(10)) || chr(10) || ']' END"""


@query("generation_prompt", f"""SELECT logical_index, replace(replace(replace(replace(replace({q(_PROFILE.generation)}, '{{{{profile_name}}}}', '{_PROFILE.name}'), '{{{{variant_count}}}}', '3'),
    '{{{{source_sample_json}}}}', '{{' || chr(10) || '  "meta": {{}},' || chr(10) || '  "sample_id": "' || task_id || '",' || chr(10) || '  "user": ' || to_json(context) || chr(10) || '}}'), '{{{{accepted_samples_json}}}}', {_ACCEPTED}),
    '{{{{feedback_block}}}}', CASE WHEN logical_index % 2 = 0 THEN {q(prompts.FEEDBACK_BEFORE)} || 'why' || {q(prompts.FEEDBACK_AFTER)} ELSE '' END) AS prompt FROM fx1""", "fx1")
def generation_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = prompts.source_json(F.col("task_id").cast("string"), F.col("context"), F.lit("{}"))
    why = F.when(F.col("logical_index") % 2 == 0, "why")
    users = F.slice(F.array("context", F.concat(F.lit("v"), F.col("sample_index").cast("string")), "ref_answer"), 1, (F.col("logical_index") % 4).cast("int"))
    made = prompts.generation_prompt(_PROFILE, F.lit(3), source, prompts.accepted_json(users), why)
    return fixture(spark, sf_dir, "fx1").select("logical_index", made.alias("prompt"))


@query("json_extract", """SELECT pos, CASE pos % 4 WHEN 0 THEN user_text WHEN 1 THEN 'a {brace ' || user_text END AS "user", CASE pos % 4 WHEN 0 THEN 'null' WHEN 1 THEN '{"k":1.0,"t":' || to_json(sample_id) || '}' END AS meta, pos % 4 > 1 AS failed FROM fx2""", "fx2")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with the row's text inside a fence, as plain JSON with a brace in a string, with a number for an answer, and with no JSON."""
    text, kind = F.col("user_text"), F.col("pos") % 4
    said = F.when(kind == 0, F.concat(F.lit('Sure: ```json {"items":[{"user":'), prompts.quoted(text), F.lit(',"answer":"A"}]} ``` done')))
    said = said.when(kind == 1, F.concat(F.lit('{"items":[{"user":'), prompts.quoted(F.concat(F.lit("a {brace "), text)), F.lit(',"answer":"B","meta":{"t":'), prompts.quoted(F.col("sample_id")), F.lit(',"k":1.0}}]}')))
    said = said.when(kind == 2, F.concat(F.lit('{"items":[{"user":'), prompts.quoted(text), F.lit(',"answer":3}]}'))).otherwise(F.replace(text, F.lit("{"), F.lit("(")))
    read = fixture(spark, sf_dir, "fx2").select("pos", strictjson.parse_items(said).alias("p"))
    first = F.try_element_at("p.items", F.lit(1))
    return read.select("pos", first["user"].alias("user"), first["meta"].alias("meta"), F.col("p.error").isNotNull().alias("failed"))


#: What the recorded validator does with a sample's first variant; any other kind is valid.
REFUSED, OUT_OF_RANGE, UNREADABLE = 0, 1, 2
_KIND = "CAST(('0x' || substr(md5(sample_id), 1, 4)) AS BIGINT) % 6 AS kind"
_SAMPLED = f", sampled AS (SELECT sample_id, {_KIND} FROM (SELECT task_id || '_' || sample_index AS sample_id FROM fx1) t)"


def recorded_kind(sample_id: Column) -> Column:
    return F.conv(F.substring(F.md5(sample_id.cast("binary")), 1, 4), 16, 10).cast("long") % 6


def _recorded_rounds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Three rounds over recorded responses and verdicts: a duplicate in the first, what is still missing in the others.

    The validator refuses some samples' first variant, and stops others by a faulty or an unreadable verdict.
    """
    from weftline.plans.rounds import Rounds, run_rounds

    rows = fixture(spark, sf_dir, "fx1")
    sampled = rows.select(F.concat_ws("_", "task_id", "sample_index").alias("sample_id"), F.col("context").alias("source_user"), F.lit("{}").alias("source_meta"), F.lit(None).cast("string").alias("ref_answer"))
    missing = resume.expected_tasks(sampled, 2).select("sample_id", "variant_index")
    item = lambda user: F.concat(F.lit('{"user":"'), user, F.lit('","answer":"A"}'))
    again = F.contains("prompt", F.lit("duplicate variant"))
    one, two = F.concat(F.lit("first "), "sample_id"), F.concat(F.lit("second "), "sample_id")
    content = F.concat(F.lit('{"items":['), F.when(again, item(two)).otherwise(F.concat(item(one), F.lit(","), item(one))), F.lit("]}"))
    answer = lambda requests: requests.withColumn("content", content).withColumn("error", F.lit(None).cast("string"))
    first, kind = F.contains("prompt", one), recorded_kind(F.col("sample_id"))
    valid = F.when(first & (kind == REFUSED), "false").otherwise("true")
    offset = F.when(first & (kind == OUT_OF_RANGE), F.col("n")).otherwise(0)
    verdict = lambda i: F.concat(F.lit('{"index":'), (i + offset).cast("string"), F.lit(',"valid":'), valid, F.lit(',"reason":"too close"}'))
    verdicts = F.concat(F.lit('{"items":['), F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), verdict), ","), F.lit("]}"))
    judged = F.when(first & (kind == UNREADABLE), "no verdict").otherwise(verdicts)
    validate = lambda requests: requests.withColumn("content", judged).withColumn("error", F.lit(None).cast("string"))
    return run_rounds(sampled, missing, missing.limit(0).withColumn("user", F.lit("")), Rounds(_PROFILE, answer, validate, 3))


@query("generate_round_replay", f"""{_SAMPLED}, users AS (SELECT sample_id, unnest(CASE WHEN kind = {REFUSED} THEN ['second'] ELSE ['first', 'second'] END) AS u, unnest(CASE WHEN kind = {REFUSED} THEN [0] ELSE [0, 1] END) AS v
    FROM sampled WHERE kind NOT IN ({OUT_OF_RANGE}, {UNREADABLE})) SELECT sample_id, sample_id || '_q00' || v AS task_id, u || ' ' || sample_id AS "user", 'A' AS expected_answer FROM users""", "fx1")
def generate_round_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded_rounds(spark, sf_dir)[0].select("sample_id", "task_id", "user", "expected_answer")


@query("generate_round_outcomes", f"""{_SAMPLED} SELECT sample_id, CAST(2 AS BIGINT) AS wanted, CAST(CASE WHEN kind IN ({OUT_OF_RANGE}, {UNREADABLE}) THEN 0 WHEN kind = {REFUSED} THEN 1 ELSE 2 END AS BIGINT) AS got,
    CAST(CASE WHEN kind IN ({OUT_OF_RANGE}, {UNREADABLE}) THEN 0 WHEN kind = {REFUSED} THEN 4 ELSE 1 END AS BIGINT) AS rejected,
    CASE kind WHEN {OUT_OF_RANGE} THEN 'validator returned out-of-range item index' WHEN {UNREADABLE} THEN 'unreadable' END AS error, kind > {UNREADABLE} AS completed FROM sampled""", "fx1")
def generate_round_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each sample: what it wanted and got, how many candidates fell, what stopped it."""
    found = _recorded_rounds(spark, sf_dir)[1]
    error = F.when(F.contains("error", F.lit("valid JSON")), "unreadable").otherwise(F.col("error"))
    return found.select("sample_id", "wanted", "got", "rejected", error.alias("error"), "completed")


_SAID = "CAST(('0x' || substr(md5(sample_id || '_q00' || v), 1, 4)) AS BIGINT) % 4"
_COUNTED = f""", asked AS (SELECT sample_id, v, {_SAID} AS said, {_KIND} FROM (SELECT task_id || '_' || sample_index AS sample_id FROM fx1 WHERE logical_index % 7 <> 3) s, unnest([0, 1]) AS u(v)),
    sizes AS (SELECT count(DISTINCT sample_id) AS samples, count(*) AS tasks, count(DISTINCT sample_id) FILTER (WHERE kind = 5) AS refused, count(*) FILTER (WHERE kind <> 5) AS made,
        count(*) FILTER (WHERE kind <> 5 AND said = 0) AS blank, count(*) FILTER (WHERE kind <> 5 AND said = 1) AS wrong, count(*) FILTER (WHERE kind <> 5 AND said > 1) AS good FROM asked)"""


@query("synthesize_counters", _COUNTED + """, runs AS (
        SELECT 1 AS run, samples, tasks AS total_tasks, 0 AS resumed_generated, made AS generated_now, 0 AS answered_success, 0 AS answered_failed, refused AS skipped_generate, made AS skipped_answer FROM sizes
        UNION ALL SELECT 2, samples, tasks, made, 0, good, wrong, refused, blank FROM sizes
        UNION ALL SELECT 3, samples, tasks, blank, 0, 0, 0, refused, blank FROM sizes
        UNION ALL SELECT 4, 0, 0, 0, 0, 0, 0, 0, 0)
    SELECT run, counter, CAST(value AS BIGINT) AS value FROM (UNPIVOT runs ON samples, total_tasks, resumed_generated, generated_now, answered_success, answered_failed, skipped_generate, skipped_answer INTO NAME counter VALUE value) t""", "fx1")
def synthesize_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run three times over files: generation with answers off, a resume that answers, another that has only what
    was blank left, a window without rows; samples whose call fails every time, invalid lines between. The counters of each run."""
    from weftline.plans import config as configuration
    from weftline.plans.synthesize import synthesize

    folder = _scratch(spark, "synthesize")
    line = F.to_json(F.struct(F.col("task_id").cast("string").alias("task_id"), F.col("sample_index").cast("string").alias("sample_index"), "context"))
    rows = fixture(spark, sf_dir, "fx1").orderBy("logical_index").select(F.when(F.col("logical_index") % 7 == 3, "no json").otherwise(line).alias("value"))
    rows.write.text(f"{folder}/in")
    model = 'endpoint = "e"\nmodel_name = "m"\napi_key = "k"\n'
    text = f"""[input]\ndataset_path = "{folder}/in"\n[generator]\n{model}variant_count = 2\nvalidate_generated_questions = false\n[output]\njsonl_path = "{folder}/out/train.jsonl"\n[[answer_models]]\n{model}"""
    none = F.lit(None).cast("string")
    item = lambda n: F.concat(F.lit(f'{{"user":"{n} '), "sample_id", F.lit('","answer":"B"}'))
    fails = recorded_kind(F.col("sample_id")) == 5
    both = F.concat(F.lit('{"items":['), item("one"), F.lit(","), item("two"), F.lit("]}"))
    generate = lambda r: r.withColumns({"content": F.when(~fails, both), "error": F.when(fails, "no call")})
    said = F.conv(F.substring(F.md5(F.col("task_id").cast("binary")), 1, 4), 16, 10).cast("long") % 4
    content = F.when(said == 0, " ").when(said == 1, "it is A").otherwise("it is B")
    ask = lambda r: r.withColumns({"content": content, "reasoning": none, "error": none})
    found = []
    for run, answers in ((1, False), (2, True), (3, True)):
        config = configuration.parse(f"{text}\n[run]\nanswer_generated = {str(answers).lower()}\n")
        found += [(run, name, n) for name, n in synthesize(spark, config, generate, None, ask).items()]
    config.start_index = 1 << 40
    found += [(4, name, n) for name, n in synthesize(spark, config, generate, None, ask).items()]
    return spark.createDataFrame(found, "run int, counter string, value long")


@query("model_pick", "SELECT tid, CAST(CAST(('0x' || substr(md5(tid), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS model FROM fx4", "fx4")
def model_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx4").select("tid", grading.pick_model(F.col("tid"), 3).alias("model"))


@query("chat_bodies", f"""SELECT pos, CASE WHEN pos % 3 = 2 THEN NULL ELSE {sql_trim("user_text || ' c'")} END AS content, CASE pos % 3 WHEN 0 THEN sample_id END AS reasoning, pos % 3 = 2 AS failed FROM fx2""", "fx2")
def chat_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response bodies with the row's text: whole ones, event streams that part it in two, and bodies without a choice."""
    from weftline.streaming.model_calls import recorded_bodies

    text, kind = F.concat("user_text", F.lit(" c")), F.col("pos") % 3
    chunk = lambda c: F.concat(F.lit('data: {"choices":[{"delta":{"content":'), prompts.quoted(c), F.lit("}}]}"))
    body = F.when(kind == 0, F.concat(F.lit('{"choices":[{"message":{"content":'), prompts.quoted(text), F.lit(',"reasoning":'), prompts.quoted(F.col("sample_id")), F.lit("}}]}")))
    body = body.when(kind == 1, F.concat_ws("\n", chunk(F.substring(text, 1, 40)), chunk(F.expr("substring(concat(user_text, ' c'), 41)")), F.lit("data: [DONE]"), F.lit("data: after"))).otherwise(F.concat(F.lit('{"choices":[],"text":'), prompts.quoted(text), F.lit("}")))
    made = fixture(spark, sf_dir, "fx2").select("pos", body.alias("body"), (kind == 1).alias("streamed"))
    return recorded_bodies(made).select("pos", "content", "reasoning", F.col("error").isNotNull().alias("failed"))


@query("structured_context", f"""SELECT logical_index, CASE WHEN logical_index % 3 < 2 THEN {sql_trim(_ASKED)} ELSE {sql_trim(sql_unescape(f"""('{{"other": ' || to_json({_ASKED}) || '}}')"""))} END AS user_text FROM fx1""", "fx1")
def structured_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of contexts that are JSON with a prompt, with stages, or with neither; each with the row's own text."""
    asked, kind = F.expr(_ASKED), F.col("logical_index") % 3
    turn = prompts.quoted(F.concat(F.lit("User: "), asked, F.lit("\n\nAssistant: a")))
    staged = F.concat(F.lit('{"stages": [{"prompt": "Assistant: no"}, {"x": 1}, {"prompt": '), turn, F.lit('}, {"prompt": "User: later"}]}'))
    context = F.when(kind == 0, F.concat(F.lit('{"prompt": '), turn, F.lit("}"))).when(kind == 1, staged).otherwise(F.concat(F.lit('{"other": '), prompts.quoted(asked), F.lit("}")))
    rows = fixture(spark, sf_dir, "fx1").select("logical_index", context.alias("context"))
    return rows.select("logical_index", samples.extract_user(F.col("context"), strictjson.structured_prompts("context")).alias("user_text"))


_CANDIDATES = """'[' || chr(10) || '  {' || chr(10) || '    "answer": "' || ref_answer || '",' || chr(10) || '    "index": 0,' || chr(10) || '    "meta": null,' || chr(10) || '    "user": ' || to_json(context) || chr(10) || '  }' || chr(10) || ']'"""


@query("validation_prompt", f"""SELECT logical_index, replace(replace(replace({q(_PROFILE.validation)}, '{{{{profile_name}}}}', '{_PROFILE.name}'),
    '{{{{source_sample_json}}}}', '{{' || chr(10) || '  "meta": {{}},' || chr(10) || '  "sample_id": "' || task_id || '",' || chr(10) || '  "user": "u' || sample_index || '"' || chr(10) || '}}'),
    '{{{{generated_candidates_json}}}}', {_CANDIDATES}) AS prompt FROM fx1""", "fx1")
def validation_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = prompts.source_json(F.col("task_id").cast("string"), F.concat(F.lit("u"), F.col("sample_index").cast("string")), F.lit("{}"))
    item = F.struct(F.lit(0).alias("index"), F.col("context").alias("user"), F.col("ref_answer").alias("answer"), F.lit(None).cast("string").alias("meta"))
    return fixture(spark, sf_dir, "fx1").select("logical_index", prompts.validation_prompt(_PROFILE, source, prompts.candidates_json(F.array(item))).alias("prompt"))


@query("training_text", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'User: ' || expected || chr(10) || 'Assistant: ' || {sql_trim('assistant')} AS text FROM fx5", "fx5")
def training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = X.training_text(F.concat(F.lit(" \n"), "expected", F.lit("\t")), F.col("assistant"))
    return fixture(spark, sf_dir, "fx5").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", made.alias("text"))


@query("answered_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM fx5 WHERE l_suppkey % 5 NOT IN (0, 3)", "fx5")
def answered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose model gave anything: blank outputs are left out."""
    said = F.expr("CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 3 THEN ' ' || chr(10) ELSE assistant END")
    return grading.answered(fixture(spark, sf_dir, "fx5").withColumn("assistant", said)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/queries/{name}-{uuid.uuid4().hex}"


@query("read_input_lines", "SELECT logical_index, task_id FROM (SELECT row_number() OVER (ORDER BY logical_index) - 1 AS logical_index, CAST(task_id AS VARCHAR) AS task_id FROM fx1 WHERE logical_index % 6 <> 5) t WHERE logical_index >= 3", "fx1")
def read_input_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of JSON lines, written in order with blank and broken lines between, then read from the fourth row on."""
    line = F.when(F.col("logical_index") % 6 == 5, "no json").otherwise(F.to_json(F.struct(F.col("task_id").cast("string").alias("task_id"), "context")))
    rows = fixture(spark, sf_dir, "fx1").orderBy("logical_index").select(F.when(F.col("logical_index") % 4 == 1, F.concat(F.lit("\n \n"), line)).otherwise(line).alias("value"))
    rows.write.text(path := _scratch(spark, "lines"))
    return scans.read_rows(spark, path, start=3)[0].select("logical_index", F.col("parsed.task_id").alias("task_id"))


@query("input_samples", f"""SELECT logical_index, CASE WHEN logical_index % 4 <> 3 THEN CASE WHEN logical_index % 2 = 0 THEN task_id || '_' || sample_index ELSE 'sample_' || lpad(CAST(logical_index AS VARCHAR), 6, '0') END END AS sample_id,
    CASE WHEN logical_index % 4 <> 3 THEN {sql_sanitize(sql_trim(sql_unescape(_ASKED)))} END AS source_user,
    CASE WHEN logical_index % 4 <> 3 THEN CASE WHEN logical_index % 2 = 0 THEN '{{"sample_index":' || sample_index || ',"source":' || to_json(ref_answer) || ',"task_id":"' || task_id || '"}}' ELSE '{{"source":' || to_json(ref_answer) || '}}' END END AS source_meta,
    CASE WHEN logical_index % 4 = 3 THEN 'source user content is empty' END AS reason FROM fx1""", "fx1")
def input_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of input files whose rows have a context, a text, a blank context and a text, or neither: those are rejects."""
    asked, kind = F.expr(_ASKED), F.col("logical_index") % 4
    row = F.struct(
        F.when(kind == 0, asked).when(kind == 2, " ").alias("context"),
        F.when((kind == 1) | (kind == 2), asked).alias("text"),
        F.when(kind % 2 == 0, F.col("task_id").cast("string")).alias("task_id"),
        F.when(kind % 2 == 0, F.col("sample_index")).alias("sample_index"),
        F.col("ref_answer").alias("source"),
        F.lit("dropped").alias("other"),
    )
    rows = fixture(spark, sf_dir, "fx1").orderBy("logical_index").select(F.to_json(row).alias("value"))
    rows.write.text(path := _scratch(spark, "samples"))
    made, rejects = samples.to_samples(scans.read_rows(spark, path)[0])
    none = lambda n: F.lit(None).cast("string").alias(n)
    return made.select("logical_index", "sample_id", "source_user", "source_meta", none("reason")).unionByName(rejects.select("logical_index", none("sample_id"), none("source_user"), none("source_meta"), "reason"))


@query("read_input_report", """SELECT row_number() OVER (ORDER BY logical_index) AS line_number, 'no json ' || replace(context, chr(10), ' ') AS raw FROM fx1 QUALIFY logical_index % 6 = 5""", "fx1")
def read_input_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of input files that is no JSON, by its number among the lines that are not blank."""
    line = F.when(F.col("logical_index") % 6 == 5, F.concat(F.lit("no json "), F.replace("context", F.lit("\n"), F.lit(" ")))).otherwise(F.to_json(F.struct("context")))
    rows = fixture(spark, sf_dir, "fx1").orderBy("logical_index").select(F.when(F.col("logical_index") % 4 == 1, F.concat(F.lit("\n \n"), line)).otherwise(line).alias("value"))
    rows.write.text(path := _scratch(spark, "report"))
    lines, index = scans.indexed_lines(spark, path)
    return scans.invalid_lines(lines, index).select("line_number", "raw")


def _as_arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of a partition as one array."""
    begun = False
    for batch in batches:
        if len(batch):
            yield pd.DataFrame({"value": [("," if begun or i else " [") + v for i, v in enumerate(batch["value"])]})
            begun = True
    if begun:
        yield pd.DataFrame({"value": ["] , what follows"]})


@query("read_input_array", "SELECT logical_index, CAST(task_id AS VARCHAR) AS task_id, context FROM fx1", "fx1")
def read_input_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are JSON arrays, read in splits and numbered in the order of files."""
    item = F.to_json(F.struct(F.col("task_id").cast("string").alias("task_id"), "context"))
    rows = fixture(spark, sf_dir, "fx1").select("logical_index", item.alias("value")).orderBy("logical_index").select("value")
    rows.mapInPandas(_as_arrays, "value string").write.text(path := _scratch(spark, "array"))
    return scans.read_rows(spark, path)[0].select("logical_index", F.col("parsed.task_id").alias("task_id"), F.col("parsed.context").alias("context"))


@query("resume_files", _MERGED + """ SELECT tid AS task_id, status, user_text AS "user", assistant FROM merged""", "fx4")
def resume_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an earlier run in its three files, in two appends each, read in their order and merged."""
    paths = sinks.layout(f"{_scratch(spark, 'run')}/train.jsonl")
    blank = [F.lit("").alias(n) for n in ("answer_model", "text")]
    rows = fixture(spark, sf_dir, "fx4").select(F.col("tid").alias("task_id"), "status", F.col("user_text").alias("user"), F.col("answer").alias("generated_item_json"), "assistant", *blank, "file_rank", "line_no")
    sinks.prepare(spark, paths, resume=False)
    middle = rows.agg(F.expr("percentile_approx(line_no, 0.5)")).first()[0] or 0
    for half in (F.col("line_no") <= middle, F.col("line_no") > middle):
        for rank, path in enumerate(paths.values()):
            sinks.append_rows(rows.where(half & (F.col("file_rank") == rank)).orderBy("line_no"), path)
    return resume.merge(scans.read_output(spark, list(paths.values())), ["user", "assistant"])


@query("resume_snapshot", _MERGED + """ SELECT tid AS task_id, status, user_text AS "user", assistant FROM merged""", "fx4")
def resume_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an earlier run, a third of them in a snapshot, a third in one that was made from that, the rest as appended since."""
    from weftline.plans import resumelog

    paths = sinks.layout(f"{_scratch(spark, 'log')}/train.jsonl")
    blank = [F.lit("").alias(n) for n in ("answer_model", "text")]
    rows = fixture(spark, sf_dir, "fx4").select(F.col("tid").alias("task_id"), "status", F.col("user_text").alias("user"), F.col("answer").alias("generated_item_json"), "assistant", *blank, "file_rank", "line_no")
    low, high = rows.agg(F.expr("percentile_approx(line_no, array(0.33, 0.66))")).first()[0] or (0, 0)
    for part in (F.col("line_no") <= low, (F.col("line_no") > low) & (F.col("line_no") <= high), F.col("line_no") > high):
        for rank, path in enumerate(paths.values()):
            sinks.append_rows(rows.where(part & (F.col("file_rank") == rank)).orderBy("line_no"), path)
        if len(resumelog.snapshots(spark, paths)) < 2:
            resumelog.compact(spark, paths)
    return resume.merge(resumelog.read_log(spark, paths)[0], ["user", "assistant"])


@query("routed_files", f"SELECT CASE WHEN c THEN 1 ELSE 2 END AS file_rank, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT {sql_correct('expected', 'assistant')} AS c, l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS id FROM fx5) t GROUP BY 1", "fx5")
def routed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded answers, written to the files of right and wrong ones and read again."""
    paths = sinks.layout(f"{_scratch(spark, 'routed')}/train.jsonl")
    graded = keep(grading.grade(fixture(spark, sf_dir, "fx5")))
    names = [F.concat_ws("_", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("task_id"), F.lit("done").alias("status"), "assistant"]
    sinks.append_routed(graded.select(*names, *[F.lit("").alias(n) for n in ("user", "generated_item_json", "answer_model", "text")], "correct"), paths)
    back = scans.read_output(spark, list(paths.values()))
    return back.groupBy("file_rank").agg(F.count("*").alias("n"), F.count_distinct("task_id").alias("ids"))


def _training_files(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    """Both splits' files of finished rows to one training file; (place, task_id, source_split, text_md5) as its lines have it."""
    folder = _scratch(spark, "export")
    item = F.to_json(F.struct(F.col("expected_answer").alias("answer")))
    rows = fixture(spark, sf_dir, "fx6").select(F.struct(F.col("tid").alias("task_id"), F.col("user_text").alias("user"), "assistant", item.alias("generated_item_json")).alias("r"), "split", "line_no")
    for split in ("success", "failed"):
        rows.where(F.col("split") == split).orderBy("line_no").select("r.*").write.json(f"{folder}/{split}")
    if "system_text" in how:
        spark.createDataFrame([(how.pop("system_text"),)], "value string").write.text(f"{folder}/system")
        how["system_file"] = f"{folder}/system"
    export.export_training(spark, f"{folder}/success", f"{folder}/failed", f"{folder}/out", f"{folder}/texts", **how)
    return _numbered(spark, f"{folder}/out", "task_id string, source_split string, text string").select("place", "task_id", "source_split", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Fields of written JSON lines and their ``place`` in the file's order."""
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.struct(*scans.file_place()).alias("place"))
    return scans.ordered_lines(lines).select(F.col("logical_index").alias("place"), F.from_json("raw", schema).alias("r")).select("place", "r.*")


_SYSTEM = "Be brief.\nAnswer with a letter."


@query("export_system_files", f""", failed AS ({_export_sql("failed").replace("SELECT tid AS task_id", "SELECT line_no, tid AS task_id", 1)}), success AS ({_export_sql("success").replace("SELECT tid AS task_id", "SELECT line_no, tid AS task_id", 1)})
    SELECT row_number() OVER (ORDER BY s, line_no) - 1 AS place, task_id, source_split, md5('System: {_SYSTEM.replace(chr(10), "' || chr(10) || '")}' || chr(10) || chr(10) || text) AS text_md5 FROM (SELECT 0 AS s, * FROM success UNION ALL SELECT 1, * FROM failed) t""", "fx6")
def export_system_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training export with a system prompt from a file, which is stripped."""
    return _training_files(spark, sf_dir, system_text=f" {_SYSTEM}\n")


@query("export_done_files", """ SELECT row_number() OVER (ORDER BY line_no) - 1 AS place, md5('User: ' || coalesce(nullif(user_text, ''), 'null') || chr(10) || 'Assistant: ' || coalesce(nullif(assistant, ''), 'null')) AS text_md5,
    row_number() OVER (ORDER BY line_no) - 1 AS text_place FROM fx6 WHERE split = 'success'""", "fx6")
def export_done_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished rows of a file as training rows, and their texts alone in the same order."""
    folder, odd = _scratch(spark, "done"), F.col("line_no") % 2 == 1
    rows = fixture(spark, sf_dir, "fx6").orderBy("line_no").select(F.col("tid").alias("task_id"), F.when(F.col("split") == "success", "done").otherwise("generated").alias("status"), F.when(odd, F.col("user_text")).alias("user"), F.when(~odd, F.col("user_text")).alias("rewritten_user"), "assistant")
    rows.write.json(f"{folder}/in")
    export.export_done(spark, f"{folder}/in", f"{folder}/out", f"{folder}/texts")
    made, texts = (_numbered(spark, f"{folder}/{n}", "text string").select("place", F.md5(F.col("text").cast("binary")).alias("text_md5")) for n in ("out", "texts"))
    again = texts.select(F.col("place").alias("text_place"), F.col("text_md5").alias("other"))
    return made.join(again, (F.col("place") == F.col("text_place")) & (F.col("text_md5") == F.col("other"))).select("place", "text_md5", "text_place")


@query("export_reference_files", f""", answers AS ({_REFERENCE}) SELECT task_id, md5(text) AS text_md5, row_number() OVER (ORDER BY md5('3:' || task_id)) <= 100 AS in_subset FROM answers""", "fx6")
def export_reference_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference answers of a file's tasks, and which are in the random subset."""
    folder = _scratch(spark, "reference")
    ref = F.concat("expected_answer", F.when(F.col("line_no") % 6 == 0, "x").otherwise(""))
    fixture(spark, sf_dir, "fx6").orderBy("line_no").select(F.col("tid").alias("task_id"), F.col("user_text").alias("user"), ref.alias("ref_answer")).write.json(f"{folder}/in")
    export.export_reference_answers(spark, f"{folder}/in", f"{folder}/out", f"{folder}/subset", 100, 3)
    made, subset = (spark.read.schema("task_id string, text string").json(f"{folder}/{n}") for n in ("out", "subset"))
    return made.join(subset.select("task_id", F.lit(True).alias("drawn")), "task_id", "left").select("task_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.coalesce("drawn", F.lit(False)).alias("in_subset"))


@query("export_files", f""", success AS ({_export_sql("success").replace("SELECT tid AS task_id", "SELECT 0 AS s, line_no, tid AS task_id", 1)}), failed AS ({_export_sql("failed").replace("SELECT tid AS task_id", "SELECT 1 AS s, line_no, tid AS task_id", 1)})
    SELECT row_number() OVER (ORDER BY s, line_no) - 1 AS place, task_id, source_split, md5(text) AS text_md5 FROM (SELECT * FROM success UNION ALL SELECT * FROM failed) t""", "fx6")
def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both splits' files of finished rows to one training file, success first, as the file's lines have it."""
    return _training_files(spark, sf_dir)
