"""Input views derived from the given tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx1": """SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) - 1 AS logical_index, u.conv_id AS task_id, u.turn AS sample_index,
        'User: ' || u.text || chr(10) || chr(10) || 'Assistant: ' || a.text AS context,
        substr('ABCD', CAST(u.conv_id % 4 AS INT) + 1, 1) AS ref_answer
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "fx2": "SELECT source AS sample_id, doc_id AS pos, text AS user_text, substr('ABCD', CAST(doc_id % 4 AS INT) + 1, 1) AS answer FROM documents",
    "fx3": """SELECT n_regionkey AS sample_key, 'Question: which one?' || chr(10) || 'Choices:' || chr(10) || 'A. ' || max(CASE WHEN rn = 1 THEN n_name END)
        || chr(10) || 'B. ' || max(CASE WHEN rn = 2 THEN n_name END) || chr(10) || 'C. ' || max(CASE WHEN rn = 3 THEN n_name END)
        || chr(10) || 'D. ' || max(CASE WHEN rn = 4 THEN n_name END) AS user_text
        FROM (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn FROM nation) r GROUP BY n_regionkey""",
    "fx4": """SELECT 0 AS file_rank, logical_index * 10 + v AS line_no, task_id || '_' || sample_index || '_q00' || v AS tid, 'generated' AS status,
        'Q' || logical_index AS user_text, ref_answer AS answer, '' AS assistant
        FROM fx1 CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) vs WHERE (logical_index + v) % 3 <> 0
        UNION ALL SELECT 1 + CAST(logical_index % 2 AS INT), logical_index * 10 + v, task_id || '_' || sample_index || '_q00' || v, 'done', '', '', 'text ' || ref_answer
        FROM fx1 CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) vs WHERE (logical_index + v) % 3 = 1""",
    "fx5": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, substr('ABCD', CAST(l_partkey % 4 AS INT) + 1, 1) AS expected,
        CASE l_linenumber % 4 WHEN 0 THEN '<think>' || chr(10) || 'flag ' || l_returnflag || chr(10) || '</think>' || chr(10) || chr(10) || substr('ABCD', CAST(l_suppkey % 4 AS INT) + 1, 1)
        WHEN 1 THEN 'the result is (' || substr('ABCD', CAST(l_suppkey % 4 AS INT) + 1, 1) || ').' WHEN 2 THEN 'no letters here'
        ELSE '**' || substr('ABCD', CAST(l_suppkey % 4 AS INT) + 1, 1) || '**' END AS assistant FROM lineitem""",
    "fx6": """SELECT doc_id AS line_no, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'd' || (doc_id % 400) END AS tid, CASE WHEN doc_id % 13 = 0 THEN '' ELSE text END AS user_text,
        CASE WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'success' END AS split, substr('ABCD', CAST(doc_id % 4 AS INT) + 1, 1) AS expected_answer,
        CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '<think>' || chr(10) || lang || chr(10) || '</think>' || chr(10) || 'A' WHEN 2 THEN '<think>' || lang WHEN 3 THEN 'B' ELSE '<think></think>C' END AS assistant FROM documents""",
}
#: Tables and views each one reads.
NEEDS = {"fx1": ("conversations",), "fx2": ("documents",), "fx3": ("nation",), "fx4": ("fx1",), "fx5": ("lineitem",), "fx6": ("documents",)}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for need in NEEDS[name]:
        source = fixture(spark, sf_dir, need) if need in VIEWS else spark.read.parquet(f"{sf_dir}/{need}.parquet")
        source.createOrReplaceTempView(need)
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """A query behind the views it reads."""
    seen: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            if need in VIEWS:
                add(need)
        if name not in seen:
            seen.append(name)

    for n in names:
        add(n)
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in seen) + sql
