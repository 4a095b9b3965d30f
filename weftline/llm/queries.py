"""The queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import ann, exponion, fill_middle, fst_tokens, labels, mixing, pieces, quality, repeats, simhash, topk, toxicity, url_filter
from weftline.llm.common import cut_lineage, read_table


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer's file is; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str, weigh=mixing.weighed) -> DataFrame:
    plan = mixing.default_plan()
    docs = mixing.described(read_table(spark, sf_dir, "documents"))
    rows = cut_lineage(docs.select("doc_id", "__source", "__language", "__topic", "__mass"))
    found = mixing.attach(rows, weigh(rows, plan, "__mass"), plan)
    return found.select(
        "doc_id",
        F.col("__source").alias("source"),
        F.col("__language").alias("lang"),
        F.col("__topic").alias("topic"),
        F.col("__mass").alias("n_tokens"),
        F.round("rate", 9).alias("rate"),
        F.round("probability", 9).alias("probability"),
        (mixing.chance(F.col("doc_id"), plan.seed) < F.col("probability")).alias("sampled"),
    )


def op1_mixing_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op1_mixing, but raked under the cap, so that the probabilities have the margins."""
    return op1_mixing(spark, sf_dir, mixing.weighed_within)


def op2_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = repeats.remove(repeats.byte_repeats(docs, width=200), "byte", units="n_bytes")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", repeats.removed_units().alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), digest)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def quality_model(docs: DataFrame, marks: DataFrame, rows: int = 2000) -> quality.Model:
    """Fitted on at most ``rows`` labelled documents outside the held-out fold."""
    return quality.fit(labels.training_sample(docs, marks, "quality", labels.fold(F.col("doc_id"), 5) != 0, rows))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.decided(quality.score(docs, model), 0.3)
    return scored.select("doc_id", F.coalesce(labels.fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load_model(vocabulary_path("piece_bpe_32k.model"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(pieces.encode_and_decode(docs, model), ["doc_id"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labels.training_sample(docs, read_table(spark, sf_dir, "labels"), "toxic", labels.fold(F.col("doc_id"), 4) != 2, 3000)
    scored = quality.decided(toxicity.score(docs, toxicity.fit(sample)), 0.3)
    return scored.select("doc_id", F.coalesce(labels.fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = fst_tokens.load_tokenizer(vocabulary_path("byte_bpe_50k.json"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = fst_tokens.count_tokens(docs, spec)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op10_word_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = repeats.remove(repeats.word_repeats(docs, width=35), "word", units="n_words")
    return kept.select("doc_id", "n_words", repeats.removed_units().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = [F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(fill_middle.rebuilt(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exponion.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_byte_repeats": op2_byte_repeats,
    "op3_nearest": op3_nearest,
    "op4_quality": op4_quality,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_topk": op8_topk,
    "op9_token_counts": op9_token_counts,
    "op10_word_repeats": op10_word_repeats,
    "op11_fill_middle": op11_fill_middle,
    "op12_url_filter": op12_url_filter,
    "op13_clusters": op13_clusters,
    "op1_mixing_margins": op1_mixing_margins,
}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.oracle_sql(mixing.default_plan()),
    "op11_fill_middle": fill_middle.oracle_sql(),
    "op12_url_filter": url_filter.oracle_sql(),
    "op13_clusters": exponion.oracle_sql(),
    "op10_word_repeats": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words),
        windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS h FROM starts),
        twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
        hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (h)),
        gone AS (SELECT doc_id, list(p) AS p, count(*) AS n FROM hit GROUP BY doc_id)
        SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(array_to_string(list_filter(w, lambda x, k: p IS NULL OR NOT list_contains(p, k)), ' '), '')) AS kept_sha256
        FROM words LEFT JOIN gone USING (doc_id)""",
    "op8_topk": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5""",
}
