"""A training corpus from documents, in stages; each is written and read again before the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import mixing, pieces, quality, repeats, similar, simhash
from weftline.llm.common import ensure_checkpoint_dir, hand_back, read_table, set_aside
from weftline.llm.queries import quality_model, vocabulary_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.3 or more).

    Null and empty texts score what the intercept gives, texts of any length are scored whole; repeated rows share a score.
    Null ids are scored, but never learned from. An empty table gives no rows; columns pass through, whatever their names.
    """
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    hand_back()  # what the fit held on the driver
    carried, restored = set_aside(docs, ["doc_id", "text"])
    return restored(quality.score(carried, model, out="__score").where(F.col("__score") >= 0.3))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints, by the rule of op7 (not a stage: it finds few near copies)."""
    return simhash.keep_one(docs)


def similar_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles are alike to 0.8 or more: the one with the least id.

    Candidates are linked by SimHash fingerprints and by min-hash cells; the shingles decide. Null, empty and blank texts are
    alike (one stays); texts of less than five words are alike if equal; repeated rows count once; a component without any
    id keeps one row. An empty table gives no rows, columns pass through.
    """
    return similar.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under repeated runs of 35 words; a text of which none is left goes, unless it had none.

    Texts that lose nothing stay as they are; of others the remaining words are joined by one space, and n_chars counts anew.
    Null texts stay null. Repeated rows repeat each other: of more than 35 words, both lose them. An empty table gives no
    rows; other columns pass through, whatever their names.
    """
    carried, restored = set_aside(docs, ["doc_id", "text", "n_chars"])
    kept = repeats.remove(repeats.word_repeats(carried, width=35, out="__spans"), "word", spans="__spans", kept="__kept", units="__words")
    changed = F.size("__spans") > 0
    left = kept.withColumn("__left", F.decode("__kept", "UTF-8")).where(~changed | (F.col("__left") != ""))
    new = {"text": F.when(changed, F.col("__left")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("__left").cast("long")).otherwise(F.col("n_chars"))
    return restored(left.withColumns(new))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that source, language and topic have their target shares of tokens, as far as half of the tokens
    allow: a level that is smaller than its target stays whole (``mixing.goals``).

    Null sources and languages are a level of their own; null, empty and blank texts weigh nothing and are drawn as their
    cell is; rows of one id are drawn or left together, so are all without an id. An empty table gives no rows.
    """
    return mixing.sample(docs, mixing.default_plan())


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): token ids of each whole text, and whether they decode to it.

    Null and empty texts have no ids and decode to ''; repeated rows stay; other columns are left out. An empty table gives
    no rows.
    """
    model = pieces.load_model(vocabulary_path("piece_bpe_32k.model"))
    decoded = pieces.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), model)
    whole = (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip")
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", whole)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", similar_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece_codec", sentencepiece_codec),
]

#: Stages train, hash with XXH64, and encode: SQL cannot say that; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared checkpoint folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(path := f"{folder}/{k}-{name}")
            docs = spark.read.parquet(path)
    return docs
