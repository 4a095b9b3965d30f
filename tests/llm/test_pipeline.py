"""Every stage on odd rows; each against what its operator says; the SQL twins of the operators' queries."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from weftline.llm import queries, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory, odd_documents):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = odd_documents.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(f"{folder}/documents.parquet")
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, labelled):
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, labelled)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == COLUMNS
        assert stage(spark, docs.limit(0), labelled).count() == 0
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "mix_sources", "sentencepiece_codec"]


#: Every name that a stage or its operators give to a column on the way.
INNER = (
    "__score __spans __kept __words __left __k1 __k2 k1 k2 a c1 c2 n first windows wanted payload chunk more runs covered kept units spans "
    "__row row id key fp cells best root component __copies copies u v m "
    "__source __language __topic __mass mass raked weight rate probability __rate __probability goal target own room place full rest factor found most "
    "score predicted label __id __label ids n_tokens decoded round_trip"
).split()


def test_clashing_names(spark, labelled):
    """A stage's rows and columns are the same, whatever a caller's own columns are called."""
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in INNER])
    for k, (_, stage) in enumerate(pipeline.STAGES):
        plain, out = stage(spark, docs, labelled), stage(spark, more, labelled)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == more.columns
            for r in out.collect():
                assert all(r[n] == f"{n} of {'none' if r.doc_id is None else r.doc_id}" for n in INNER)
        assert sorted(map(repr, out.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_decisions_take_effect(spark, labelled):
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    one = pipeline.simhash_near_dedup(spark, docs, labelled)
    roots = simhash.near_duplicates(docs).select("root").distinct().count()
    assert one.count() == roots
    cut = pipeline.substring_dedup(spark, docs, labelled).collect()
    texts = {r.text for r in docs.collect()}
    assert any(r.text not in texts for r in cut) and all(r.text is None or r.n_chars == len(r.text) for r in cut)


def test_run(spark):
    rows = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twin(spark, sf, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        db.sql(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, sf)
    twin = db.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(twin.columns) == columns
    place = [twin.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(repr(tuple(r[i] for i in place)) for r in twin.fetchall())
