"""Margins after raking, calibrated probabilities, odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing
from weftline.llm.common import read_table


def test_margins_meet_their_targets(spark):
    docs = mixing.described(read_table(spark, "/root/testdata/sf0.01", "documents"))
    plan = mixing.Plan({"__source": 0.0, "__language": {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}, "__topic": 0.5}, rounds=40)
    cells = mixing.weighed(docs, plan, "__mass")
    total = cells.agg(F.sum("mass")).first()[0]
    assert cells.agg(F.sum("raked")).first()[0] == pytest.approx(total)
    language = {r["__language"]: r.s / total for r in cells.groupBy("__language").agg(F.sum("raked").alias("s")).collect()}
    assert language == pytest.approx({"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}, rel=1e-3)
    shares = [r.s / total for r in cells.groupBy("__source").agg(F.sum("raked").alias("s")).collect()]
    assert shares == pytest.approx([1 / len(shares)] * len(shares), rel=1e-3)
    expected = cells.agg(F.sum(F.col("mass") * F.col("probability"))).first()[0]
    assert expected == pytest.approx(plan.kept_share * total, rel=0.01)
    drawn = mixing.attach(docs, cells, plan).where(mixing.chance(F.col("doc_id"), plan.seed) < F.col("probability"))
    assert drawn.agg(F.sum("__mass")).first()[0] == pytest.approx(expected, rel=0.15)


def test_odd_rows(odd_documents, no_documents):
    plan = mixing.default_plan()
    kept = mixing.sample(odd_documents, plan)
    assert kept.columns == odd_documents.columns and 0 < kept.count() < odd_documents.count()
    assert sorted(map(str, kept.collect())) == sorted(map(str, mixing.sample(odd_documents, plan).collect()))
    assert mixing.sample(no_documents, plan).count() == 0
    assert mixing.sample(odd_documents.where("text is null"), plan).count() in (0, 1, 2)


def test_plan_is_native(odd_documents):
    plan = mixing.default_plan()
    text = mixing.sample(odd_documents, plan)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_given_shares_topics_and_counts(spark):
    """Targets by name, topics and token counts from columns; raking stops where the margins are met."""
    rows = [(i, ("web", "book", "code")[i % 3], ("en", "de")[i % 7 < 2], ("law", "art")[i * i % 5 < 2], None if i == 5 else 10 + i % 13) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, subject string, tokens long").withColumn("text", F.lit("x"))
    want = {"__source": {"web": 0.2, "book": 0.5, "code": 0.3}, "__language": {"en": 0.6, "de": 0.4}, "__topic": {"law": 0.5, "art": 0.5}}
    plan = mixing.Plan(want, kept_share=0.2, rounds=50, tolerance=1e-6)
    described = mixing.described(docs, topic="subject", tokens="tokens")
    assert described.where("doc_id = 5").first()["__mass"] == 0
    cells = mixing.weighed(described, plan, "__mass")
    total = cells.agg(F.sum("raked")).first()[0]
    for column, shares in want.items():
        got = {r[0]: r[1] / total for r in cells.groupBy(column).agg(F.sum("raked")).collect()}
        assert all(abs(got[k] - v) < 1e-5 for k, v in shares.items())
    kept = cells.agg(F.sum(F.col("mass") * F.col("probability"))).first()[0] / cells.agg(F.sum("mass")).first()[0]
    assert abs(kept - 0.2) < 1e-9
