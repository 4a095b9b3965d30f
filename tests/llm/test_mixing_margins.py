"""Margins of mass * probability: what is drawn, and not only what was raked, has the shares that the budget allows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing, queries
from weftline.llm.common import read_table


def shares(cells, plan):
    return [r.asDict() for r in mixing.margins(cells, plan).collect()]


def test_probabilities_have_the_margins(spark):
    docs = mixing.described(read_table(spark, "/root/testdata/sf0.01", "documents"))
    plan = mixing.default_plan()
    cells = mixing.weighed_within(docs, plan, "__mass")
    total, kept = cells.agg(F.sum("mass"), F.sum(F.col("mass") * F.col("probability"))).first()
    assert kept == pytest.approx(plan.kept_share * total, rel=1e-6)
    found = shares(cells, plan)
    assert {r["margin"] for r in found} == set(plan.columns)
    assert all(r["kept"] == pytest.approx(r["goal"], abs=2e-3) for r in found)
    for r in found:  # a goal below its target only where the level is kept whole
        assert r["goal"] >= r["target"] * (1 - 1e-9) or r["goal"] * plan.kept_share == pytest.approx(r["own"])
    before = shares(mixing.weighed(docs, plan, "__mass"), plan)
    assert max(abs(r["kept"] - r["goal"]) for r in before) > 0.02


def test_small_cells_against_figures_by_hand(spark):
    rows = spark.createDataFrame([("a", "x", 60), ("a", "y", 20), ("b", "x", 10), ("b", "y", 10)], "s string, t string, mass long")
    plan = mixing.Plan({"s": {"a": 0.6, "b": 0.4}, "t": {"x": 0.5, "y": 0.5}}, rounds=60)
    cells = mixing.weighed_within(rows, plan)
    kept = {(r.s, r.t): r.mass * r.probability for r in cells.collect()}
    # b has 20 of 100 and is kept whole; so a gives 30 of 50, and 25 of each t leave 15 of each t to a
    assert kept == pytest.approx({("a", "x"): 15, ("a", "y"): 15, ("b", "x"): 10, ("b", "y"): 10}, rel=1e-3)
    assert all(0 <= r.probability <= 1 for r in cells.collect())


def test_query_over_the_whole_table(spark, sf):
    got = queries.op1_mixing_margins(spark, sf)
    assert got.count() == read_table(spark, sf, "documents").count()
    assert got.columns == queries.op1_mixing(spark, sf).columns
