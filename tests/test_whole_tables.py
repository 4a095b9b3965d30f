"""Queries over all rows of their fixture, against what is worked out by hand from the whole table."""

from __future__ import annotations

import hashlib

import pytest

from weftline import queries as own
from weftline.fixtures import fixture


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_rounds_over_all_samples(spark, folder):
    at = f"/root/testdata/{folder}"
    ids = [f"{r.task_id}_{r.sample_index}" for r in fixture(spark, at, "fx1").collect()]
    want, kinds = [], set()
    for i in ids:
        kind = int(hashlib.md5(i.encode()).hexdigest()[:4], 16) % 6
        kinds.add(kind)
        if kind in (own.OUT_OF_RANGE, own.UNREADABLE):
            continue  # stopped in the first round
        users = [f"second {i}"] if kind == own.REFUSED else [f"first {i}", f"second {i}"]
        want += [(i, f"{i}_q{k:03}", u, "A") for k, u in enumerate(users)]
    assert {own.REFUSED, own.OUT_OF_RANGE, own.UNREADABLE} < kinds
    got = own.QUERIES["generate_round_replay"](spark, at).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize(("name", "column"), [("feedback_message_all", "rejected"), ("validator_permutation_check_all", "n")])
def test_every_row_of_fx2_counts(spark, sf, name, column):
    rows = fixture(spark, sf, "fx2")
    sizes = {r.sample_id: r["count"] for r in rows.groupBy("sample_id").count().collect()}
    assert {r.sample_id: r[column] for r in own.QUERIES[name](spark, sf).collect()} == sizes
    assert "pos % 10 = 0" not in own.ORACLE_SQL[name] and "pos % 4 = 1" not in own.ORACLE_SQL[name]
