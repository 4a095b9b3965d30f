"""The driver's contract: names, and each SQL twin gives the query's rows."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from weftline import queries as own


def test_entry(spark):
    assert {r.split for r in entry.entry(spark).collect()} == {"success", "failed"}


def test_every_query_is_named_once():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(own.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(own.ORACLE_SQL))
def test_sql_twin(spark, sf, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        db.sql(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    twin = db.sql(own.ORACLE_SQL[name])
    assert sorted(twin.columns) == columns
    place = [twin.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in place)) for r in twin.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
