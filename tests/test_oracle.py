"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tessera import plans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows: list[tuple]) -> list[tuple]:
    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(plans.queries()) == set(SQL) & set(plans.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, duck):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(SQL[name])
    names = sorted(ours.columns)
    theirs_names = [column[0] for column in theirs.description]
    assert names == sorted(theirs_names)
    order = [theirs_names.index(n) for n in names]
    expected = [tuple(row[i] for i in order) for row in theirs.fetchall()]
    actual = [tuple(row) for row in ours.select(*(f"`{n}`" for n in names)).collect()]
    assert len(actual) == len(expected) > 0
    assert comparable(actual) == comparable(expected)


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["path", "label", "features", "n_features", "is_complete"]
    assert rows.where("is_complete").count() == rows.count() > 0
