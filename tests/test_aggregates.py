from __future__ import annotations

import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import aggregates, missing, profile


@pytest.fixture(scope="module")
def hot(spark):
    """Four fifths of the rows in one group, some values missing or equal."""
    rows = [
        ("hot" if i % 5 else f"k{i % 3}", i, None if i % 17 == 0 else i % 50) for i in range(2000)
    ]
    return spark.createDataFrame(rows, "key string, id long, v int")


def expected_lists(df):
    lists = {}
    for row in df.collect():
        if row.v is not None:
            lists.setdefault(row.key, []).append(row.v)
    return {key: sorted(values) for key, values in lists.items()}


def test_large_lists_are_cut_and_whole(hot):
    parts = aggregates.collect_values(hot, "key", "v", list_rows=200).collect()
    joined = {}
    for row in sorted(parts, key=lambda r: (r.key, r.chunk)):
        assert len(joined.get(row.key, [])) == 200 * row.chunk
        joined[row.key] = joined.get(row.key, []) + row["items"]
    assert joined == expected_lists(hot)


def test_lists_of_distinct_values(hot):
    sets = aggregates.collect_distinct(hot, "key", "v").collect()
    expected = {key: sorted(set(values)) for key, values in expected_lists(hot).items()}
    assert {r.key: r["items"] for r in sets} == expected


def test_first_and_last(spark):
    rows = [("a", 2, 20), ("a", 1, None), ("a", 3, 30), ("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    picked = {r.k: r[1:] for r in aggregates.first_last(df, "k", "v", ["t"]).collect()}
    assert picked == {"a": (None, 30), "b": (None, None)}
    seen = aggregates.first_last(df, "k", "v", ["t"], ignore_nulls=True)
    assert {r.k: r[1:] for r in seen.collect()} == {"a": (20, 30), "b": (None, None)}


def test_most_frequent_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "v string")
    assert aggregates.most_frequent(df, "v") == "a"
    assert aggregates.most_frequent(df.where("v IS NULL"), "v") is None


def test_mean_fill_truncates_into_integers(spark):
    df = spark.createDataFrame([(3, 1.0, None), (4, None, None), (4, 2.0, None), (None, 4.5, None)],
                               "i int, d double, e double")
    filled = missing.fill_mean(df, ["i", "d", "e"]).collect()
    assert filled[3].i == 3
    assert filled[1].d == 2.5
    assert filled[0].e is None


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([0.0, 1.0, 1.0, 1.0, 2.5, -7.0, 1e12, 3.25]), min_size=1, max_size=40))
def test_median_of_repeated_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert missing.exact_median(df, "v") == statistics.median(values)


def test_nan_is_missing(spark):
    nan = float("nan")
    rows = [(1, 1.0, nan), (2, 1.0, 2.0), (3, 4.0, 8.0), (4, nan, 2.0), (5, None, 6.0)]
    df = spark.createDataFrame(rows, "key long, x double, y double")
    assert [r.x for r in missing.fill_mean(df, ["x"]).orderBy("key").collect()][3:] == [2.0, 2.0]
    assert missing.exact_median(df, "y") == 4.0
    assert missing.fill_mode(df, "y").orderBy("key").first().y == 2.0
    near = {r.key: r.y for r in missing.fill_knn(df, "y", "x", "key", k=2).collect()}
    assert near == {1: 5.0, 2: 2.0, 3: 8.0, 4: 2.0, 5: 6.0}


def test_median_narrows_to_small_brackets(spark):
    draws = np.random.default_rng(1).lognormal(0, 3, 20_001)
    draws[:8000] = 2.0
    for values in (draws, draws[:-1]):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        assert missing.exact_median(df, "v") == pytest.approx(np.median(values), abs=0)
    assert missing.exact_median(df.where("v < -1"), "v") is None


def test_profile(spark):
    df = spark.createDataFrame([(1, "b", [1.0]), (3, None, [1.0, 2.0]), (None, "a", None)],
                               "i int, s string, v array<double>")
    stats = {r.column: r for r in profile.describe_long(df).collect()}
    assert set(stats) == {"i", "s"}
    assert stats["i"][1:] == (2, 2.0, pytest.approx(2**0.5), 1.0, 3.0, 1, 3, None, None)
    assert stats["s"][1:] == (2, None, None, None, None, None, None, "a", "b")
    assert profile.describe_long(df.select("v")).collect() == []
    assert profile.table_shape(df).collect() == [(3, 3)]
    assert profile.vector_length_check(df, "v", 2).collect() == [(3, 1, 2, 2)]
