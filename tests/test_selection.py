"""Radix selection against sorted values."""

from __future__ import annotations

import random
import statistics
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tessera.operators.missing import fill_median
from tessera.operators.selection import column_medians, group_medians

DRAWS = random.Random(6)
VALUES = {
    "double": [DRAWS.choice([-1, 1]) * 10 ** DRAWS.uniform(-300, 300) for _ in range(301)],
    "float": [float(DRAWS.randrange(-50, 50)) / 4 for _ in range(300)],
    "long": [DRAWS.randrange(-(2**63), 2**63) for _ in range(300)],
    "int": [DRAWS.randrange(-3, 3) for _ in range(301)],
    "tinyint": [DRAWS.randrange(-128, 128) for _ in range(50)],
    "decimal(12,2)": [Decimal(DRAWS.randrange(-(10**11), 10**11)) / 100 for _ in range(300)],
    "decimal(38,5)": [Decimal(f"{DRAWS.randrange(-(10**30), 10**30)}e-5") for _ in range(301)],
    "decimal(36,5)": [Decimal(f"{DRAWS.randrange(-(10**30), 10**30)}e-5") for _ in range(200)],
    "decimal(38,0)": [Decimal(DRAWS.choice([-1, 1]) * 10 ** DRAWS.randrange(37)) for _ in range(99)],
}


def frame(spark, columns):
    """Columns ``c0, ...`` of the given types, shorter ones with nulls at the end, and a group."""
    n = max(len(VALUES[c]) for c in columns)
    rows = [
        (i % 5 if i % 5 else None, *(VALUES[c][i] if i < len(VALUES[c]) else None for c in columns))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "g int, " + ", ".join(f"c{i} {c}" for i, c in enumerate(columns)))


def middle(values):
    values = sorted(values)
    low, high = values[(len(values) - 1) // 2], values[len(values) // 2]
    if isinstance(low, float):
        return low if low == high else low / 2 + high / 2
    with localcontext(prec=80):
        return (Decimal(low) + Decimal(high)) / 2


def test_all_columns_in_one_search(spark):
    kinds = list(VALUES)
    df = frame(spark, kinds)
    spark.sparkContext.setJobGroup("medians", "counted")
    got = column_medians(df, [f"c{i}" for i in range(len(kinds))])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [middle(VALUES[k]) for k in kinds]
    # Four passes of narrow keys and eight of wide ones, of two jobs each at most.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("medians")) <= 24


def test_each_group(spark):
    kinds = ["double", "int", "decimal(12,2)", "decimal(36,5)"]
    df = frame(spark, kinds)
    got = {r[0]: r[1:] for r in group_medians(df, [f"c{i}" for i in range(4)], ["g"]).collect()}
    for group in (None, 1, 2, 3, 4):
        for i, kind in enumerate(kinds):
            own = [v for j, v in enumerate(VALUES[kind]) if j % 5 == (group or 0)]
            assert got[group][i] == middle(own), (group, kind)


def test_missing_values_and_empty_groups(spark):
    rows = [("a", 1.0, None), ("a", float("nan"), 4), ("a", -0.0, 7), ("b", None, None), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "`the.group` string, `v.x` double, n int")
    assert column_medians(df, ["v.x", "n"]) == [1.0, 4]
    assert column_medians(df.limit(0), ["v.x", "n"]) == [None, None]
    got = fill_median(df, ["v.x", "n"], "the.group").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [("a", 1.0, 5), ("a", 0.5, 4), ("a", -0.0, 7), ("b", None, None), (None, 2.0, 1)], key=repr
    )
    assert fill_median(df.limit(0), "n", "the.group").count() == 0


def test_a_group_with_most_rows(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 900)).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"),
    )
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    got = {r.g: r.v for r in group_medians(df, ["v"], ["g"]).collect()}
    assert got == {g: middle(v) for g, v in values.items()}
    assert got["hot"] == pytest.approx(statistics.median(values["hot"]))


def test_no_median_of_texts(spark):
    with pytest.raises(TypeError, match="string"):
        column_medians(spark.createDataFrame([("a",)], "s string"), ["s"])
