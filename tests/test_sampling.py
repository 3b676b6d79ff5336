from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.sinks import write_by_label

SLOW = dict(deadline=None, suppress_health_check=list(HealthCheck))


def counted(spark, counts):
    return spark.createDataFrame(list(counts.items()), "label string, n long")


def quotas(plan):
    return {r.label: r.quota for r in plan.collect()}


def test_proportional_plan_goldens(spark):
    counts = counted(spark, {"a": 10, "b": 20, "c": 30})
    assert quotas(sampling.proportional_plan(counts, 6)) == {"a": 1, "b": 2, "c": 3}
    assert quotas(sampling.proportional_plan(counts, 60)) == {"a": 10, "b": 20, "c": 30}
    assert quotas(sampling.proportional_plan(counts, 0)) == {"a": 0, "b": 0, "c": 0}
    with pytest.raises(ValueError, match="61"):
        sampling.proportional_plan(counts, 61)
    assert quotas(sampling.proportional_plan(counts.limit(0), 0)) == {}


def test_a_missed_interval_is_widened(skewed, monkeypatch):
    expected = {r.id for r in sampling.sample_proportional(skewed, 300, "label", "id").rows.collect()}
    monkeypatch.setattr(sampling, "SLACKS", (0.0, 0.3, 30.0))
    again = sampling.sample_proportional(skewed, 300, "label", "id")
    assert {r.id for r in again.rows.collect()} == expected


def test_a_plan_of_other_rows_is_refused(skewed):
    plan = sampling.sample_proportional(skewed, 5000, "label", "id").plan
    with pytest.raises(ValueError, match="plan"):
        sampling.draw(skewed.where("id % 3 = 0"), plan, "label", "id")


@settings(max_examples=15, **SLOW)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25), st.floats(0, 1))
@example([1] * 25, 0.5)
@example([3] * 21, 0.5)
def test_proportional_plan_is_exact_and_fair(spark, sizes, share):
    total = sum(sizes)
    size = int(total * share)
    counts = {f"c{i}": n for i, n in enumerate(sizes)}
    plan = quotas(sampling.proportional_plan(counted(spark, counts), size))
    assert sum(plan.values()) == size
    for label, n in counts.items():
        assert 0 <= plan[label] <= n
        if total:
            assert abs(plan[label] - n * size / total) <= 1.5


def carried(counts, size):
    base, carry = divmod(size, len(counts))
    plan = {}
    for label in sorted(counts):
        asked = base + (carry > 0)
        plan[label] = min(counts[label], asked)
        carry = max(carry - 1, 0) if plan[label] == asked else carry + asked - plan[label]
    return plan


def test_equal_plan_golden(spark):
    counts = counted(spark, {"a": 0, "b": 10, "c": 10})
    assert quotas(sampling.equal_plan(counts, 4)) == {"a": 0, "b": 2, "c": 2}
    assert quotas(sampling.equal_plan(counts.limit(0), 4)) == {}


@settings(max_examples=10, **SLOW)
@given(st.lists(st.integers(0, 8), min_size=1, max_size=30), st.integers(0, 150), st.integers(2, 5))
def test_equal_plan_follows_the_carry_over_several_levels(spark, sizes, size, fold_rows):
    counts = {f"c{i:02d}": n for i, n in enumerate(sizes)}
    plan = sampling.equal_plan(counted(spark, counts), size, fold_rows=fold_rows)
    assert quotas(plan) == carried(counts, size)


@pytest.fixture(scope="module")
def skewed(spark):
    """A class with most rows, small ones, a class of one row and rows without a class."""
    label = (
        F.when(F.col("id") < 4000, "big")
        .when(F.col("id") == 4000, "single")
        .when(F.col("id") < 5000, F.concat(F.lit("c"), F.col("id") % 7))
    )
    return spark.range(5200).withColumn("label", label)


def expected_rows(df, plan, seed):
    by_label = {}
    for row in df.collect():
        digest = hashlib.md5(f"{seed}:{row.id}".encode()).hexdigest()
        by_label.setdefault(row.label, []).append((digest, row.id))
    return {i for label, q in plan.items() for _, i in sorted(by_label[label])[:q]}


@pytest.mark.parametrize("size, seed", [(1, 1), (300, 42), (300, 7), (5199, 42), (5200, 42), (0, 3)])
def test_draw_takes_the_first_rows_in_hash_order(skewed, size, seed):
    sample = sampling.sample_proportional(skewed, size, "label", "id", seed)
    plan = quotas(sample.plan)
    drawn = [r.id for r in sample.rows.collect()]
    assert len(drawn) == len(set(drawn)) == size == sum(plan.values())
    assert set(drawn) == expected_rows(skewed, plan, seed)
    again = sampling.draw(skewed, sample.plan, "label", "id", seed)
    assert {r.id for r in again.collect()} == set(drawn)


def test_columns_may_have_any_name(spark):
    df = spark.range(60).selectExpr("id AS cutoff", "id % 3 AS label", "1 AS n", "2 AS quota")
    assert sampling.sample_proportional(df, 7, "label", "cutoff").rows.count() == 7


def test_draw_beyond_the_broadcast_limit(spark, skewed):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        sample = sampling.sample_proportional(skewed, 300, "label", "id")
        assert {r.id for r in sample.rows.collect()} == expected_rows(
            skewed, quotas(sample.plan), 42
        )
    finally:
        spark.conf.set(key, before)


def test_sample_is_a_filter_over_the_rows(skewed):
    """The full rows meet the small table of cut-offs without being shuffled."""
    sample = sampling.sample_proportional(skewed, 300, "label", "id")
    sample.rows.collect()
    plan = sample.rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_equal_sample(skewed):
    present = skewed.where("label IS NOT NULL")
    sample = sampling.sample_equal(present, 60, "label", "id")
    counts = {r.label: r["count"] for r in present.groupBy("label").count().collect()}
    assert quotas(sample.plan) == carried(counts, 60)
    assert {r.id for r in sample.rows.collect()} == expected_rows(present, quotas(sample.plan), 42)


def test_a_key_that_repeats_is_refused(spark):
    df = spark.range(100).selectExpr("'x' AS label", "0 AS same", "id % 10 AS tenfold")
    for key in ("same", "tenfold"):
        with pytest.raises((PySparkException, ValueError), match="not unique"):
            sampling.sample_proportional(df, 55, "label", key)


def test_sample_to_folders(spark, skewed, tmp_path):
    sample = sampling.sample_proportional(skewed.where("label IS NOT NULL"), 40, "label", "id")
    write_by_label(sample.rows, str(tmp_path / "sample"))
    plan = {label: q for label, q in quotas(sample.plan).items() if q > 0}
    folders = {p.name for p in (tmp_path / "sample").glob("label=*")}
    assert folders == {f"label={label}" for label in plan}
    stored = spark.read.parquet(str(tmp_path / "sample")).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in stored} == plan


def test_class_counts(skewed):
    rows = sampling.class_counts_with_total(skewed).collect()
    assert [r.n for r in rows if r.is_total] == [5200]
    assert [r.n for r in rows if r.label is None and not r.is_total] == [200]
    listed = sampling.class_counts_of(skewed, ["big", "gone"]).collect()
    assert {r.label: r.n for r in listed} == {"big": 4000, "gone": 0}
    assert sampling.strata(skewed).count() == 10


def test_counts_of_classes_that_are_numbers(spark):
    df = spark.range(10).selectExpr("cast(id % 3 AS int) AS label")
    listed = sampling.class_counts_of(df, [0, 2, 9]).collect()
    assert {r.label: r.n for r in listed} == {0: 4, 2: 3, 9: 0}


def test_counts_of_null_and_of_repeated_names(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "label string")
    counted = sampling.class_counts_of(df, ["a", None, "a", "b"]).collect()
    assert sorted(map(tuple, counted), key=str) == [("a", 2), ("b", 0), (None, 1)]


def test_composite_keys_are_told_apart(spark):
    rows = [("a:b", "c"), ("a", "b:c"), (None, "a"), ("a", None), ("", "a")]
    df = spark.createDataFrame([("x", *r) for r in rows], "label string, k string, l string")
    assert df.select(sampling.draw_order(["k", "l"], 1)).distinct().count() == len(rows)
    assert sampling.sample_proportional(df, 3, "label", ["k", "l"]).rows.count() == 3


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, "counted")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_plans_and_samples_take_few_jobs(spark, skewed):
    """Counts, drafts and cut-offs are observed as they are written, not read for it again."""
    counts = sampling.class_counts(skewed)
    assert jobs_of(spark, "plan", lambda: sampling.proportional_plan(counts, 304).collect()) <= 10
    assert jobs_of(spark, "draw", lambda: sampling.sample_proportional(skewed, 304, "label", "id").rows.collect()) <= 16
    assert jobs_of(spark, "equal", lambda: sampling.sample_equal(skewed, 300, "label", "id").rows.collect()) <= 16
