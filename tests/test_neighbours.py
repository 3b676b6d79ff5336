"""Filling from near rows against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import missing, neighbours

METRICS = {
    "euclidean": lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b)),
    "manhattan": lambda a, b: sum(abs(i - j) for i, j in zip(a, b)),
    "minkowski": lambda a, b: sum(abs(i - j) ** 3 for i, j in zip(a, b)),
    "hamming": lambda a, b: sum(i != j for i, j in zip(a, b)),
}


def brute_force(rows, k, distance):
    donors = [(key, x, y) for key, *x, y in rows if y is not None and None not in x]
    filled = {}
    for key, *x, y in rows:
        if y is None and None not in x and donors:
            nearest = sorted((distance(other, x), d, value) for d, other, value in donors)[:k]
            y = sum(value for *_, value in nearest) / len(nearest)
        filled[key] = y
    return filled


def make_rows(seed, n, span, width):
    """Two fifths of the rows share one vector, some lack a feature, some the target."""
    draws = random.Random(seed)
    rows = []
    for key in range(n):
        x = [draws.randrange(span) for _ in range(width)]
        if key % 5 < 2:
            x = [span // 2] * width
        if key % 41 == 0:
            x[-1] = None
        rows.append((key, *x, None if draws.random() < 0.3 else draws.randrange(1000) / 4))
    return rows


def table(spark, rows, width):
    features = ", ".join(f"x{i} int" for i in range(width))
    return spark.createDataFrame(rows, f"key long, {features}, y double")


@pytest.mark.parametrize("span", [1, 12, 100_000])
def test_one_feature(spark, span):
    rows = make_rows(span, 300, span, 1)
    filled = missing.fill_knn(table(spark, rows, 1), "y", "x0", "key", k=4)
    assert filled.columns == ["key", "x0", "y"]
    got = {r.key: r.y for r in filled.collect()}
    assert got == pytest.approx(brute_force(rows, 4, METRICS["manhattan"]))


@pytest.mark.parametrize("metric", METRICS)
def test_several_features(spark, metric):
    rows = make_rows(3, 300, 12, 3)
    filled = missing.fill_knn(
        table(spark, rows, 3), "y", ["x0", "x1", "x2"], "key", k=4, metric=metric
    )
    got = {r.key: r.y for r in filled.collect()}
    assert got == pytest.approx(brute_force(rows, 4, METRICS[metric]))


def test_mahalanobis(spark):
    draws = np.random.default_rng(5)
    points = draws.normal(size=(250, 3)) @ np.diag([1.0, 50.0, 0.01])
    points[:, 2] += points[:, 0]
    rows = [
        (key, *map(float, x), None if key % 4 == 0 else float(key)) for key, x in enumerate(points)
    ]
    inverse = np.linalg.inv(np.cov(points.T))

    def distance(a, b):
        difference = np.array(a) - np.array(b)
        return difference @ inverse @ difference

    df = spark.createDataFrame(rows, "key long, x0 double, x1 double, x2 double, y double")
    filled = missing.fill_knn(df, "y", ["x0", "x1", "x2"], "key", metric="mahalanobis")
    got = {r.key: r.y for r in filled.collect()}
    assert got == pytest.approx(brute_force(rows, 5, distance))
    flat = missing.fill_knn(
        df.withColumn("x2", F.lit(1.0)), "y", ["x1", "x2"], "key", metric="mahalanobis"
    )
    assert flat.where("y IS NULL").count() == 0


@pytest.mark.parametrize("span, ring_rows, per_task", [(9, 10, 7), (1000, 5, 1000), (1000, 40, 3)])
def test_many_cells_and_shared_lookups(spark, span, ring_rows, per_task):
    draws = random.Random(span)
    vectors = {(draws.randrange(span), draws.randrange(span)) for _ in range(300)}
    vectors |= {(span * 50, i) for i in range(3)}
    donors = [(list(map(float, v)), i, float(i)) for i, v in enumerate(sorted(vectors))]
    asked = [[float(draws.randrange(span)), float(draws.randrange(span))] for _ in range(60)]
    asked = [list(x) for x in {tuple(x) for x in asked + [[-5e3, 2.0], [1e6, 1e6]]}]
    found = neighbours.nearest_by_distance(
        spark.createDataFrame(donors, "x array<double>, donor long, y double"),
        spark.createDataFrame([(x,) for x in asked], "x array<double>"),
        4,
        2.0,
        ring_rows,
        per_task,
    )
    got = {}
    for row in found.collect():
        got.setdefault(tuple(row.x), set()).add(row.donor)
    expected = {
        tuple(x): {
            d for _, d in sorted((METRICS["euclidean"](x, v), d) for v, d, _ in donors)[:4]
        }
        for x in asked
    }
    assert got == expected


def test_order_with_several_bins(spark):
    draws = random.Random(9)
    donors = [([float(v)], v, float(v)) for v in draws.sample(range(10_000), 300)]
    asked = [[float(v)] for v in draws.sample(range(-500, 10_500), 80)]
    found = neighbours.nearest_by_order(
        spark.createDataFrame(donors, "x array<double>, donor long, y double"),
        spark.createDataFrame([(x,) for x in asked], "x array<double>"),
        3,
        bins=7,
    )
    got = {}
    for row in found.collect():
        got.setdefault(row.x[0], set()).add(row.donor)
    assert got == {
        x: {d for _, d in sorted((abs(v - x), d) for (v,), d, _ in donors)[:3]} for (x,) in asked
    }


@pytest.mark.parametrize("metric, features", [("euclidean", "a"), ("euclidean", "ab"), ("hamming", "ab")])
def test_few_or_no_donors(spark, metric, features):
    rows = [(1, 1.0, 1.0, None), (2, 5.0, 1.0, 3.0), (3, 9.0, 2.0, 5.0), (4, None, 1.0, None)]
    df = spark.createDataFrame(rows, "key long, a double, b double, y double")
    filled = missing.fill_knn(df, "y", list(features), "key", metric=metric)
    assert {r.key: r.y for r in filled.collect()} == {1: 4.0, 2: 3.0, 3: 5.0, 4: None}
    none = missing.fill_knn(df.where("y IS NULL"), "y", list(features), "key", metric=metric)
    assert {r.key: r.y for r in none.collect()} == {1: None, 4: None}


def test_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5.0)], "donor long, x double, y double")
    assert missing.fill_knn(df, "y", "x", "donor").where("y = 5").count() == 2


def test_unknown_metric(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "key long, a double, y double")
    with pytest.raises(ValueError, match="cosine"):
        missing.fill_knn(df, "y", "a", "key", metric="cosine")


@pytest.mark.parametrize("width", [8, 16])
@pytest.mark.parametrize("metric, power", [("euclidean", 2.0), ("minkowski", 3.0), ("minkowski", 0.5)])
def test_many_features_meet_a_bounded_share_of_the_donors(spark, width, metric, power):
    """Features that depend on three others, as measured ones do."""
    draws = np.random.default_rng(width)
    turn = draws.normal(size=(3, width))
    points = draws.normal(size=(4000, 3)) @ turn + draws.normal(size=(4000, width)) * 0.01
    donors = [(list(map(float, x)), i, 0.0) for i, x in enumerate(points[:3800])]
    asked = points[3800:]
    tally = []
    found = neighbours.nearest_by_distance(
        spark.createDataFrame(donors, "x array<double>, donor long, y double"),
        spark.createDataFrame([(list(map(float, x)),) for x in asked], "x array<double>"),
        5,
        power,
        tally=tally,
    )
    got = {}
    for row in found.collect():
        got.setdefault(tuple(row.x), set()).add(row.donor)
    gaps = (np.abs(points[:3800][None] - asked[:, None]) ** power).sum(axis=2)
    assert got == {tuple(x): set(np.argsort(g, kind="stable")[:5].tolist()) for x, g in zip(asked, gaps)}
    assert tally[0][0] == len(asked)
    # Below a power of one small differences count as much as large ones: only results are held.
    share = 0.25 if power > 1 else 1.0
    assert sum(compared for _, compared in tally) <= share * len(asked) * 3800


def test_every_pivot_takes_part_without_a_cap(spark):
    points = [([float(i % 211), float(i % 307)], i, 0.0) for i in range(20_000)]
    donors = spark.createDataFrame(points, "x array<double>, donor long, y double")
    packed = neighbours._packed(neighbours._grouped(donors))
    pivots = neighbours._pivots(packed, 2.0)
    assert 0.7 * 20_000**0.5 < len(pivots.points) < 1.3 * 20_000**0.5


def test_pivots_of_large_groups_stay_few_and_rows_are_placed_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PIVOTS", 20)
    monkeypatch.setattr(neighbours, "HOME", 2)
    draws = random.Random(17)
    points = sorted({(float(draws.randrange(500)), float(draws.randrange(500))) for _ in range(2000)})
    donors = spark.createDataFrame([(list(x), i, 0.0) for i, x in enumerate(points)], "x array<double>, donor long, y double")
    asked = [[draws.random() * 500, draws.random() * 500] for _ in range(40)]
    rows = spark.createDataFrame([(x,) for x in asked], "x array<double>").coalesce(1)
    packed = neighbours._packed(neighbours._grouped(donors))
    pivots = neighbours._pivots(packed, 2.0)
    assert 8 < len(pivots.points) < 36
    assert neighbours._with_cells(packed.coalesce(1), pivots).rdd.getNumPartitions() >= 8
    got = {}
    # More donors than a cell or two hold: some rows put all cells in order.
    for row in neighbours.nearest_by_distance(donors, rows, 250, ring_rows=30).collect():
        got.setdefault(tuple(row.x), set()).add(row.donor)
    for x in asked:
        near = sorted((METRICS["euclidean"](x, v), i) for i, v in enumerate(points))[:250]
        assert got[tuple(x)] == {i for _, i in near}


@pytest.mark.parametrize("n, rounds", [(1, 0), (2, 1), (3, 2), (12, 5), (40, 7), (100, 8)])
def test_rounds_of_categories_grow_with_the_logarithm(n, rounds):
    steps = neighbours.radii(n)
    assert len(steps) == rounds and steps == sorted(set(steps))
    assert steps[-1:] == [n - 2][: n > 1]


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, "counted")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_categories_in_any_number(spark):
    """Jobs grow at most linearly with the features; rows far from all donors are found too."""
    draws = random.Random(4)
    jobs = {}
    for width in (3, 6, 12):
        rows = [tuple(str(draws.randrange(9)) for _ in range(width)) for _ in range(400)]
        held = {x: i for i, x in enumerate(rows[:340])}
        donors = [(list(x), i, float(i)) for x, i in held.items()]
        asked = [list(x) for x in set(rows[340:])] + [["none"] * width]
        tally = []
        a = spark.createDataFrame(donors, "x array<string>, donor long, y double")
        b = spark.createDataFrame([(x,) for x in asked], "x array<string>")
        out = []
        run = lambda: out.extend(neighbours.nearest_by_mismatch(a, b, 4, 50, tally).collect())  # noqa: E731,B023
        jobs[width] = jobs_of(spark, f"categories{width}", run)
        got = {}
        for row in out:
            got.setdefault(tuple(row.x), []).append((row.gap, row.donor))
        for x in asked:
            want = sorted((float(METRICS["hamming"](x, v)), d) for v, d in held.items())[:4]
            assert sorted(got[tuple(x)]) == want
        assert tally[-1] >= 1
    assert jobs[12] <= 12 * max(jobs[3] / 3, 8)


def test_weak_categories_do_not_bring_all_pairs_together(spark, monkeypatch):
    """Features of two or three values beside a few telling ones, in two groups."""
    draws = random.Random(6)
    values = (2, 3, 3, 2, 40, 60, 50, 3)
    rows = {(g, *(str(draws.randrange(v)) for v in values)) for g in (0, 1) for _ in range(2000)}
    rows = sorted(rows)
    draws.shuffle(rows)
    held, asked = rows[:-150], rows[-150:]
    met = []
    agreeing = neighbours._agreeing

    def counted(donors, open_, n, k, plan, tasks):
        pairs = agreeing(donors, open_, n, k, plan, tasks)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(neighbours, "_agreeing", counted)
    found = neighbours.nearest_by_mismatch(
        spark.createDataFrame([(g, x, i, 0.0) for i, (g, *x) in enumerate(held)], "grp long, x array<string>, donor long, y double"),
        spark.createDataFrame([(g, x) for g, *x in asked], "grp long, x array<string>"),
        5,
    )
    got = {}
    for row in found.collect():
        got.setdefault((row.grp, *row.x), []).append((row.gap, row.donor))
    for g, *x in asked:
        want = sorted((float(METRICS["hamming"](x, v)), i) for i, (h, *v) in enumerate(held) if h == g)
        assert sorted(got[(g, *x)]) == want[:5]
    assert 0 < sum(met) < 0.1 * len(held) * len(asked)


def test_sets_of_categories_meet_a_falling_share_of_the_pairs():
    odds = [1 / v for v in (25, 150, 50, 90, 90, 10, 3, 5, 7, 11, 13, 17)]
    shares = []
    for size in (20_000, 1_200_000, 7_200_000):
        plan = neighbours._next_round(odds, 3, size // 10, size, 5)
        shares.append(sum(np.prod([odds[i] for i in chosen]) for chosen in plan.sets))
    assert shares == sorted(shares, reverse=True) and shares[1] < 0.03


@pytest.mark.parametrize("tops", [True, False])
def test_each_way_to_look_categories_up_is_exact(spark, monkeypatch, tops):
    monkeypatch.setattr(neighbours, "PAIR_MET", 1e9 if tops else 0.0)
    monkeypatch.setattr(neighbours, "PAIR_FOUND", 1e-9 if tops else 0.0)
    draws = random.Random(8)
    rows = list({tuple(str(draws.randrange(3)) for _ in range(5)) for _ in range(300)})
    donors = [(list(x), i * 2 + j, 0.0) for i, x in enumerate(rows[20:]) for j in range(2)]
    asked = [list(x) for x in rows[:20]] + [["9", "9", "1", "1", "9"], ["9"] * 5]
    found = neighbours.nearest_by_mismatch(
        spark.createDataFrame(donors, "x array<string>, donor long, y double"),
        spark.createDataFrame([(x,) for x in asked], "x array<string>"),
        7,
    )
    got = {}
    for row in found.collect():
        got.setdefault(tuple(row.x), []).append((row.gap, row.donor))
    for x in asked:
        want = sorted((float(METRICS["hamming"](x, v)), d) for v, d, _ in donors)[:7]
        assert sorted(got[tuple(x)]) == want


def test_donors_that_come_twice_count_once(spark):
    donors = [(["a", "b", "c"], 1, 1.0)] * 2 + [(["a", "b", "d"], 2, 2.0), (["a", "e", "f"], 3, 3.0)]
    found = neighbours.nearest_by_mismatch(
        spark.createDataFrame(donors, "x array<string>, donor long, y double"),
        spark.createDataFrame([(["a", "b", "z"],)], "x array<string>"),
        2,
    )
    assert sorted((r.gap, r.donor) for r in found.collect()) == [(1.0, 1), (1.0, 2)]


def partial_distance(metric, width):
    def distance(a, b):
        both = [(i, j) for i, j in zip(a, b) if i is not None and j is not None]
        return METRICS[metric](*zip(*both)) * width / len(both) if both else None

    return distance


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "hamming"])
def test_rows_that_lack_features(spark, metric):
    draws = random.Random(11)
    rows = []
    for key in range(260):
        x = [None if draws.random() < 0.3 else draws.randrange(8) for _ in range(3)]
        rows.append((key, *x, None if draws.random() < 0.3 else draws.randrange(1000) / 4))
    distance = partial_distance(metric, 3)
    want = {}
    for key, *x, y in rows:
        if y is None:
            near = [(distance(v, x), d, value) for d, *v, value in rows if value is not None]
            near = sorted(n for n in near if n[0] is not None)[:4]
            y = sum(n[2] for n in near) / len(near) if near else None
        want[key] = y
    names = ["x0", "x1", "x2"]
    filled = missing.fill_knn(table(spark, rows, 3), "y", names, "key", k=4, metric=metric, partial=True)
    assert {r.key: r.y for r in filled.collect()} == pytest.approx(want)
    assert any(None in r[1:4] and r[4] is None and want[r[0]] is not None for r in rows)


def test_mahalanobis_of_rows_that_lack_a_feature(spark):
    draws = np.random.default_rng(8)
    points = draws.normal(size=(200, 2)) @ np.array([[1.0, 0.9], [0.0, 0.3]]) * 100 + 1.7e9
    rows = [(i, float(a), float(b), None if i % 4 == 0 else float(i)) for i, (a, b) in enumerate(points)]
    lacking = [(i, a, None if i % 7 == 0 else b, y) for i, a, b, y in rows]
    df = spark.createDataFrame(lacking, "key long, a double, b double, y double")
    filled = missing.fill_knn(df, "y", ["a", "b"], "key", metric="mahalanobis", partial=True)
    got = {r.key: r.y for r in filled.collect()}
    assert all(y is not None for y in got.values())
    have = np.array([(a, b) for _, a, b, _ in lacking if b is not None])
    cov = np.cov(have.T)
    cov[0, 0] = np.var([a for _, a, _, _ in lacking], ddof=1)
    inverse = np.linalg.inv(cov)
    for key, a, b, y in lacking:
        if y is None:
            near = []
            for d, v, w, value in lacking:
                if value is None:
                    continue
                if b is None or w is None:
                    near.append(((a - v) ** 2 / cov[0, 0] * 2, d, value))
                else:
                    e = np.array([a - v, b - w])
                    near.append((e @ inverse @ e, d, value))
            assert got[key] == pytest.approx(np.mean([n[2] for n in sorted(near)[:5]]))
