from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm.queries import op13_chebyshev_whitening
from tessera.llm.whitening import LARGEST, LONGEST, chebyshev, leading, ritz, whiten

SCHEMA = "vec_id bigint, embedding array<float>, component int, n string, whitened double"
NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def x_of(vector, dims, scale=64, offset=1_000_000):
    """The entries of one vector, None if it takes no part."""
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    entries = [math.floor(scale * float(np.float32(c))) for c in vector]
    clipped = [min(max(e, -LARGEST), LARGEST) + offset for e in entries]
    return tuple(clipped + [offset] * (dims - len(clipped)))


def assert_equals_brute_force(rows, df, wanted=16):
    dims = max((len(v) for _, v in rows if x_of(v, 0) is not None), default=0)
    x = [(i, x_of(v, dims)) for i, v in rows if x_of(v, dims) is not None]
    fit = np.array(sorted({v for _, v in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    away = np.array([[float(Fraction(int(a)) - Fraction(int(s), n)) for a, s in zip(r, sums)] for r in fit])
    values, turn = np.linalg.eigh(away.T @ away / n)
    values, turn = values[::-1], turn[:, ::-1]
    held = [k for k in range(min(wanted, dims)) if values[k] > values[0] * 1e-12]
    got = df.toPandas()
    assert list(got.columns) == NAMES
    assert len(got) == len(x) * len(held)
    assert (got["identity_error"] <= 1e-4).all() and got["identity_error"].nunique() <= 1
    assert (got["n"] == n).all()
    by_id = {i: v for i, v in x}
    signs = {}
    for row in got.sort_values(["component", "vec_id"]).itertuples():
        v = by_id[None if row.vec_id is None or math.isnan(row.vec_id) else int(row.vec_id)]
        k = row.component - 1
        assert row.deviation == min(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)), LONGEST)
        centred = np.array([float(Fraction(int(a)) - Fraction(int(s), n)) for a, s in zip(v, sums)])
        want = centred @ turn[:, k] / math.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(want * row.whitened) or 1)
        assert row.whitened == pytest.approx(sign * want, rel=1e-7, abs=1e-7)
        assert row.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)


def vectors(n, dims, seed=1):
    draw = np.random.default_rng(seed)
    return (draw.standard_normal((n, dims)) * np.linspace(3, 0.5, dims)).astype(np.float32).tolist()


def table(small, rows):
    return small([(i, v, 0, "", 0.0) for i, v in rows], SCHEMA)


def test_equals_brute_force_with_copies_and_odd_rows(small):
    rows = list(enumerate(vectors(300, 40)))
    rows += [(1000 + i, rows[7][1]) for i in range(150)]
    rows += [(400, None), (401, [1.0, None]), (402, [math.nan] * 40), (403, [math.inf]), (None, rows[3][1])]
    assert_equals_brute_force(rows, whiten(table(small, rows)))


def test_shorter_vectors_go_on_with_zeros(small):
    rows = list(enumerate(vectors(50, 6))) + [(90, []), (91, [1.0]), (92, [1.0, 0.0]), (93, [0.0])]
    assert_equals_brute_force(rows, whiten(table(small, rows)))


def test_repeated_rows_come_each(small):
    rows = list(enumerate(vectors(30, 5)))
    got = whiten(table(small, rows + rows))
    assert got.count() == 2 * whiten(table(small, rows)).count() == 2 * 30 * 5
    assert_equals_brute_force(rows, got.distinct())


def test_large_entries(small):
    rows = [(i, [v[0] * 1e6, v[1], v[2]]) for i, v in enumerate(vectors(40, 3))]
    assert_equals_brute_force(rows, whiten(table(small, rows)))
    rows.append((99, [3e38, 0.0, 0.0]))
    got = whiten(table(small, rows)).collect()
    assert {r.deviation for r in got if r.vec_id == 99} == {LONGEST}


def test_without_variance_there_are_no_components(small):
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])], [(1, []), (2, [])], [(1, None)]):
        got = whiten(table(small, rows or [(1, None)]).limit(len(rows)))
        assert got.columns == NAMES and got.count() == 0


def test_fewer_dimensions_than_components(small):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    got = whiten(table(small, rows))
    assert got.count() == 20
    assert_equals_brute_force(rows, got)


@pytest.mark.parametrize(
    "spectrum",
    [
        10.0 ** -np.arange(64),
        np.r_[np.ones(40), np.zeros(24)],
        np.full(64, 2.0),
        np.linspace(1, 1.01, 200),
        np.r_[np.full(15, 5.0), np.full(100, 1.0 + 1e-6), np.ones(85)],
        np.zeros(64),
    ],
)
def test_leading_pairs_of_hard_spectra(spectrum):
    dims = len(spectrum)
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((dims, dims)))[0]
    matrix_ = basis * spectrum @ basis.T
    vectors_, values = leading(lambda q: matrix_ @ q, dims, 16)
    want = np.sort(spectrum)[::-1][:16]
    assert np.abs(values - want).max() <= 1e-12 * max(want[0], 1e-300) + 1e-15
    assert np.abs(vectors_.T @ vectors_ - np.eye(16)).max() < 1e-12
    assert np.linalg.norm(matrix_ @ vectors_ - vectors_ * values, axis=0).max() <= 1e-11 * max(want[0], 1e-4)


def test_filter_is_the_chebyshev_polynomial():
    spectrum = np.linspace(0, 10, 21)
    q = np.eye(21)
    got = chebyshev(lambda y: spectrum[:, None] * y, q, None, 1.0, 6.0, 10.0, 5).diagonal()
    t = np.polynomial.chebyshev.Chebyshev.basis(5)
    want = t((spectrum - 3.5) / 2.5)
    assert got == pytest.approx(want / t((10.0 - 3.5) / 2.5), abs=1e-12)


def test_ritz_of_a_whole_space_is_exact():
    draw = np.random.default_rng(2)
    half = draw.standard_normal((12, 12))
    symmetric = half @ half.T
    _, _, values, gaps = ritz(lambda q: symmetric @ q, draw.standard_normal((12, 12)))
    assert values == pytest.approx(np.linalg.eigvalsh(symmetric)[::-1])
    assert gaps.max() < 1e-12 * values[0]


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert_equals_brute_force(rows, op13_chebyshev_whitening(spark, sf_dir))
