from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tessera.llm.topk import LONGEST, Postings, best_of, top_k

SCHEMA = "vec_id bigint, embedding array<float>, score bigint, rank int"


def brute_force(rows, k=5, every=50, scale=256):
    """Sorted rows of the result; ``rows`` are ``vec_id, vector``."""
    good = []
    for vec_id, vector in rows:
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((vec_id, [math.floor(scale * np.float32(x).astype(float)) for x in vector]))
    out = []
    for i, (query_id, query) in enumerate(good):
        if query_id is None or query_id % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(query, w)), vec_id is None, vec_id or 0, j)
            for j, (vec_id, w) in enumerate(good)
            if j != i
        )
        out += [
            (query_id, rank, None if null else vec_id, -score)
            for rank, (score, null, vec_id, _) in enumerate(scored[:k], 1)
        ]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, dims=8, zeros=0.0, seed=1):
    draw = random.Random(seed)
    return [
        [0.0 if draw.random() < zeros else draw.gauss(0, 0.1) for _ in range(dims)] for _ in range(n)
    ]


@pytest.mark.parametrize("zeros", [0.0, 0.3, 0.9])
def test_equals_brute_force_over_many_blocks(small, zeros):
    rows = list(enumerate(vectors(400, zeros=zeros)))
    table = small([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = top_k(table, every=7, block_rows=90, query_rows=20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(got) == brute_force(rows, every=7)


def test_odd_rows(small):
    rows = list(enumerate(vectors(60)))
    rows += [(0, rows[0][1]), (None, rows[1][1]), (None, rows[2][1]), (100, rows[3][1])] * 2
    rows += [(150, None), (151, [0.1, None]), (200, [math.nan]), (201, [math.inf, 1.0]), (250, [])]
    rows += [(300, [1.0]), (301, [0.5] * 12), (302, [0.0] * 8)]
    table = small([(i, v, 0, 0) for i, v in rows], SCHEMA)
    assert found(top_k(table)) == brute_force(rows)


def test_ties_go_to_the_smaller_id(small):
    rows = [(i, [0.25, 0.5]) for i in range(80, -1, -1)]
    got = found(top_k(small([(i, v, 0, 0) for i, v in rows], SCHEMA), block_rows=9))
    assert got == brute_force(rows)
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]


def test_few_rows_and_none(small):
    one = small([(0, [1.0], 0, 0)], SCHEMA)
    assert found(top_k(one)) == found(top_k(one.limit(0))) == []
    two = small([(0, [1.0], 0, 0), (1, [2.0], 0, 0)], SCHEMA)
    assert found(top_k(two)) == [(0, 1, 1, 256 * 512)]


def test_weights_beyond_longs(small):
    rows = [(0, [3e38, -3e38]), (1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 1.0])]
    got = found(top_k(small([(i, v, 0, 0) for i, v in rows], SCHEMA)))
    assert [(r[2], r[3]) for r in got] == [(1, LONGEST), (3, -256), (2, -LONGEST - 1)]


def test_postings_of_rare_and_common_terms():
    rows = [np.array(r, np.int64) for r in ([1, 0, 5], [2, 0, 0], [3, 7, 0], [4, 0, 0], [])]
    postings = Postings(rows)
    assert postings.lists[0][0] is None
    assert postings.lists[1][0].tolist() == [2]
    assert postings.scores(np.array([1, -1, 2, 9])).tolist() == [11, 2, -4, 4, 0]
    assert best_of(np.array([3, 9, 3, 3]), np.array([2, 0, 1, 3]), 2).tolist() == [1, 2]
