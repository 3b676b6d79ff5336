from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tessera.llm.components import components
from tessera.llm.linking import crossing
from tessera.llm.minhash import close_enough, near_duplicates, shingle_sets, sketches


def joined(sets, percent=80):
    """Smallest id reachable over pairs of similar sets."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def shingles(text, n):
    words = (text or "").encode().lower().split()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def corpus():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [draw.choices(words, k=draw.choice([3, 30, 120, 400])) for _ in range(30)]
    texts = []
    for text in base:
        for _ in range(draw.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(draw.choice([0, 0, 1, 3, 8])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    return texts + texts[:5] + ["", " \n", "one", "ONE", "one two", "x " * 20000]


@pytest.mark.parametrize("n", [2, 5])
def test_components_equal_brute_force(small, n):
    rows = [(i, t, False) for i, t in enumerate(corpus())]
    docs = small(rows, "doc_id bigint, text string, kept boolean")
    sets = {i: shingles(t, n) for i, t, _ in rows}
    want = joined(sets)
    got = near_duplicates(docs, n).collect()
    assert sorted(tuple(r) for r in got) == [
        (i, len(sets[i]), want[i], want[i] == i) for i in sorted(sets)
    ]


def test_nulls_and_repeated_rows(small):
    text = "a b c d e f"
    rows = [(4, text), (4, text), (2, text), (None, text), (7, None), (8, "q r s t u"), (8, text)]
    got = near_duplicates(small(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got) == [
        (0, 2, None, True),
        (2, 2, 2, True),
        (4, 2, 2, False),
        (4, 2, 2, False),
        (7, 0, 7, True),
        (8, 1, 2, False),
        (8, 2, 2, False),
    ]
    assert near_duplicates(small([], "doc_id bigint, text string")).count() == 0


def test_every_bin_is_filled_and_estimates_are_close():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 1500).astype(np.uint64)
    for size in (1, 2, 50, 1000):
        a, b = np.sort(pool[:size]), np.sort(pool[size // 4 : size + size // 4])
        left, right = sketches([a, b], 512)
        assert (left < np.iinfo(np.uint64).max).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((left == right).mean() - true) < 0.12


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 20 for i in range(20, 61)}, **{i: 100 for i in range(100, 140)}}


def test_shingles_ignore_case_of_ascii_only(spark):
    import pyarrow as pa

    a, b, c = shingle_sets(pa.array(["A b É", "a B É", "a b é"]), 2)
    assert (a == b).all() and not (a == c).all()


def test_a_pair_comes_from_one_of_the_buckets_that_both_share(small):
    held = {1: [10, 11, 12], 2: [10, 11, 12], 3: [11, 12], 4: [12, 13], 5: [13]}
    major = {10: 1, 11: 1, 12: 2, 13: 4}
    rows = [
        (bucket, rep, 10, rep, major[bucket], 10, [0] * 8, buckets)
        for rep, buckets in held.items()
        for bucket in buckets
    ]
    schema = (
        "bucket bigint, rep bigint, n bigint, component bigint, major bigint, shared bigint, "
        "parity array<bigint>, buckets array<bigint>"
    )
    got = [frozenset(r) for r in crossing(small(rows, schema), close_enough, 80).collect()]
    pairs = [frozenset(p) for p in itertools.combinations(held, 2) if set(held[min(p)]) & set(held[max(p)])]
    assert sorted(map(sorted, got)) == sorted(map(sorted, pairs))
