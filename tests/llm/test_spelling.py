from __future__ import annotations

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import spelling
from tessera.llm.spelling import Cell, near_words, spelling_variants

TO_LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def words_of(rows, least=7):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if digest % 31 == 0:
                at = digest % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows):
    n = {w: c for w, c in words_of(rows).items() if c >= 2}
    near = collections.defaultdict(list)
    for a, b in itertools.permutations(n, 2):
        if abs(len(a) - len(b)) <= 1 and is_near(a, b):
            near[a].append(b)
    form = {}
    for a in n:
        best = min(near[a], key=lambda b: (-n[b], b), default=None)
        form[a] = best if best is not None and n[best] >= 10 * n[a] else None
    out = []
    for a in n:
        root = a
        while form[root] is not None:
            root = form[root]
        out.append((a, form[a], root, n[a], len(near[a]), n.get(form[a])))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed=5):
    """Words of few letters, so that many are near and many are anagrams; chains of forms."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcé×Ü", k=draw.choice([7, 7, 8, 9]))) for _ in range(120)]
    rows = [(i, " ".join(draw.choices(vocabulary, k=60))) for i in range(80)]
    rows += [(900, "common" * 2 + " " + "chained " * 400 + "chainxd " * 40 + "chaixxd " * 4)]
    return rows


def test_equals_brute_force(small):
    rows = corpus()
    rows += [(None, "nobody nobodies nobodies"), (None, None), (901, None), (902, ""), (903, "short 12")]
    rows += [(904, "Straße" * 30_000 + " " + "Straße" * 30_000), (905, "ÀÉÎÕÜÿ× àéîõüÿ÷ " * 3)]
    rows += rows[:5]
    docs = small([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int")
    want = brute_force(rows)
    assert found(spelling_variants(docs)) == want
    assert any(w[1] and w[2] != w[1] for w in want)
    cells = spelling_variants(docs, cell_words=12, most_sampled=100_000)
    assert found(cells) == want
    assert found(spelling_variants(docs, cell_words=12, most_sampled=60)) == want


def test_empty_table(small):
    docs = small([(1, "a b")], "doc_id bigint, text string")
    assert found(spelling_variants(docs)) == found(spelling_variants(docs.limit(0))) == []


def test_ties_take_the_first_form(small):
    text = "letterb " * 20 + "letterc " * 20 + "letterz " * 2
    doc_id = next(i for i in range(99) if len(words_of([(i, text)])) == 3)
    docs = small([(doc_id, text)], "doc_id bigint, text string")
    assert found(spelling_variants(docs))[-1][:3] == ("letterz", "letterb", "letterb")


@pytest.mark.parametrize("leaf", [1, 7, 500])
def test_cells_find_every_near_word_once(monkeypatch, leaf):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    draw = random.Random(leaf)
    words = sorted({"".join(draw.choices("abcdß", k=7)) for _ in range(400)})
    shorter = sorted({"".join(draw.choices("abcdß", k=6)) for _ in range(200)})
    cell = Cell(pa.array(words), pa.array(np.ones(len(words), int)))
    held = cell.words.to_pylist()
    got = [(held[a], held[b]) for i, j in cell.near(cell.words, 0) for a, b in zip(i, j)]
    want = {frozenset(p) for p in itertools.combinations(words, 2) if is_near(*p)}
    assert len(got) == len(want) and {frozenset(p) for p in got} == want
    got = [(shorter[a], held[b]) for i, j in cell.near(pa.array(shorter)) for a, b in zip(i, j)]
    want = {(a, b) for a in shorter for b in words if is_near(a, b)}
    assert len(got) == len(want) and set(got) == want


def test_words_of_many_cells_meet_once(spark):
    draw = random.Random(9)
    words = sorted({"".join(draw.choices("abcde", k=draw.choice([7, 8]))) for _ in range(900)})
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint").repartition(5)
    got = [frozenset((r.a, r.b)) for r in near_words(table, cell_words=20).collect()]
    want = {frozenset(p) for p in itertools.combinations(words, 2) if is_near(*p)}
    assert len(got) == len(want) and set(got) == want
