from __future__ import annotations

import random
from collections import Counter

import pytest

from tessera.llm.repeats import remove_repeats

WINDOW = 40


def corpus():
    draw = random.Random(2)
    letters = "ab cé"
    passages = ["".join(draw.choices(letters, k=draw.choice([45, 80, 200]))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(draw.choice([1, 2, 4])):
            parts.append("".join(draw.choices(letters, k=draw.choice([0, 3, 60]))))
            parts.append(draw.choice(passages))
        texts.append("".join(parts))
    return [*texts, texts[0], None, "", "x" * 39, "x" * 500, "ab" * 100, "é" * 90, "z" * 40]


def expected(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    windows = Counter(t[k : k + WINDOW] for _, t in texts for k in range(len(t) - WINDOW + 1))
    out = []
    for i, text in texts:
        gone = [False] * len(text)
        for k in range(len(text) - WINDOW + 1):
            if windows[text[k : k + WINDOW]] > 1:
                gone[k : k + WINDOW] = [True] * WINDOW
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((i, len(text), sum(gone), runs, kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_equals_brute_force(small, monkeypatch, crowded):
    monkeypatch.setattr("tessera.llm.repeats.CROWDED", crowded)
    rows = [*enumerate(corpus()), (3, "y" * 41), (None, "q" * 45 + "r")]
    docs = small([(*r, 0) for r in rows], "doc_id bigint, text string, kept int")
    got = [
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in remove_repeats(docs, WINDOW).collect()
    ]
    assert sorted(got, key=repr) == expected(rows)


def test_empty_table(small):
    assert remove_repeats(small([], "doc_id bigint, text string")).count() == 0
