from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near_duplicates import joined

from tessera.llm import lines as line_join
from tessera.llm.blocks import SET_BYTES, blocks
from tessera.llm.lines import dedup_lines, later_lines, linked_lines, sorted_sets, word_hashes


def corpus():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(200)] + ["the"] * 100
    lines = [draw.choices(words, k=draw.choice([1, 2, 5, 12, 40])) for _ in range(60)]
    docs = []
    for _ in range(60):
        text = []
        for _ in range(draw.choice([0, 1, 4, 8])):
            line = list(draw.choice(lines))
            if draw.random() < 0.5:
                line[draw.randrange(len(line))] = draw.choice(words)
            text.append(" ".join(line))
        docs.append("\n".join(text))
    return docs


def removed_by_brute_force(rows):
    sets, place = {}, []
    for doc_id, text in sorted(rows):
        for number, line in enumerate((text or "").split("\n")):
            words = frozenset(line.encode().lower().split())
            if words:
                sets[len(place)] = words
                place.append((doc_id, number))
    gone = defaultdict(list)
    for i, first in joined(sets).items():
        if i != first:
            gone[place[i][0]].append(place[i][1])
    return gone


def test_removed_lines_equal_brute_force(small):
    rows = list(enumerate(corpus()))
    gone = removed_by_brute_force(rows)
    got = later_lines(small([(*r, "x") for r in rows], "doc_id bigint, text string, line string"))
    assert {r.doc_id: r.removed for r in got.collect() if r.removed} == dict(gone)


def test_texts_lose_their_later_lines(small):
    rows = [
        (1, "one two three\n\nfour five", "a"),
        (2, "Three two one\nsix", "b"),
        (3, "six\n six ", "c"),
        (4, None, "d"),
        (5, "", "e"),
        (6, "\n", "f"),
        (None, "six\nseven", "g"),
    ]
    docs = small(rows + rows[:1], "doc_id bigint, text string, removed string")
    got = [tuple(r) for r in dedup_lines(docs).collect()]
    assert sorted(got, key=repr) == sorted(
        [rows[0], rows[0], (2, "six", "b"), *rows[3:6], (None, "seven", "g")], key=repr
    )
    assert dedup_lines(docs).columns == docs.columns
    assert dedup_lines(docs.limit(0)).count() == 0


def test_tokens_of_crowds_are_split_by_component(small, monkeypatch):
    monkeypatch.setattr(line_join, "CROWD", 5)
    draw = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    copied = draw.sample(words, 30)
    texts = []
    for i in range(80):
        line = list(copied)
        for _ in range(draw.choice([1, 2, 4, 8])):
            line[draw.randrange(30)] = draw.choice([*words, f"own{i}"])
        texts.append("\n".join([" ".join(line), " ".join(draw.choices(words[:12], k=6))]))
    rows = list(enumerate(texts))
    got = later_lines(small(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.removed for r in got.collect() if r.removed} == dict(removed_by_brute_force(rows))


def links_by_brute_force(rows):
    sets = {}
    for doc_id, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            if words := frozenset(line.encode().lower().split()):
                sets[doc_id, number] = words
    different = set(sets.values())
    alike = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    number = {x: sum(alike(x, y) for y in different) - 1 for x in different}
    return {at: number[x] for at, x in sets.items()}


@pytest.mark.parametrize("crowd", [256, 5])
def test_every_link_between_different_lines_counts(small, monkeypatch, crowd):
    monkeypatch.setattr(line_join, "LINK_CROWD", crowd)
    monkeypatch.setattr(line_join, "BLOCK_SETS", 16 if crowd == 5 else 256)
    monkeypatch.setattr(line_join, "COLUMNS", 7)
    draw = random.Random(19)
    words = [f"w{i}" for i in range(60)]
    texts = corpus()
    for base in (draw.sample(words, 30), draw.sample(words, 12)):
        for i in range(60):
            line = list(base)
            for _ in range(draw.choice([0, 1, 2, 3])):
                line[draw.randrange(len(line))] = draw.choice([*words, f"own{i}"])
            texts.append(" ".join(line) + "\n" + " ".join(draw.choices(words[:9], k=5)))
    rows = list(enumerate(texts))
    got = linked_lines(small(rows + rows[:9], "doc_id bigint, text string")).collect()
    want, gone = links_by_brute_force(rows), removed_by_brute_force(rows)
    assert sum(want.values()) > 2000
    assert {r.doc_id: r.removed for r in got if r.removed} == dict(gone)
    found = {(r.doc_id, x.line): x.n_links for r in got for x in r.linked}
    assert {at: n for at, n in found.items() if n} == {at: n for at, n in want.items() if n}
    for r in got:
        assert r.n_links == sum(want[r.doc_id, x.line] for x in r.linked)
        removed = [x for x in r.linked if (x.class_doc, x.class_line) != (r.doc_id, x.line)]
        assert [x.line for x in removed] == r.removed


def test_sets_of_crowds_that_differ_are_not_sent(small, monkeypatch):
    """A common word does not bring the texts of all that have it together."""
    monkeypatch.setattr(line_join, "LINK_CROWD", 5)
    sent = []
    real = line_join.crowd_links
    monkeypatch.setattr(
        line_join, "crowd_links", lambda members, texts: sent.append(members.count()) or real(members, texts)
    )
    draw = random.Random(29)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(draw.sample(words, 20))) for i in range(300)]
    rows += [(300, rows[0][1] + " more"), (301, rows[1][1] + " own")]
    got = linked_lines(small(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_links for r in got if r.n_links} == {0: 1, 1: 1, 300: 1, 301: 1}
    assert sent == [0]


def test_links_of_crowds_in_parts_and_blocks(small, monkeypatch):
    for name, value in {
        "LINK_CROWD": 5, "MEET_SETS": 20, "MEET_ROWS": 64, "MEET_CELLS": 100,
        "DENSE": 1, "BLOCK_SETS": 8, "BLOCK_PARTS": 2,
    }.items():
        monkeypatch.setattr(line_join, name, value)
    draw = random.Random(31)
    words = [f"w{i}" for i in range(60)]
    base, texts = draw.sample(words, 30), corpus()
    for i in range(90):
        line = list(base)
        for _ in range(draw.choice([1, 2, 3])):
            line[draw.randrange(len(line))] = draw.choice([*words, f"own{i}"])
        texts.append(" ".join(line))
    rows = list(enumerate(texts))
    got = linked_lines(small(rows + rows[-3:], "doc_id bigint, text string")).collect()
    found = {(r.doc_id, x.line): x.n_links for r in got for x in r.linked}
    want = links_by_brute_force(rows)
    assert {at: n for at, n in found.items() if n} == {at: n for at, n in want.items() if n}
    assert {r.doc_id: r.removed for r in got if r.removed} == dict(removed_by_brute_force(rows))


def test_long_lines_that_differ_are_no_pairs(small):
    """Sixty-four bits let half of the pairs of lines of 150 words through that share one word."""
    draw = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(draw.sample(words, 150)) for _ in range(60)]
    alike = [texts[0].split()[:140] + draw.sample(words, 10), texts[1].split()[12:] + ["own"]]
    rows = list(enumerate([*texts, *map(" ".join, alike), " ".join(texts[2].split()[:127])]))
    docs = line_join.keyed(small(rows, "doc_id bigint, text string"), "doc_id", "text")
    sets = line_join.line_rows(docs).withColumnRenamed("doc_id", "rep")
    assert sets.where("n >= 128 AND (half IS NULL OR fourth IS NULL)").count() == 0
    left = sets.select(F.col("rep").alias("a"), *line_join.sided("n", *line_join.BITS))
    pairs = left.crossJoin(sets).where(F.col("a") < F.col("rep"))
    found = {(r.a, r.rep) for r in pairs.where(line_join.sizes_fit()).collect()}
    assert found >= {(0, 60), (1, 61), (2, 62)}
    assert len(found) < 20


def test_rows_without_wanted_lines_are_not_sent(small):
    rows = small([(i, (-1) ** i * i * 10**12) for i in range(300)] + [(300, None)], "v int, content bigint")
    wanted = rows.where("v % 50 = 0 AND v < 300").select("content")
    left = {r.v for r in line_join.maybe_in(rows, "content", wanted).collect()}
    assert left >= {0, 50, 100, 150, 200, 250}
    assert len(left) < 20


def test_passes_find_the_links_of_one(small, monkeypatch):
    rows = list(enumerate(corpus()))
    docs = small(rows, "doc_id bigint, text string")
    once = sorted(map(repr, linked_lines(docs).collect()))
    monkeypatch.setattr(line_join, "PASSES", 3)
    monkeypatch.setattr(line_join, "HALVED", 3)
    monkeypatch.setattr(line_join, "QUARTERED", 8)
    assert sorted(map(repr, linked_lines(docs).collect())) == once


def test_lines_of_crowds_that_meet_leaders_first(small, monkeypatch):
    monkeypatch.setattr(line_join, "CROWD", 5)
    sent = []
    real = line_join.close
    monkeypatch.setattr(line_join, "close", lambda pairs, texts: sent.append(pairs.count()) or real(pairs, texts))
    draw = random.Random(23)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(120):
        line = list(base)
        for _ in range(2):
            line[draw.randrange(40)] = f"x{draw.randrange(300)}"
        texts.append(" ".join(line))
    rows = list(enumerate(texts))
    got = later_lines(small(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.removed for r in got.collect() if r.removed} == dict(removed_by_brute_force(rows))
    assert sum(sent) < 120 * (line_join.PARTS + line_join.LEADERS), sent


def test_words_are_told_apart_as_bytes(monkeypatch):
    monkeypatch.setattr(line_join, "HASHED_BYTES", 7)
    draw = random.Random(3)
    texts = ["".join(draw.choices("aBé \t\x0b\x1c\u2003", k=draw.randrange(12))) for _ in range(400)]
    found, counts = word_hashes(pa.array([None, "", *texts]))
    own = [t.encode().lower().split() for t in ["", "", *texts]]
    assert counts.tolist() == [len(w) for w in own]
    names = dict(zip(found.tolist(), (w for words in own for w in words)))
    assert [names[h] for h in found.tolist()] == [w for words in own for w in words]
    assert len(set(names.values())) == len(names)


def test_sorted_sets_equal_unique():
    draw = np.random.default_rng(2)
    counts = draw.integers(1, 9, 50)
    words = draw.integers(0, 6, counts.sum()).astype(np.uint64)
    sets, n = sorted_sets(words, counts)
    expected = [np.unique(w) for w in np.split(words, np.cumsum(counts)[:-1])]
    assert n.tolist() == [len(e) for e in expected]
    assert sets.tolist() == np.concatenate(expected).tolist()


def test_words_of_large_batches_take_bounded_memory():
    text = "some words of a line that repeats\n" * 30
    batch = pa.RecordBatch.from_arrays([pa.array([text] * (16 << 20 >> 10))], names=["text"])
    tracemalloc.start()
    for block in blocks([batch], "text", SET_BYTES):
        line_join.line_words(block.column("text"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * SET_BYTES
