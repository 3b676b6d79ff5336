from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tessera.llm.archives import one_file_each
from tessera.llm.flat_tokens import dealt_blocks, scan_flat, token_counts
from tessera.llm.quality import quality, repeated_words

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "  ", "one two", "line\nline\n\n line\n", "a b c " * 30, "* # | <x>", "é世🎉 " * 40]
TEXTS += [" ".join(f"word{i}" for i in range(60)), "long " * 20000, "\x0bx\x0cy\x1cz\xa0w"]


def test_counts_equal_the_library(small):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [*enumerate(TEXTS), (3, "again"), (None, "no id")]
    docs = small([(*r, 1) for r in rows], "doc_id bigint, text string, ordinal int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts(docs, PATH).collect())
    assert got == sorted((i or 0, len(library.encode(t or ""))) for i, t in rows)
    assert token_counts(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 6, 16, 1 << 20])
@pytest.mark.parametrize("run", [1, 3, 1024])
def test_documents_across_blocks(spark, tmp_path, block_bytes, run):
    files = {
        "a": [5, 6, 7, 8, 9, 2, 2, 11, 12, 2],
        "b": [3] * 25,
        "c": [2],
        "d": [],
        "e": [4] * 9 + [2] + [5] * 4,
    }
    rows, want = [], []
    for name, ids in files.items():
        path = tmp_path / name
        path.write_bytes(np.array(ids, "<u2").tobytes())
        rows.append((f"file:{path}", 2 * len(ids)))
        start = 0
        ends = [i for i, x in enumerate(ids) if x == 2]
        for k, end in enumerate(ends):
            want.append((name, k, start, end - start, True))
            start = end + 1
        if start < len(ids):
            want.append((name, len(ends), start, len(ids) - start, False))
    table = spark.createDataFrame(rows, "file string, bytes bigint")
    got = scan_flat(table, 2, block_bytes, run).collect()
    assert sorted((r.file[-1], r.ordinal, r.start, r.n_tokens, r.terminated) for r in got) == want


def by_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside), failed,
    )


def test_base_rules_equal_brute_force(small):
    texts = [t for t in TEXTS if not t or len(t) < 5000]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(None, texts[5], True)]
    docs = small(rows, "doc_id bigint, text string, kept boolean")
    got = sorted((tuple(r)[:7] for r in quality(docs, PATH).collect()), key=repr)
    assert got == sorted(((i, *by_rules(t)) for i, t, _ in rows), key=repr)
    assert quality(docs.limit(0), PATH).count() == 0


def test_bands_reject_what_the_vocabulary_spells_out(small):
    clean = " ".join(f"{a}{b}" for a in ("over", "under", "sun") for b in ("light", "flow", "day") * 7)
    clean = "The river flows past the old town and its mills, " + clean.replace("lightflow", "light") + " "
    words = [f"{w} {i}" for i, w in enumerate(clean.split())]
    noise = " ".join(chr(0x1E00 + 7 * i % 240) * 3 for i in range(90))
    rows = quality(small([(1, " ".join(words)), (2, noise)], "doc_id bigint, text string"), PATH)
    got = {r.doc_id: (r.base_failed, r.kept) for r in rows.collect()}
    assert got == {1: (False, True), 2: (False, False)}


def test_repeated_words_of_overlapping_windows():
    assert repeated_words([b"a"] * 4) == 4
    assert repeated_words([b"a", b"b", b"c", b"d"]) == 0


def test_blocks_and_files_are_dealt_to_many_tasks(spark):
    def held(df):
        return [n for n in df.rdd.glom().map(len).collect() if n]

    files = spark.createDataFrame([(f"f{i}", 50 << 20) for i in range(8)], "file string, bytes bigint")
    tasks = held(dealt_blocks(files))
    assert sum(tasks) == 400 and len(tasks) > 30 and max(tasks) < 40
    one = held(one_file_each(files))
    assert sum(one) == 8 and len(one) >= 3
