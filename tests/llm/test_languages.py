from __future__ import annotations

import itertools
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from tessera.llm.language import UNDETERMINED, identify, predict, sampled, train, viterbi

ENGLISH = "the people of the town went with their children to the old market this morning"
GERMAN = "die leute aus der stadt gingen mit ihren kindern heute frueh auf den alten markt"
RUSSIAN = "люди из города пошли утром вместе с детьми на старый рынок"


def best_labels(scores, penalty):
    """All label sequences, the cheapest way to be sure."""
    n, k = scores.shape
    return max(
        sum(scores[i, p[i]] for i in range(n))
        - sum(penalty[i] for i in range(1, n) if p[i] != p[i - 1])
        for p in itertools.product(range(k), repeat=n)
    )


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_equals_all_sequences(seed, monkeypatch):
    monkeypatch.setattr("tessera.llm.language.STRETCH", 3)
    draw = np.random.default_rng(seed)
    n = int(draw.integers(1, 8))
    scores, penalty = draw.normal(size=(n, 3)), draw.choice([0.0, 1.0], n)
    if seed % 2:
        monkeypatch.setattr("tessera.llm.language.WINDOW_CELLS", 6)
    if seed % 4 > 1:
        monkeypatch.setattr("tessera.llm.language.SIDE_BY_SIDE", 2)
    labels = viterbi(lambda a, b: scores[a:b], penalty, 3)
    found = sum(scores[i, labels[i]] for i in range(n)) - sum(
        penalty[i] for i in range(1, n) if labels[i] != labels[i - 1]
    )
    assert found == pytest.approx(best_labels(scores, penalty))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru"), (None, "en"), ("x", None)] * 3
    return train(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_mixed_text(spark, model):
    text = " ".join([ENGLISH, GERMAN, RUSSIAN])
    row = predict(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "ru"]
    assert [s.n_words for s in row.spans] == [len(t.split()) for t in (ENGLISH, GERMAN, RUSSIAN)]
    assert row.lang_pred == "de" and 0 < row.score < 1


def test_edges(small, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !? ²", "x"), (None, ENGLISH, "x"), (4, GERMAN * 3000, "x")]
    docs = small(rows + rows[-1:], "doc_id bigint, text string, lang_pred string")
    got = sorted(
        ((r.doc_id or 0, r.lang_pred, r.score, len(r.spans)) for r in predict(docs, model).collect())
    )
    assert got == [
        (0, "en", 1.0, 1),
        (1, UNDETERMINED, 0.0, 0),
        (2, UNDETERMINED, 0.0, 0),
        (3, UNDETERMINED, 0.0, 0),
        (4, "de", 1.0, 1),
        (4, "de", 1.0, 1),
    ]


def test_script_narrows_candidates(spark, model):
    row = predict(spark.createDataFrame([(1, "зззз")], "doc_id bigint, text string"), model).first()
    assert row.lang_pred == "ru"


def test_nothing_learned_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert identify(docs).first().lang_pred == UNDETERMINED
    assert identify(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = judged.selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert right > 0.98


def test_windows_and_stretches_do_not_matter(monkeypatch):
    draw = np.random.default_rng(1)
    scores, penalty = draw.normal(size=(3000, 5)), draw.choice([0.0, 2.0], 3000, p=[0.01, 0.99])
    expected = viterbi(lambda a, b: scores[a:b], penalty, 5)
    monkeypatch.setattr("tessera.llm.language.WINDOW_CELLS", 3500)
    for stretch, wide in ((64, 64), (1, 64), (64, 1)):
        monkeypatch.setattr("tessera.llm.language.STRETCH", stretch)
        monkeypatch.setattr("tessera.llm.language.SIDE_BY_SIDE", wide)
        assert (viterbi(lambda a, b: scores[a:b], penalty, 5) == expected).all()


def test_four_hundred_languages(spark):
    """Each has words of its own; one text mixes two of them."""
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(draw.choice(letters, 6)) for _ in range(30)) for _ in range(400)]
    model = train(spark.createDataFrame(
        [(t, f"l{i:03}") for i, t in enumerate(texts)], "text string, lang string"
    ))
    assert len(model.langs) == 400
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)] + [(400, texts[7] + " " + texts[300])], "doc_id bigint, text string"
    )
    got = {r.doc_id: r for r in predict(docs, model).collect()}
    assert all(got[i].lang_pred == f"l{i:03}" for i in range(400))
    assert [s.lang for s in got[400].spans] == ["l007", "l300"]


def test_copies_are_one_text_of_the_sample(spark):
    copies = spark.range(20_000).selectExpr("'the same text' AS text", "'en' AS lang")
    others = spark.range(10_000).selectExpr("concat('text ', id) AS text", "'en' AS lang")
    few = spark.range(50).selectExpr("concat('text ', id) AS text", "'de' AS lang")
    langs, rows = sampled(copies.union(others).union(few), 3_000)
    drawn = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    assert langs == ["de", "en"]
    assert drawn["de"] == 50
    assert 2_700 < drawn["en"] < 3_300
    assert rows.distinct().count() == rows.count()


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run from another folder, with the package on the driver's path alone."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from tessera.session import get_session
from tessera.llm.language import identify
spark = get_session("alone", {{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}}}, master="local[2]")
rows = [(i, {ENGLISH!r}, "en") for i in range(9)] + [(i, {GERMAN!r}, "de") for i in range(9, 18)]
docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
print(sorted({{(r.doc_id // 9, r.lang_pred) for r in identify(docs).collect()}}))
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.strip() == "[(0, 'en'), (1, 'de')]", done.stderr[-2000:]
