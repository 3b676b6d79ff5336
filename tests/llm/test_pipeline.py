from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from test_decontamination import expected as hits_of
from test_lines import removed_by_brute_force
from test_near_duplicates import joined, shingles
from test_tokens import by_rules

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and returned."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, out[-1], SF_DIR).collect()
        out.append(spark.createDataFrame(rows, stage(spark, out[-1], SF_DIR).schema))
    return [[r.asDict() for r in df.collect()] for df in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_equal_brute_force(spark, stages):
    raw, good, lines, near, clean, encoded = stages
    assert {r["doc_id"] for r in good} <= {r["doc_id"] for r in raw if not by_rules(r["text"])[5]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    past_base = [r["doc_id"] for r in raw if not by_rules(r["text"])[5]]
    fine, junk = ([i in texts(good) for i in past_base if labels.get(i) == q] for q in (1, 0))
    assert sum(fine) > 0.97 * len(fine) > 0
    assert sum(junk) <= 0.1 * len(junk)
    gone = removed_by_brute_force(list(texts(good).items()))
    want = {}
    for doc_id, text in texts(good).items():
        left = [x for i, x in enumerate(text.split("\n")) if i not in gone.get(doc_id, [])]
        if any(x.split() for x in left):
            want[doc_id] = "\n".join(left)
    assert texts(lines) == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    groups = joined({i: shingles(t, 5) for i, t in want.items()})
    assert texts(near) == {i: t for i, t in want.items() if groups[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert texts(clean) == {i: t for i, t in texts(near).items() if not hits_of(i, t, items)[5]}
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in encoded} == {
        i: (sha(",".join(map(str, library.encode(t)))), sha(t)) for i, t in texts(clean).items()
    }


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_columns_stay(spark, small, stage):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"
    rows = [(1, "a b c " * 5, "en", "s", 30, "k"), (None, None, None, None, None, None)]
    docs = small(rows + rows, schema)
    assert stage(spark, docs, SF_DIR).columns == docs.columns
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    stage(spark, docs, SF_DIR).collect()
