from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm.quality import keep_quality, quality
from tessera.workspace import materialize

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, materialize(quality(docs, PATH), "judged")


def test_labelled_junk_goes_and_clean_texts_stay(spark, judged):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    rows = judged[1].where("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.kept for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.1
    assert share[1] > 0.97


def test_rows_that_stay_are_those_kept(judged):
    docs, rows = judged
    kept = sorted(r.doc_id for r in rows.where("kept").select("doc_id").collect())
    assert sorted(r.doc_id for r in keep_quality(docs, PATH).select("doc_id").collect()) == kept


def test_copies_do_not_narrow_their_kind(judged):
    docs, rows = judged
    kept = rows.where("kept").join(docs.select("doc_id", "text"), "doc_id")
    one = kept.orderBy("doc_id").select("doc_id").first().doc_id
    many = docs.where(F.col("doc_id") == one).crossJoin(docs.sparkSession.range(5_000).select()).drop("id")
    again = quality(docs.unionByName(many), PATH).where(F.col("doc_id") != one)
    other = rows.where(F.col("doc_id") != one)
    assert again.select("doc_id", "kept").exceptAll(other.select("doc_id", "kept")).count() == 0


def test_extra_columns_keep_their_names(small):
    text = " ".join(f"word{i} of a plain text" for i in range(30))
    docs = small([(1, text, "en", "k"), (2, None, None, None)], "doc_id bigint, text string, lang string, `a.b` string")
    kept = keep_quality(docs, PATH)
    assert kept.columns == docs.columns
    assert all(r["a.b"] == "k" for r in kept.collect())
