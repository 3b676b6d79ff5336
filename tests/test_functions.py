from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import paths, text
from tessera.functions.predicates import not_any_of

CORPUS = {
    "a": "rain over hills",
    "b": "wind and rain and snow",
    "c": "hills under wind",
    "d": "quiet and dark",
}


def counts(df):
    return {r.word: r.n for r in df.collect()}


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc long, value string")


def test_corpus_counts(spark):
    corpus = documents(spark, CORPUS.values())
    expected = Counter(" ".join(CORPUS.values()).split())
    assert counts(text.word_count(corpus)) == expected
    assert counts(text.normalized_word_count(corpus)) == expected
    per_document = text.document_word_count(corpus, "doc")
    assert {(r.doc, r.word): r.n for r in per_document.collect()}[1, "and"] == 2
    merged = {r.word: (r.n_docs, r.n) for r in text.merge_word_counts(per_document).collect()}
    assert merged["and"] == (2, 3)
    assert sum(n for _, n in merged.values()) == 14
    assert {r.word: (r.n_docs, r.n) for r in text.corpus_word_count(corpus).collect()} == merged


def test_split_rules(spark):
    assert counts(text.word_count(documents(spark, ["a  b a "]))) == {"": 2, "a": 2, "b": 1}
    assert counts(text.normalized_word_count(documents(spark, ["a  b\tA "]))) == {"a": 2, "b": 1}
    assert counts(text.word_count(documents(spark, ["a b\nb\r\nc"]))) == {"a": 1, "b": 2, "c": 1}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet="aB \t\n\x0b\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200b", max_size=12),
        min_size=1,
        max_size=20,
    )
)
def test_words_split_as_python_does(spark, texts):
    expected = Counter(w for t in texts for w in t.split())
    per_document = text.document_word_count(documents(spark, texts), "doc")
    total = Counter()
    for row in per_document.collect():
        assert row.n == texts[row.doc].split().count(row.word)
        total[row.word] += row.n
    assert total == expected


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column).first()[0]


def test_paths(spark):
    label = paths.path_label("v")
    assert one(spark, label, "file:/x/Apple Red 1/0_100.jpg") == "Apple Red 1"
    assert one(spark, label, "a") is None
    assert one(spark, paths.normalize_path("v"), "a\\b\\c.jpg") == "a/b/c.jpg"
    assert one(spark, paths.flat_name("v"), "Apple Red/1.jpg") == "Apple_Red_1.jpg"
    assert one(spark, paths.is_object_uri("v"), "s3://b/k") is True
    assert one(spark, paths.is_object_uri("v"), "/s3/b/k") is False
    assert one(spark, paths.uri_bucket("v"), "s3://b/k/l m.txt") == "b"
    assert one(spark, paths.uri_key("v"), "s3://b/k/l m.txt") == "k/l m.txt"
    assert one(spark, paths.object_key("v", F.lit("5"), "jpg"), "Kiwi") == "Kiwi/5.jpg"
    assert one(spark, paths.byte_size("v"), "é") == 2


def test_exclusion_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r.v for r in df.where(not_any_of(F.col("v"), ["a"])).collect()] == ["b", None]


def test_conditional_and_regex_flag(spark):
    df = spark.createDataFrame([(1.0,), (250.0,), (None,), (200.0,)], "v double")
    flags = df.select(F.when(df.v >= 200.0, 1).otherwise(0).alias("f")).collect()
    assert [r.f for r in flags] == [0, 1, 0, 1]
    names = spark.createDataFrame([("A, x",), ("Basic",), (" sp",), ("C",)], "v string")
    starts = names.select(names["v"].rlike("^[B, C]").alias("f")).collect()
    assert [r.f for r in starts] == [False, True, True, True]
