"""Word counts over whole documents."""

from pyspark.sql import DataFrame, SparkSession

from tessera.functions import text
from tessera.plans.registry import query, table

# White space as a pattern, for the SQL.
ANY_SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    rf"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '{text.LINE_OR_SPACE}')) AS word FROM documents)
    GROUP BY word
    """
)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(_documents(spark, sf_dir), "text")


@query(
    rf"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(lower(text), '{ANY_SPACE}')) AS word
          FROM documents)
    WHERE word <> '' GROUP BY word
    """
)
def word_count_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.normalized_word_count(_documents(spark, sf_dir), "text")


@query(
    rf"""
    SELECT word, count(*) AS n_docs, cast(sum(n) AS bigint) AS n
    FROM (SELECT doc_id, word, count(*) AS n
          FROM (SELECT doc_id, unnest(string_split_regex(text, '{ANY_SPACE}')) AS word
                FROM documents)
          WHERE word <> '' GROUP BY doc_id, word)
    GROUP BY word
    """
)
def word_count_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.corpus_word_count(_documents(spark, sf_dir), "text")


@query(
    rf"""
    SELECT doc_id, word, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split_regex(text, '{ANY_SPACE}')) AS word
          FROM documents)
    WHERE word <> '' GROUP BY doc_id, word
    """
)
def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.document_word_count(_documents(spark, sf_dir), "doc_id", "text")
