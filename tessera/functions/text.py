"""Expressions and counts on words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that Python's str.split() takes as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


# Line ends as text files break them, then the single space.
LINE_OR_SPACE = r"\r\n|[\n\r ]"


def raw_words(text: Column) -> Column:
    """Words between single spaces within lines; case kept, empty strings kept."""
    return F.split(text, LINE_OR_SPACE)


def words(text: Column) -> Column:
    """Words between any white space, with empty strings where it is doubled or at an end.

    The caller drops empty strings after exploding: a filter on rows is part of the
    generated code, one on array elements is not. Mapping all white space to one
    character first takes half the time of splitting at a class of characters.
    """
    return F.split(F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE)), " ")


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """``word, n`` over raw words. Counts are combined before the shuffle."""
    return (
        df.select(F.explode(raw_words(F.col(column))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def normalized_word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """``word, n`` over lower-cased words split at any white space."""
    return (
        df.select(F.explode(words(F.lower(F.col(column)))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def document_word_count(df: DataFrame, key: str, column: str = "value") -> DataFrame:
    """``key, word, n`` per document."""
    return (
        df.select(key, F.explode(words(F.col(column))).alias("word"))
        .where(F.col("word") != "")
        .groupBy(key, "word")
        .agg(F.count("*").alias("n"))
    )


def merge_word_counts(per_document: DataFrame) -> DataFrame:
    """``word, n_docs, n`` from :func:`document_word_count`."""
    return per_document.groupBy("word").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n")
    )


def corpus_word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """What :func:`merge_word_counts` gives, for a table with one row per document.

    A row holds its whole document, so both counts are made from it on the spot and
    are combined before the only shuffle, which carries words rather than documents.
    Each row gives all of its words, then each of them once more.
    """
    found = df.select(words(F.col(column)).alias("found")).select(
        "found", F.size("found").alias("length")
    )
    both = F.posexplode(F.concat("found", F.array_distinct("found"))).alias("at", "word")
    every = F.col("at") < F.col("length")
    return (
        found.select("length", both)
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count_if(~every).alias("n_docs"), F.count_if(every).alias("n"))
    )
