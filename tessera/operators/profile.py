"""Shape, statistics and validation of a table; no column is read twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType, StringType


def table_shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_columns``."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


DESCRIBED = (
    "column string, n bigint, mean double, stddev double, min_value double, max_value double, "
    "min_whole bigint, max_whole bigint, min_text string, max_text string"
)


def describe_long(df: DataFrame) -> DataFrame:
    """Typed statistics, one row per numeric or string column.

    Numbers and strings are aggregated apart, each from a scan of its own columns: with
    strings among them, no aggregate could be hashed. Only the result row of an aggregate is
    turned into one row per column. Integer columns have their exact ends in
    ``min_whole`` and ``max_whole`` as well. A table without such columns has no rows.
    """
    kinds = [(f.name, f.dataType) for f in df.schema.fields]
    parts = [
        _described(df, [(i, *kind) for i, kind in enumerate(kinds) if isinstance(kind[1], family)])
        for family in (NumericType, StringType)
    ]
    parts = [part for part in parts if part is not None]
    if not parts:
        return df.sparkSession.createDataFrame([], DESCRIBED)
    return reduce(DataFrame.unionByName, parts)


def _described(df: DataFrame, fields: list[tuple[int, str, DataType]]) -> DataFrame | None:
    none = F.lit(None)
    stats, rows = [], []
    for i, name, kind in fields:
        numeric, whole = isinstance(kind, NumericType), isinstance(kind, IntegralType)
        column = F.col(f"`{name}`")
        stats += [
            F.count(column).alias(f"n{i}"),
            F.min(column).alias(f"min{i}"),
            F.max(column).alias(f"max{i}"),
        ]
        if numeric:
            stats += [F.avg(column).alias(f"avg{i}"), F.stddev(column).alias(f"std{i}")]
        low, high = F.col(f"min{i}"), F.col(f"max{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"n{i}").alias("n"),
                (F.col(f"avg{i}") if numeric else none).cast("double").alias("mean"),
                (F.col(f"std{i}") if numeric else none).cast("double").alias("stddev"),
                (low if numeric else none).cast("double").alias("min_value"),
                (high if numeric else none).cast("double").alias("max_value"),
                (low if whole else none).cast("bigint").alias("min_whole"),
                (high if whole else none).cast("bigint").alias("max_whole"),
                (none if numeric else low).cast("string").alias("min_text"),
                (none if numeric else high).cast("string").alias("max_text"),
            )
        )
    return df.agg(*stats).select(F.inline(F.array(*rows))) if rows else None


def vector_length_check(df: DataFrame, column: str, expected: int) -> DataFrame:
    """``n_rows, min_length, max_length, n_wrong`` over all vectors; null counts as wrong."""
    length = F.size(column)
    wrong = F.col(column).isNull() | (length != expected)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.min(F.when(F.col(column).isNotNull(), length)).alias("min_length"),
        F.max(F.when(F.col(column).isNotNull(), length)).alias("max_length"),
        F.count_if(wrong).alias("n_wrong"),
    )
