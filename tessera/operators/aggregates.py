"""Grouped statistics, ordered picks and lists per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.workspace import materialize


def grouped_means(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, avg_<column>...``"""
    return df.groupBy(f"`{key}`").agg(*(F.avg(f"`{c}`").alias(f"avg_{c}") for c in columns))


def grouped_range_stats(
    df: DataFrame, key: str, date: Column, measures: Sequence[str]
) -> DataFrame:
    """First and last date, and min, max and mean of each measure, per key."""
    stats = [F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    for c in measures:
        stats += [
            F.min(f"`{c}`").alias(f"min_{c}"),
            F.max(f"`{c}`").alias(f"max_{c}"),
            F.avg(f"`{c}`").alias(f"avg_{c}"),
        ]
    return df.groupBy(f"`{key}`").agg(*stats)


def first_last(
    df: DataFrame, key: str, value: str, order: Sequence[str], ignore_nulls: bool = False
) -> DataFrame:
    """``key, first_value, last_value`` by an explicit total order.

    ``min_by`` and ``max_by`` combine before the shuffle, so no group is sorted. With a
    single number or time as the order, and a number as the value, they also hash.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if ignore_nulls:
        position = F.when(F.col(value).isNotNull(), position)
    return df.groupBy(key).agg(
        F.min_by(value, position).alias("first_value"),
        F.max_by(value, position).alias("last_value"),
    )


LIST_ROWS = 10_000


def collect_values(
    df: DataFrame, key: str, value: str, list_rows: int = LIST_ROWS
) -> DataFrame:
    """``key, chunk, items``: the sorted non-null values of each key, in chunks.

    Chunk ``i`` of a key holds its values from place ``i * list_rows`` on, so chunks
    put together in order are the sorted list, for every key and size. Rows are dealt
    out by ranges of key and value, and places are counted per range; a key with most
    of the rows is spread over many tasks.
    """
    present = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{value}`").alias("_value")).where(
        "_value IS NOT NULL"
    )
    ranged = materialize(
        present.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange("_key", "_value", "_tie")
        .withColumn("_range", F.spark_partition_id()),
        "ranged-values",
    )
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_key", "_range")
        .agg(F.count("*").alias("_n"))
        .select("_key", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        .withColumnsRenamed({"_key": "_of_key", "_range": "_of_range"})
    )
    here = F.row_number().over(Window.partitionBy("_key", "_range").orderBy("_value", "_tie"))
    same = F.col("_key").eqNullSafe(F.col("_of_key")) & (F.col("_range") == F.col("_of_range"))
    return (
        ranged.withColumn("_here", here)
        .join(offsets, same)
        .withColumn("chunk", F.floor((F.col("_before") + F.col("_here") - 1) / list_rows).cast("int"))
        .groupBy(F.col("_key").alias(key), "chunk")
        .agg(F.array_sort(F.collect_list("_value")).alias("items"))
    )


def collect_distinct(
    df: DataFrame, key: str, value: str, list_rows: int = LIST_ROWS
) -> DataFrame:
    """:func:`collect_values` over distinct values; repeats go before the shuffle."""
    return collect_values(df.select(f"`{key}`", f"`{value}`").distinct(), key, value, list_rows)


def most_frequent(df: DataFrame, column: str) -> object | None:
    """The non-null value with most rows, the smallest of equals."""
    top = (
        df.select(F.col(f"`{column}`").alias("_value"))
        .where("_value IS NOT NULL")
        .groupBy("_value")
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), F.asc("_value"))
        .first()
    )
    return None if top is None else top[0]
