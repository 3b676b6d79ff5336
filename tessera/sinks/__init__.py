"""Writers. Mode names are Spark's; ``save`` keeps Spark's default, error-if-exists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


STORED_LABEL = "_label"


def _project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    return df if columns is None else df.select(*columns)


def write_parquet(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    _project(df, columns).write.mode(mode).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    *,
    header: bool = True,
    sep: str = ",",
    mode: str = "errorifexists",
) -> None:
    """Cells keep their white space, quotes and line ends; read them with ``multiline``."""
    _project(df, columns).write.mode(mode).csv(
        path,
        header=header,
        sep=sep,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def save(
    df: DataFrame, path: str, fmt: str, columns: Sequence[str] | None = None
) -> None:
    """Write in any format Spark knows; a second run on the same path fails."""
    _project(df, columns).write.save(path, format=fmt)


def write_json(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    save(df, path, "json", columns)


def write_text(
    df: DataFrame, path: str, column: str = "value", line_end: str | None = None
) -> None:
    """One string column as text, one line per row.

    A value that holds a line end would come back as several: without ``line_end``
    the write fails on it, else each line end is replaced by that text.
    """
    value = F.col(f"`{column}`")
    if line_end is None:
        broken = F.raise_error(F.lit("a value holds a line end")).cast("string")
        value = F.when(value.rlike(r"[\r\n]"), broken).otherwise(value)
    else:
        value = F.regexp_replace(value, F.lit(r"\r\n|\r|\n"), F.lit(re.sub(r"([\\$])", r"\\\1", line_end)))
    df.select(value.alias(column)).write.text(path)


def write_by_label(
    df: DataFrame,
    path: str,
    label: str = "label",
    *,
    files_per_label: int | None = None,
    spread_by: str | None = None,
    mode: str = "overwrite",
) -> None:
    """``path/<label>=<value>/`` folders, one per label that has rows.

    The files hold the label as well, so that :func:`read_by_label` returns it as it
    was, be it ``001``, empty or null.

    By default each task writes what it holds and nothing is shuffled. With
    ``files_per_label`` the rows of every label are spread over up to that many tasks
    by the hash of ``spread_by``, so a label with most of the rows is not one task.
    """
    if files_per_label is not None:
        if spread_by is None:
            raise ValueError("files_per_label needs a column to spread by")
        salt = F.pmod(F.xxhash64(spread_by), F.lit(files_per_label))
        df = df.repartition(F.col(label), salt)
    stored = df.withColumn(STORED_LABEL, F.col(f"`{label}`"))
    stored.write.mode(mode).partitionBy(label).parquet(path)


def read_by_label(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    """The rows of all folders of :func:`write_by_label`, the label last and of its own type."""
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return stored.withColumnRenamed(STORED_LABEL, label)
