"""CSV, JSON and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    header: bool = False,
    schema: StructType | str | None = None,
    infer: bool = False,
    mode: str = "PERMISSIVE",
    multiline: bool = False,
) -> DataFrame:
    """CSV in any of three schema modes.

    Without ``schema`` and ``infer`` every column is a string, named ``_c0`` on when
    there is no header. A declared schema maps by position and, in PERMISSIVE mode,
    turns cells that do not parse into nulls. ``infer`` costs one more pass. Cells
    with line ends need ``multiline``, which reads each file in one task.
    """
    return spark.read.csv(
        path,
        sep=sep,
        header=header,
        schema=schema,
        inferSchema=infer,
        mode=mode,
        multiLine=multiline,
        escape='"',
    )


def read_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """JSON lines; a declared schema saves the inference pass."""
    return spark.read.json(path, schema=schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or a folder of part files."""
    return spark.read.parquet(path)


def rename_dotted(df: DataFrame, replacement: str = "_") -> DataFrame:
    """Rename columns such as ``market.cap``, which else need back-quotes everywhere."""
    renames = {name: name.replace(".", replacement) for name in df.columns if "." in name}
    return df.withColumnsRenamed(renames)
