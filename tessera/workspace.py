"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A table written there survives the loss of executors, cuts the lineage, and has
a known size on disk, so Catalyst broadcasts it in a later join only when that
size is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; where none is named, local mode has one beside its warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", context.master):
                raise RuntimeError(
                    "spark.checkpoint.dir must name a folder that all executors share"
                )
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is run inside as soon as it has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back from the shared folder; its shuffle files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (made := _made.get()) is not None:
        made.append(path)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_alone(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """:func:`materialize` of what ``build`` returns; the tables it wrote on the way are deleted."""
    made: list[str] = []
    token = _made.set(made)
    try:
        df = build()
    finally:
        _made.reset(token)
    table = materialize(df, name)
    context = df.sparkSession.sparkContext
    for path in made:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return table


def materialize_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize`, and aggregates of the rows as they are written: no pass of their own."""
    seen = Observation()
    table = materialize(df.observe(seen, *(m.alias(n) for n, m in measures.items())), name)
    return table, seen.get
