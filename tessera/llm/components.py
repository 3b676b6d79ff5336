"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.workspace import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(a, b) AS decimal(20)))")).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (``a, b``): the smallest id reachable.

    Each round turns links towards the smallest neighbour, first of the larger and
    then of the smaller ones; hubs are joined to their minimum, never gathered.
    Links to null and of an id to itself connect nothing.
    """
    edges = materialize(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        large = materialize(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = materialize(small, "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("a")).distinct()
    return edges.union(roots.select("a", F.col("a").alias("b"))).select(
        F.col("a").alias("id"), F.col("b").alias("component")
    )
