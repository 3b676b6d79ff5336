"""Exact top-k search: every posting of every query's terms, one term at a time.

A vector is a sparse row of integer weights; its terms are the components that are not
zero. Candidates are dealt into blocks and turned into postings there. A query adds its
weight times each posting of a term to an array with one score for each candidate of the
block, term after term, and keeps the k best by partition selection; the best of all
blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.workspace import materialize

# Candidates of a block, and queries that meet it in one task.
BLOCK_ROWS = 8_192
QUERY_ROWS = 2_048

# Postings of a term that most candidates have are a score array of their own.
DENSE = 0.5
LONGEST = 2**63 - 1


def weights(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null for vectors that take no part.

    Those are null or hold a null or a component that is not finite, or not once scaled.
    Beyond the range of a long a weight is its end.
    """
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    good = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(scaled, as_long))


def as_long(x: Column) -> Column:
    top = F.lit(float(2**63))
    return (
        F.when(x >= top, F.lit(LONGEST)).when(x < -top, F.lit(-LONGEST - 1)).otherwise(F.floor(x))
    )


class Postings:
    """Of a block of candidates: for each term the rows that have it and their weights."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        sizes = np.array([len(r) for r in rows])
        self.dims = int(sizes.max(initial=0))
        flat = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        at = np.repeat(np.arange(self.n), sizes)
        term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        used = np.flatnonzero(flat)
        used = used[np.argsort(term[used], kind="stable")]
        self.ends = np.cumsum(np.bincount(term[used], minlength=self.dims)).tolist()
        self.rows, self.weights = at[used], flat[used]
        self.largest = max(map(abs, (int(flat.max(initial=0)), int(flat.min(initial=0)))))
        self.lists = [self._of(t) for t in range(self.dims)]

    def _of(self, term: int) -> tuple[np.ndarray | None, np.ndarray]:
        first = self.ends[term - 1] if term else 0
        rows, held = self.rows[first : self.ends[term]], self.weights[first : self.ends[term]]
        if len(rows) <= DENSE * self.n:
            return rows, held
        every = np.zeros(self.n, np.int64)
        every[rows] = held
        return None, every

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner products with all candidates; Python's integers where longs may not do."""
        largest = max(map(abs, (int(query.max(initial=0)), int(query.min(initial=0)))))
        exact = self.largest * largest * max(self.dims, 1) <= LONGEST
        scores = np.zeros(self.n, np.int64 if exact else object)
        part = np.empty(self.n, np.int64)
        for term in np.flatnonzero(query[: self.dims]).tolist():
            rows, held = self.lists[term]
            weight = int(query[term])
            if not exact:
                held = held.astype(object)
            if rows is not None:
                scores[rows] += weight * held
            elif exact:
                scores += np.multiply(held, weight, out=part)
            else:
                scores += weight * held
        return scores


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores, ties to the smaller place in ``ids``, in order."""
    here = np.arange(len(scores))
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        here = np.flatnonzero(scores >= cut)
    return np.array(sorted(here, key=lambda r: (-scores[r], ids[r]))[:k], dtype=int)


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each query, exactly.

    Queries are the rows whose ``vec_id`` ``every`` divides; candidates are all other rows.
    Equal scores go by the smaller ``vec_id``, null last. Vectors that :func:`weights`
    leaves out are neither. A shorter vector has no terms beyond its length, an empty one
    scores 0. Repeated rows are rows of their own: each is a candidate of the other, and
    each repeated query has its ranks. A score beyond the range of a long is its end, in
    the order of the exact scores within a block. An empty table, or one without queries,
    gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), weights(F.col(column), scale).alias("w")
    ).where("w IS NOT NULL")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "weights")
    is_query = F.col("vec_id") % every == 0
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks, shares = -(-n // block_rows), -(-asked // query_rows)

    # Every share of the queries meets every block: both are dealt out by their rows.
    def own(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(max(parts, 1))).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(parts, 1) - 1)))

    candidates = rows.select("row", "vec_id", "w", own(blocks).alias("block"), each(shares).alias("share"))
    queries = rows.where(is_query).select("row", "vec_id", "w", each(blocks).alias("block"), own(shares).alias("share"))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=["row", "query_id", "vec_id", "candidate", "score"])
        postings = Postings(list(held["w"]))
        own_rows, known = held["row"].to_numpy(), held["vec_id"].notna().to_numpy()
        ids = held["vec_id"].fillna(0).to_numpy(np.int64)
        place = np.empty(len(held), np.int64)
        place[np.lexsort((own_rows, ids, ~known))] = np.arange(len(held))
        at = {row: i for i, row in enumerate(own_rows.tolist())}
        found = []
        for row, query_id, query in zip(asked["row"], asked["vec_id"], asked["w"]):
            scores = postings.scores(query)
            mine = at.get(row)
            best = best_of(scores, place, k + (mine is not None))
            if mine is not None:
                best = best[best != mine][:k]
            found += [
                (row, query_id, ids[i] if known[i] else None, own_rows[i],
                 min(max(int(scores[i]), -LONGEST - 1), LONGEST))
                for i in best
            ]
        names = ["row", "query_id", "vec_id", "candidate", "score"]
        return pd.DataFrame(found, columns=names).astype({"vec_id": "Int64", "score": "int64"})

    part = ["block", "share"]
    tasks = max(blocks * shares, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (
        queries.repartition(tasks, *part)
        .groupBy(*part)
        .cogroup(candidates.repartition(tasks, *part).groupBy(*part))
        .applyInPandas(search, "row long, query_id long, vec_id long, candidate long, score long")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "candidate")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
