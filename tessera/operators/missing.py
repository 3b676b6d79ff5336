"""Filling missing values from statistics of the column or from near rows.

Missing means null or NaN, as it does to ``df.na``. Dropping rows and replacing values are ``df.na.drop`` and ``df.na.replace``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import and_, or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    MapType,
    StructType,
)

from tessera.operators.aggregates import most_frequent
from tessera.operators.neighbours import (
    nearest_by_distance,
    nearest_by_mismatch,
    nearest_by_order,
)
from tessera.operators.selection import column_medians, group_medians
from tessera.workspace import materialize

# The powers that make a Minkowski distance one of these.
POWERS = {"euclidean": 2.0, "manhattan": 1.0, "mahalanobis": 2.0}


def _is_present(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def _filled(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Missing cells of each column set to its value, cast to the column's type."""
    return df.select(
        *(
            F.when(_is_present(df, c), F.col(f"`{c}`"))
            .otherwise(F.lit(values[c]).cast(df.schema[c].dataType))
            .alias(c)
            if values.get(c) is not None
            else F.col(f"`{c}`")
            for c in df.columns
        )
    )


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill each column with its mean, all means from one aggregate.

    The value takes the column's type: an integer column gets the mean truncated, a
    decimal one the mean in its own scale. A column without values stays as it is.
    """
    present = [F.when(_is_present(df, c), F.col(f"`{c}`")) for c in columns]
    means = df.agg(*(F.avg(v).alias(f"m{i}") for i, v in enumerate(present))).first()
    return _filled(df, dict(zip(columns, means)))


def fill_median(
    df: DataFrame, columns: str | Sequence[str], by: str | Sequence[str] = ()
) -> DataFrame:
    """Fill each column with its exact median, over all rows or per group of ``by``.

    All columns share the passes. The value takes the column's type: an integer column gets
    the median truncated. A column, or group, without values stays as it is; null is a
    group of its own.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    by = [by] if isinstance(by, str) else list(by)
    if not by:
        return _filled(df, dict(zip(columns, column_medians(df, columns))))
    medians = group_medians(df, columns, by).toDF(
        *(f"_g{i}" for i in range(len(by))), *(f"_m{i}" for i in range(len(columns)))
    )
    own = [F.col(f"`{b}`").eqNullSafe(F.col(f"_g{i}")) for i, b in enumerate(by)]
    joined = df.join(materialize(medians, "group-medians"), reduce(and_, own), "left")
    found = {c: F.col(f"_m{i}").cast(df.schema[c].dataType) for i, c in enumerate(columns)}
    return joined.select(
        *(
            F.when(_is_present(df, c), F.col(f"`{c}`"))
            .otherwise(F.coalesce(found[c], F.col(f"`{c}`")))
            .alias(c)
            if c in found
            else F.col(f"`{c}`")
            for c in df.columns
        )
    )


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Fill with the most frequent value of any type, the smallest of equals."""
    return _filled(df, {column: most_frequent(df.where(_is_present(df, column)), column)})


def exact_median(df: DataFrame, column: str) -> float | Decimal | None:
    """The median of all values. Between two integers it is a decimal."""
    return column_medians(df, [column])[0]


def fill_knn(
    df: DataFrame,
    target: str,
    features: str | Sequence[str],
    key: str,
    k: int = 5,
    metric: str = "euclidean",
    power: float = 3.0,
    partial: bool = False,
) -> DataFrame:
    """Fill ``target`` with its mean over the k rows nearest by ``features``.

    ``metric`` is ``euclidean``, ``manhattan``, ``minkowski`` (of ``power``),
    ``mahalanobis`` (Euclidean after the features' covariance is taken out) or
    ``hamming`` (number of features that differ, of any type). Equal distances go by
    ``key``, which must be unique. The result is exact.

    Rows that lack a feature are no donors and stay unfilled, unless ``partial`` is set.
    Then a distance is over the features that both rows have, and the sum of its parts
    is scaled up to all features; a row stays unfilled only if no donor shares a feature.
    """
    names = [features] if isinstance(features, str) else list(features)
    if metric not in POWERS and metric not in ("minkowski", "hamming"):
        raise ValueError(f"unknown metric {metric!r}")
    partial = partial and len(names) > 1
    there = [_is_present(df, c) for c in names]
    usable = reduce(or_ if partial else and_, there)
    known = _is_present(df, target) & usable
    open_ = ~_is_present(df, target) & usable
    # Which features a row has, a bit each.
    shape = sum((F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(there)), F.lit(0).cast("long"))
    if metric == "hamming":
        values = F.array(*(F.when(t, _as_text(df, c)).otherwise("") for c, t in zip(names, there)))
    else:
        number = [F.when(t, F.col(f"`{c}`").cast("double")) for c, t in zip(names, there)]
        if metric == "mahalanobis":
            means, covariance = _moments(df.where(usable), number)
            number = [v - F.lit(m) for v, m in zip(number, means)]
        values = F.array(*(F.coalesce(v, F.lit(0.0)) for v in number))

    donor, y = F.col(f"`{key}`").alias("donor"), F.col(f"`{target}`").cast("double").alias("y")
    if partial:
        donors = df.where(known).select(shape.alias("has"), values.alias("at"), donor, y)
        asked = df.where(open_).select(shape.alias("lacking"), values.alias("at")).distinct()
        asked = materialize(asked, "knn-lacking")
        turn = (lambda shared: _turn(covariance, shared)) if metric == "mahalanobis" else None
        patterns = _patterns(donors, asked, len(names), turn)
        if patterns is None:
            return df
        seen = _turned(F.col("at"), F.col("turn")) if turn else _shared(F.col("at"), metric)
        donors = donors.join(patterns, "has").select("grp", seen.alias("x"), "donor", "y")
        own = patterns.select("lacking", "grp", "shared", "n", "turn").distinct()
        asked = materialize(
            asked.join(own, "lacking").select("lacking", "at", "grp", seen.alias("x"), "n"), "knn-lacking"
        )
        wanted = asked.select("grp", "x").distinct()
    else:
        if metric == "mahalanobis":
            turn = _turn(covariance, [True] * len(names))
            values = _turned(values, F.array(*(F.array(*map(F.lit, row)) for row in turn)))
        donors = df.where(known).select(F.lit(0).cast("long").alias("grp"), values.alias("x"), donor, y)
        wanted = df.where(open_).select(F.lit(0).cast("long").alias("grp"), values.alias("x")).distinct()

    # Spark prunes each task to k donors per vector before the shuffle.
    lowest = Window.partitionBy("grp", "x").orderBy("donor")
    donors = donors.withColumn("nth", F.row_number().over(lowest)).where(F.col("nth") <= k).drop("nth")
    if metric == "hamming":
        near = nearest_by_mismatch(donors, wanted, k)
    elif len(names) == 1:
        near = nearest_by_order(donors, wanted, k)
    else:
        near = nearest_by_distance(donors, wanted, k, POWERS.get(metric, power))
    place, own = ["x"], [values]
    if partial:
        along = Window.partitionBy("lacking", "at").orderBy("scaled", "donor")
        near = (
            asked.join(near, ["grp", "x"])
            .withColumn("scaled", F.col("gap") * len(names) / F.col("n"))
            .withColumn("nth", F.row_number().over(along))
            .where(F.col("nth") <= k)
        )
        place, own = ["lacking", "at"], [shape, values]
    means = near.groupBy(*(F.col(c).alias(f"_{c}") for c in place)).agg(F.avg("y").alias("_filled"))
    here = df.where(open_).withColumns({f"_own{i}": v for i, v in enumerate(own)})
    same = reduce(and_, (F.col(f"_own{i}") == F.col(f"_{c}") for i, c in enumerate(place)))
    filled = (
        here.join(materialize(means, "knn-found"), same, "left")
        .withColumn(target, F.col("_filled").cast(df.schema[target].dataType))
        .select(*(f"`{c}`" for c in df.columns))
    )
    return df.where(~open_).unionByName(filled)


def _patterns(
    donors: DataFrame, asked: DataFrame, n: int, turn: Callable[[list[bool]], list[list[float]]] | None
) -> DataFrame | None:
    """``has, lacking, grp, shared, n, turn``: which donors a row can be compared with.

    One group for each pattern of features of an asked row and those it shares with a
    donor. The driver holds one row for each pair of patterns that occur, not of rows.
    """
    lacking = [r.lacking for r in asked.select("lacking").distinct().collect()]
    meetings = [(r.has, a) for r in donors.select("has").distinct().collect() for a in lacking if r.has & a]
    groups = {both: i for i, both in enumerate(sorted({(a, a & d) for d, a in meetings}))}
    rows = []
    for has, own in meetings:
        shared = [bool(has & own & 1 << i) for i in range(n)]
        rows.append((has, own, groups[own, has & own], shared, sum(shared), turn and turn(shared)))
    kind = "has long, lacking long, grp long, shared array<boolean>, n int, turn array<array<double>>"
    return donors.sparkSession.createDataFrame(rows, kind) if rows else None


def _shared(values: Column, metric: str) -> Column:
    """Features that are not shared are the same everywhere."""
    nothing = F.lit("") if metric == "hamming" else F.lit(0.0)
    return F.zip_with(values, "shared", lambda v, s: F.when(s, v).otherwise(nothing))


def _turned(values: Column, turn: Column) -> Column:
    def dot(row: Column) -> Column:
        products = F.zip_with(values, row, lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.transform(turn, dot)


def _as_text(df: DataFrame, column: str) -> Column:
    """A present value as text, different for different values, never empty."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (FloatType, DoubleType)):
        value = value + F.lit(0.0)  # -0.0 equals 0.0
    if isinstance(kind, BinaryType):
        value = F.hex(value)
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        value = F.to_json(F.struct(value))
    return F.concat(F.lit("="), value.cast("string"))


def _moments(rows: DataFrame, number: Sequence[Column]) -> tuple[list[float], np.ndarray]:
    """Means, and covariances over the rows that have both features."""
    pairs = [(i, j) for i in range(len(number)) for j in range(i + 1)]
    named = rows.select(*(v.alias(f"v{i}") for i, v in enumerate(number)))
    values = named.agg(
        *(F.avg(f"v{i}") for i in range(len(number))),
        *(F.covar_samp(f"v{i}", f"v{j}") for i, j in pairs),
    ).first()
    covariance = np.zeros((len(number), len(number)))
    for (i, j), value in zip(pairs, values[len(number) :]):
        covariance[i, j] = covariance[j, i] = value or 0.0
    return [m or 0.0 for m in values[: len(number)]], covariance


def _turn(covariance: np.ndarray, shared: Sequence[bool]) -> list[list[float]]:
    """Rows that turn the shared features so that they are uncorrelated and of equal variance.

    Directions without variance tell no rows apart and come out as 0.
    """
    at = np.flatnonzero(shared)
    variances, directions = np.linalg.eigh(covariance[np.ix_(at, at)])
    kept = variances > max(variances.max(), 0.0) * 1e-12
    turn = np.zeros((len(shared), len(shared)))
    turn[np.ix_(np.flatnonzero(kept), at)] = (directions[:, kept] / np.sqrt(variances[kept])).T
    return turn.tolist()
