"""Exact medians by radix selection: histograms of digits instead of sorted rows.

A value becomes a key of the same order: 64 bits, or a text of fixed length for decimals
of more than 18 digits. Each pass counts the keys that begin like the value looked for by
their next digit (16 bits, or five figures), for all columns and both middle ranks at once, and
goes on within the digit in which the rank lies. Where that digit holds one distinct value the
search is over, after four passes (eight for such decimals) at the latest.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence
from decimal import Decimal, localcontext
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType

from tessera.workspace import materialize

BITS = 16
FIGURES = 5
WIDE = 40  # a sign and 39 figures
FLIPPED = 2**63 - 1
UP, DOWN = "0123456789", "9876543210"


class Kind(NamedTuple):
    """How values of a type are turned into keys and back."""

    data: DataType

    @property
    def wide(self) -> bool:
        return isinstance(self.data, DecimalType) and self.data.precision > 18

    @property
    def passes(self) -> int:
        return WIDE // FIGURES if self.wide else 64 // BITS

    def key(self, value: Column) -> Column:
        """Null for null and NaN."""
        if isinstance(self.data, (FloatType, DoubleType)):
            number = value.cast("double") + F.lit(0.0)  # -0.0 equals 0.0
            bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number)
            ordered = _once(bits.cast("long"), _unsigned)
            return F.when(value.isNotNull() & ~F.isnan(value), ordered)
        if self.wide:
            figures = F.translate(F.format_number(F.abs(value), self.data.scale), ",.", "")
            figures = F.lpad(figures, WIDE - 1, "0")
            return F.when(value < 0, F.concat(F.lit("0"), F.translate(figures, UP, DOWN))).otherwise(
                F.concat(F.lit("1"), figures)
            )
        if isinstance(self.data, DecimalType):
            return (value * F.lit(Decimal(10**self.data.scale))).cast("long")
        if isinstance(self.data, IntegralType):
            return value.cast("long")
        raise TypeError(f"no median of {self.data.simpleString()}")

    def value(self, key: Column) -> Column:
        if isinstance(self.data, (FloatType, DoubleType)):
            double = F.lit("java.lang.Double"), F.lit("longBitsToDouble")
            return F.call_function("java_method", *double, _unsigned(key)).cast("double")
        if self.wide:
            figures = F.substring(key, 2, WIDE)
            figures = F.when(key < "1", F.concat(F.lit("-"), F.translate(figures, UP, DOWN))).otherwise(figures)
            rest = F.substring(figures, -self.data.scale, self.data.scale)
            if not self.data.scale:
                return figures.cast(self.data)
            head = F.substring(figures, F.lit(1), F.length(figures) - self.data.scale)
            return F.concat(head, F.lit("."), rest).cast(self.data)
        if isinstance(self.data, DecimalType) and self.data.scale:
            step = F.lit(Decimal(1).scaleb(-self.data.scale))
            return (key.cast("decimal(19,0)") * step).cast(self.data)
        return key.cast(self.data)

    def plain(self, key: int | str) -> float | Decimal | int:
        """:meth:`value` of one key on the driver."""
        if isinstance(self.data, (FloatType, DoubleType)):
            return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ FLIPPED))[0]
        if self.wide:
            figures = key[1:] if key[0] == "1" else "-" + key[1:].translate(str.maketrans(UP, DOWN))
            sign, figures = (-1, figures[1:]) if figures[0] == "-" else (1, figures)
            return Decimal((int(sign < 0), tuple(map(int, figures)), -self.data.scale))
        scale = self.data.scale if isinstance(self.data, DecimalType) else 0
        return Decimal(f"{key}e-{scale}") if scale else key

    def start(self, key: Column, digits: int) -> Column:
        """The first digits of a key."""
        if self.wide:
            return F.substring(key, 1, FIGURES * digits)
        return F.shiftright(key, 64 - BITS * digits) if digits else F.lit(0).cast("long")


def _melted(rows: DataFrame, kinds: Sequence[Kind], columns: Sequence[int], digits: int, by: Sequence[str]) -> DataFrame:
    """``by..., c, key, start, next``: a row for each value present."""
    def row(i: int) -> Column:
        return _once(
            F.col(f"k{i}"),
            lambda key: F.struct(
                F.lit(i).alias("c"),
                key.alias("key"),
                kinds[i].start(key, digits).alias("start"),
                kinds[i].start(key, digits + 1).alias("next"),
            ),
        )

    return rows.select(*by, F.inline(F.array(*map(row, columns)))).where("key IS NOT NULL")


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once, however often ``of`` names it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _unsigned(bits: Column) -> Column:
    """Bits of a double as a number of the same order, and back."""
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(FLIPPED)))


def _keyed(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> tuple[DataFrame, list[Kind]]:
    """``by`` as ``g0, ...`` and the keys as ``k0, ...``."""
    kinds = [Kind(df.schema[c].dataType) for c in columns]
    keys = [kind.key(F.col(f"`{c}`")).alias(f"k{i}") for i, (c, kind) in enumerate(zip(columns, kinds))]
    return df.select(*(F.col(f"`{b}`").alias(f"g{i}") for i, b in enumerate(by)), *keys), kinds


def _alike(kinds: Sequence[Kind]) -> list[list[int]]:
    """Columns that can share passes: those with keys of one type."""
    parts = [[i for i, kind in enumerate(kinds) if kind.wide == wide] for wide in (False, True)]
    return [part for part in parts if part]


def column_medians(df: DataFrame, columns: Sequence[str]) -> list[float | Decimal | None]:
    """The exact median of each column over all rows, None without values.

    Between two integers or decimals it is a decimal. The driver holds one histogram for
    each column and middle rank, of 65,536 digits at most.
    """
    rows, kinds = _keyed(df, columns, ())
    found: dict[tuple[int, int], int | str] = {}
    for part in _alike(kinds):
        wanted: dict[tuple[int, int], tuple] = {}
        for digits in range(kinds[part[0]].passes):
            open_ = part if not digits else sorted({c for c, _ in wanted})
            melted = _melted(rows, kinds, open_, digits, ())
            if digits:
                starts = {(c, start) for (c, _), (start, _) in wanted.items()}
                melted = melted.where(
                    reduce(or_, ((F.col("c") == c) & (F.col("start") == start) for c, start in starts))
                )
            histogram = (
                melted.groupBy("c", "start", "next")
                .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("most"))
                .toPandas()
                .sort_values("next", kind="stable")
            )
            if not digits:
                totals = histogram.groupby("c")["n"].sum()
                starts = {c: s for c, s in zip(histogram["c"], histogram["start"])}
                wanted = {
                    (c, t): (starts[c], int(rank))
                    for c, n in totals.items()
                    for t, rank in enumerate(((n + 1) // 2, n // 2 + 1))
                }
            onward = {}
            for (c, t), (start, rank) in wanted.items():
                own = histogram[(histogram["c"] == c) & (histogram["start"] == start)]
                upto = own["n"].cumsum().to_numpy()
                at = int(np.searchsorted(upto, rank))
                here = own.iloc[at]
                if here["least"] == here["most"]:
                    found[c, t] = here["least"] if isinstance(here["least"], str) else int(here["least"])
                else:
                    onward[c, t] = (here["next"], rank - (int(upto[at - 1]) if at else 0))
            wanted = onward
            if not wanted:
                break
    medians = []
    for c, kind in enumerate(kinds):
        if (c, 0) not in found:
            medians.append(None)
            continue
        low, high = kind.plain(found[c, 0]), kind.plain(found[c, 1])
        if isinstance(low, float):
            medians.append(low if low == high else low / 2 + high / 2)
        else:
            with localcontext(prec=2 * WIDE):
                medians.append((Decimal(low) + Decimal(high)) / 2)
    return medians


def group_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by..., median of each column`` under the columns' names, null without values.

    Rows are counted in their tasks before they meet; of a group at most 65,536 digits a
    column and rank do. Null is a group of its own. Between two integers or
    decimals the median is a decimal, rounded where 38 digits leave no room for a half.
    """
    rows, kinds = _keyed(df, columns, by)
    groups = [f"g{i}" for i in range(len(by))]
    measures = [F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("most")]
    names = [*groups, "c", "t", "start", "rank", "least", "most"]

    def within(histogram: DataFrame, key: list[str]) -> DataFrame:
        """The digit in which the rank lies, and the rank in it."""
        along = Window.partitionBy(*key).orderBy("next")
        return (
            histogram.withColumn("upto", F.sum("n").over(along))
            .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
            .withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n")))
            .withColumn("start", F.col("next"))
            .select(*names)
        )

    ends = []
    for part in _alike(kinds):
        for digits in range(kinds[part[0]].passes):
            melted = _melted(rows, kinds, part, digits, groups)
            if not digits:
                n = F.sum("n").over(Window.partitionBy(*groups, "c"))
                ranks = F.array(
                    F.struct(F.lit(0).alias("t"), F.floor((F.col("all") + 1) / 2).alias("rank")),
                    F.struct(F.lit(1).alias("t"), (F.floor(F.col("all") / 2) + 1).alias("rank")),
                )
                histogram = (
                    melted.groupBy(*groups, "c", "next").agg(*measures).withColumn("all", n).select("*", F.inline(ranks))
                )
            else:
                same = [melted[c].eqNullSafe(F.col(f"w.{c}")) for c in (*groups, "c", "start")]
                histogram = (
                    melted.join(open_.alias("w"), reduce(and_, same))
                    .select(*(melted[c] for c in (*groups, "c", "key", "next")), "w.t", "w.rank")
                    .groupBy(*groups, "c", "t", "rank", "next")
                    .agg(*measures)
                )
            chosen = materialize(within(histogram, [*groups, "c", "t"]), "median-digits")
            settled = F.col("least") == F.col("most")
            ends.append(chosen.where(settled).select(*groups, "c", "t", F.col("least").alias("key")))
            open_ = chosen.where(~settled).select(*groups, "c", "t", "start", "rank")
            if open_.isEmpty():
                break

    medians = None
    for part in _alike(kinds):
        keys = [e for e in ends if (dict(e.dtypes)["key"] == "string") == kinds[part[0]].wide]
        both = [F.max(F.when((F.col("c") == i) & (F.col("t") == t), F.col("key"))).alias(f"k{i}_{t}") for i in part for t in (0, 1)]
        own = reduce(DataFrame.unionByName, keys).groupBy(*groups).agg(*both)
        own = own.select(*groups, *(_between(kinds[i], F.col(f"k{i}_0"), F.col(f"k{i}_1")).alias(f"m{i}") for i in part))
        if medians is None:
            medians = own
        else:
            own = own.withColumnsRenamed({g: f"_{g}" for g in groups})
            same = reduce(and_, (F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups))
            medians = medians.join(own, same, "full").withColumns(
                {g: F.coalesce(g, f"_{g}") for g in groups}
            )
    return medians.select(
        *(F.col(f"g{i}").alias(b) for i, b in enumerate(by)),
        *(F.col(f"m{i}").alias(c) for i, c in enumerate(columns)),
    )


def _between(kind: Kind, low: Column, high: Column) -> Column:
    a, b = kind.value(low), kind.value(high)
    if isinstance(kind.data, (FloatType, DoubleType)):
        return F.when(low == high, a).otherwise(a / 2 + b / 2)
    if isinstance(kind.data, IntegralType):
        a, b = a.cast("decimal(20,0)"), b.cast("decimal(20,0)")
        return (a + b) * F.lit(Decimal("0.5"))
    half = F.lit(Decimal("0.5"))
    return F.when(low == high, a).otherwise((a * half + b * half).cast(_wider(kind.data)))


def _wider(data: DecimalType) -> DecimalType:
    """With a place more, where there is room."""
    return DecimalType(min(data.precision + 2, 38), min(data.scale + 1, 38 - (data.precision - data.scale)))
