"""Exact nearest rows by one or more features.

One numeric feature: donors are numbered along it and looked up by number. Several: donors
are keyed by a near pivot and their distance to it; by the triangle inequality a row needs
only those within its k-th distance of its own distance to the pivot, which shrinks from
round to round. Categories: rows are looked up by sets of features, chosen by how telling
they are, of which all that may be near agree on one. Equal distances always go by the
donor's key.

``donors`` has ``grp, x, donor, y``: the k donors of lowest key for each distinct ``grp, x``,
which is all that is needed however many share it. ``asked`` has distinct ``grp, x``. Rows
meet donors of their own ``grp`` only; where there is no such column all are of one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.workspace import materialize

# Rows or donor vectors of a look-up that one task meets, donor vectors of a ring around a
# pivot, pivots of a large group, cells that a round adds to a row's (after them all that may hold a nearer donor),
# and bytes of a block of differences.
PER_TASK = 20_000
RING_ROWS = 512
PIVOTS = 2048
FANS = (16, 128, None)
BLOCK_BYTES = 16 << 20

# Of a round over categories: microseconds for a row of a set that is sent, for a pair that
# meets, for one that is near, and for the round itself; sets that a row may be sent for.
ROW_SENT, PAIR_MET, PAIR_FOUND, ROUND = 1.5, 0.02, 3.0, 4e6
MOST_SETS = 1_000

# Cells that a first round puts in order for a row, more only for rows that need them.
HOME = 8

#: Of blocks of asked and held vectors to a matrix of gaps.
Measure = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _grouped(rows: DataFrame) -> DataFrame:
    return rows if "grp" in rows.columns else rows.withColumn("grp", F.lit(0).cast("long"))


def _tasks(rows: DataFrame) -> int:
    session = rows.sparkSession
    return max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)


def _packed(donors: DataFrame) -> DataFrame:
    """One row for each donor vector."""
    return donors.groupBy("grp", "x").agg(F.collect_list(F.struct("donor", "y")).alias("donors"))


def _lowest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp", "x").orderBy("gap", "donor")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).drop("nth")


def _powers(power: float) -> Measure:
    """Sums of ``abs(difference) ** power``, which order as the Minkowski distance does."""

    def raised(apart: np.ndarray) -> np.ndarray:
        if power != int(power):
            return apart**power
        out = apart
        for _ in range(int(power) - 1):
            out = out * apart
        return out

    def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if a.shape[1] < 8:  # numpy adds so few one after the other, too
            total = np.zeros((len(a), len(b)))
            for i in range(a.shape[1]):
                total += raised(np.abs(np.subtract.outer(a[:, i], b[:, i])))
            return total
        return raised(np.abs(a[:, None, :] - b[None])).sum(axis=2)

    return gaps


def _blocks(rows: int, others: int, width: int) -> Iterator[slice]:
    """Slices of ``rows`` whose differences from ``others`` fill a block at most, or one row."""
    step = max(1, BLOCK_BYTES // (8 * max(1, others * width)))
    return (slice(at, at + step) for at in range(0, rows, step))


class Pivots:
    """Some donor vectors of each group; their places number the cells."""

    def __init__(self, groups: np.ndarray, points: np.ndarray, power: float):
        order = np.argsort(groups, kind="stable")
        self.points, groups = points[order], groups[order]
        names, firsts = np.unique(groups, return_index=True)
        ends = [*firsts[1:].tolist(), len(groups)]
        self.spans = dict(zip(names.tolist(), zip(firsts.tolist(), ends)))
        self.gaps = _powers(power)
        # Below a power of 1 the sum itself obeys the triangle inequality.
        self.root = 1 / power if power >= 1 else 1.0

    def distances(self, group: int, points: np.ndarray) -> Iterator[tuple[slice, int, np.ndarray]]:
        """Blocks of rows, the first cell of the group, and distances to its pivots."""
        first, end = self.spans.get(group, (0, 0))
        held = self.points[first:end]
        for part in _blocks(len(points), end - first, points.shape[1]):
            yield part, first, self.gaps(points[part], held) ** self.root


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of ``grp, x``: each group, its rows and their vectors."""
    groups = batch.column("grp").to_numpy()
    x = batch.column("x")
    points = x.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    for group in np.unique(groups):
        rows = np.flatnonzero(groups == group)
        yield int(group), rows, points[rows]


def _pivots(packed: DataFrame, power: float) -> Pivots | None:
    """About the square root of each group's vectors, drawn by a hash over all of them.

    They are sent to the tasks. They have no bearing on results. Every row is held against
    them, so beyond ``PIVOTS`` their number stays: cells grow then, and are cut into more rings.
    """
    place = F.abs(F.xxhash64("grp", "x") / 2.0**63)
    totals = packed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).collect()
    if not totals:
        return None
    upto = [F.lit(v) for r in totals for v in (r.grp, max(r.least, min(1 / math.sqrt(r.n), PIVOTS / r.n)))]
    drawn = packed.where(place <= F.create_map(*upto)[F.col("grp")]).select("grp", "x").toArrow()
    points = drawn.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return Pivots(drawn.column("grp").to_numpy(), points.reshape(len(drawn), -1), power)


def _with_cells(packed: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds ``cell``, the number of the nearest pivot, and ``far``, the distance to it."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for group, rows, points in _by_group(batch):
                for part, first, away in pivots.distances(group, points):
                    nearest = away.argmin(axis=1)
                    cell[rows[part]] = first + nearest
                    far[rows[part]] = away[np.arange(len(nearest)), nearest]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(far)],
                names=[*batch.schema.names, "cell", "far"],
            )

    schema = packed.select("*", F.lit(0).cast("long").alias("cell"), F.lit(0.0).alias("far")).schema
    # A stated number of tasks, here and below: few bytes, but each row is held against all pivots.
    return packed.repartition(_tasks(packed), "x").mapInArrow(place, schema)


def _visits(
    open_: DataFrame, pivots: Pivots, cells: pd.DataFrame, k: int, before: int | None, fan: int | None
) -> DataFrame:
    """``grp, x, reach, more, cell, far``: the cells that a row looks into in this round.

    Cells come in the order of what a donor there must at least be away. The first round
    (``before`` is None) takes as many as hold k donors together; the next one goes on behind them
    and the ``before`` cells of earlier rounds with ``fan`` cells, or all, within ``reach``.
    ``more`` says that others are within it.
    """
    count = len(pivots.points)
    held, low, high = np.zeros(count, np.int64), np.full(count, np.inf), np.zeros(count)
    at = cells["cell"].to_numpy()
    held[at], low[at], high[at] = cells["n"], cells["low"], cells["high"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reach = batch.column("reach").to_numpy(zero_copy_only=False)
            found = []
            for group, rows, points in _by_group(batch):
                for part, first, away in pivots.distances(group, points):
                    if not away.shape[1]:
                        continue
                    here = slice(first, first + away.shape[1])
                    # From the ring around the pivot, and as no other pivot is nearer to a donor.
                    least = np.subtract(away, high[here])
                    np.maximum(least, low[here] - away, out=least)
                    np.maximum(least, (away - away.min(axis=1, keepdims=True)) / 2, out=least)
                    # Only cells in reach are put in order: the first of the order of all.
                    if before is None:
                        upto = np.partition(least, min(HOME, least.shape[1]) - 1, axis=1)[:, min(HOME, least.shape[1]) - 1]
                    else:
                        upto = reach[rows[part]] ** pivots.root * (1 + 1e-9) + 1e-12 * away.max(axis=1)
                    row, cell = np.nonzero(least <= upto[:, None])
                    order = np.lexsort((away[row, cell], least[row, cell], row))
                    row, cell = row[order], cell[order]
                    last = np.bincount(row, minlength=len(away))
                    place = np.arange(len(row)) - np.repeat(np.cumsum(last) - last, last)
                    # Cells of a row that come before one of them and hold fewer than k donors together.
                    above = np.cumsum(held[here][cell]) - held[here][cell]
                    starts = (np.cumsum(last) - last)[row]
                    home = np.bincount(row, above - above[starts] < k, len(away)).astype(np.int64)
                    if before is None:
                        taken, more = place < home[row], np.ones(len(row), bool)
                        short = np.flatnonzero((np.bincount(row, held[here][cell], len(away)) < k) & (last < least.shape[1]))
                        taken &= ~np.isin(row, short)
                        for one in short.tolist():
                            order = np.lexsort((away[one], least[one]))
                            upto_k = int(np.searchsorted(np.cumsum(held[here][order]), k)) + 1
                            chosen = order[:upto_k]
                            found.append((np.full(len(chosen), rows[part][one]), chosen + first, away[one, chosen], np.ones(len(chosen), bool)))
                    else:
                        end = last if fan is None else np.minimum(last, home + before + fan)
                        taken, more = (place >= (home + before)[row]) & (place < end[row]), (end < last)[row]
                    row, cell = row[taken], cell[taken]
                    found.append((rows[part][row], cell + first, away[row, cell], more[taken]))
            if found:
                row, cell, distances, more = (np.concatenate(f) for f in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(row)) for c in ("grp", "x", "reach")),
                     pa.array(more), pa.array(cell), pa.array(distances)],
                    names=["grp", "x", "reach", "more", "cell", "far"],
                )

    return open_.select("grp", "x", "reach").repartition(_tasks(open_), "x").mapInArrow(
        look, "grp long, x array<double>, reach double, more boolean, cell long, far double"
    )


def nearest_by_distance(
    donors: DataFrame,
    asked: DataFrame,
    k: int,
    power: float = 2.0,
    ring_rows: int = RING_ROWS,
    per_task: int = PER_TASK,
    tally: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """``grp, x, gap, donor, y``: for each vector ``asked.x`` its k nearest donors.

    ``gap`` is the sum of ``abs(difference) ** power``. ``tally`` gets for each round the
    number of rows that still looked for donors and of vectors they were compared with.
    """
    donors, asked = _grouped(donors), _grouped(asked)
    packed = materialize(_packed(donors), "knn-donors")
    nothing = packed.select("grp", "x", F.lit(0.0).alias("gap"), F.inline("donors")).limit(0)
    pivots = _pivots(packed, power)
    if pivots is None:
        return nothing
    along = Window.partitionBy("cell").orderBy("far")
    ring = F.floor((F.row_number().over(along) - 1) / ring_rows).cast("long")
    celled = materialize(_with_cells(packed, pivots).withColumn("part", ring), "knn-cells")
    rings = materialize(
        celled.groupBy("cell", "part").agg(
            F.min("far").alias("low"),
            F.max("far").alias("high"),
            F.sum(F.size("donors")).alias("n"),
            F.count(F.lit(1)).alias("vectors"),
        ),
        "knn-rings",
    )
    cells = rings.groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toPandas()

    open_ = asked.select("grp", "x", F.lit(float("inf")).alias("reach"))
    best, before = None, None
    for fan in (0, *FANS):
        visits = _visits(open_, pivots, cells, k, before, fan).join(rings, "cell")
        upto = F.pow(F.col("reach"), F.lit(pivots.root)) * (1 + 1e-9) + 1e-12 * F.col("far")
        within = (F.col("low") <= F.col("far") + upto) & (F.col("high") >= F.col("far") - upto)
        names = ["grp", "x", "reach", "more", "cell", "part", "vectors"]
        visits = materialize(visits.where(within).select(*names), "knn-visits")
        met, compared = visits.agg(F.count(F.lit(1)), F.coalesce(F.sum("vectors"), F.lit(0))).first()
        if tally is not None:
            tally.append((visits.select("grp", "x").distinct().count(), compared))
        if met == 0:
            break
        found = _look_up(celled, visits, donors, k, _powers(power), per_task, met, ring_rows)
        best = materialize(_lowest(found if best is None else best.unionByName(found), k), "knn-best")
        if fan is None or visits.where("more").isEmpty():
            break
        # Rows whose k-th distance reaches into cells not seen yet go on.
        reach = best.groupBy("grp", "x").agg(
            F.when(F.count(F.lit(1)) >= k, F.max("gap")).otherwise(float("inf")).alias("reach")
        )
        onward = visits.where("more").select("grp", "x").distinct()
        open_ = reach if before is None else reach.join(onward, ["grp", "x"], "left_semi")
        before = fan if before is None else before + fan
    return nothing if best is None else best


def _look_up(
    celled: DataFrame,
    visits: DataFrame,
    donors: DataFrame,
    k: int,
    measure: Measure,
    per_task: int,
    n_visits: int,
    n_vectors: int,
) -> DataFrame:
    """``grp, x, gap, donor, y``: of each visited ``cell, part`` the k nearest donors in reach.

    One that many rows visit, or that holds many vectors, is looked up by several tasks:
    its rows and its vectors are dealt out, and every share of the rows meets every share
    of the vectors. With no more than ``n_visits`` and ``n_vectors`` in any, none may need that.
    """
    at = ["cell", "part"]
    tasks = _tasks(visits)
    if max(n_visits, n_vectors) <= per_task:
        one = F.lit(0).alias("row_share"), F.lit(0).alias("vector_share")
        dealt = visits.select("grp", "x", "reach", *at, *one)
        copied = celled.select("x", "donors", *at, *one)
    else:

        def shares(rows: DataFrame, name: str) -> DataFrame:
            needed = F.ceil(F.count(F.lit(1)) / F.lit(per_task)).cast("int")
            return rows.groupBy("cell", "part").agg(needed.alias(name))

        split = materialize(
            shares(visits, "row_shares").join(shares(celled, "vector_shares"), at), "knn-shares"
        )

        def own(name: str) -> Column:
            return F.pmod(F.xxhash64("x"), F.col(name)).cast("int")

        def each(name: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

        meetings = split.agg(F.sum(F.col("row_shares").cast("long") * F.col("vector_shares"))).first()[0] or 1
        tasks = max(tasks, meetings // 64)
        dealt = visits.join(split, at).select(
            "grp", "x", "reach", *at, own("row_shares").alias("row_share"), each("vector_shares").alias("vector_share")
        )
        copied = celled.join(split, at).select(
            "x", "donors", *at, own("vector_shares").alias("vector_share"), each("row_shares").alias("row_share")
        )
    # A stated number of tasks: merged by size, as small shuffles are, the comparisons
    # would run on a few cores.
    key = [*at, "row_share", "vector_share"]
    vector, donor = (f.dataType.simpleString() for f in (visits.schema["x"], donors.schema["donor"]))
    names = ["grp", "x", "gap", "donor", "y"]

    def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame(columns=names)
        a, b = _vectors(asked["x"], held["x"])
        sizes = held["donors"].map(len).to_numpy()
        firsts = np.cumsum(sizes) - sizes
        flat = pd.DataFrame([(d["donor"], d["y"]) for ds in held["donors"] for d in ds], columns=["donor", "y"])
        reach = asked["reach"].fillna(np.inf).to_numpy(float) * (1 + 1e-9)
        found = []
        for part in _blocks(len(a), *b.shape):
            gaps = measure(a[part], b)
            upto = reach[part]
            if len(b) > k:
                upto = np.minimum(upto, np.partition(gaps, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero(gaps <= upto[:, None])
            one = pd.DataFrame({"row": np.repeat(i + part.start, sizes[j]), "gap": np.repeat(gaps[i, j], sizes[j])})
            within = np.arange(len(one)) - np.repeat(np.cumsum(sizes[j]) - sizes[j], sizes[j])
            one[["donor", "y"]] = flat.take(np.repeat(firsts[j], sizes[j]) + within).to_numpy(object)
            found.append(one.sort_values(["row", "gap", "donor"]).groupby("row").head(k))
        best = pd.concat(found)
        here = asked[["grp", "x"]].take(best["row"].to_numpy()).reset_index(drop=True)
        return pd.concat([here, best[["gap", "donor", "y"]].reset_index(drop=True)], axis=1)[names]

    return (
        dealt.repartition(tasks, *key)
        .groupBy(*key)
        .cogroup(copied.repartition(tasks, *key).groupBy(*key))
        .applyInPandas(compare, f"grp long, x {vector}, gap double, donor {donor}, y double")
    )


def _vectors(asked: pd.Series, held: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Both as rows of numbers; texts become the places of the distinct ones."""
    a, b = np.stack(asked.to_numpy()), np.stack(held.to_numpy())
    if a.dtype != object:
        return a, b
    places = pd.factorize(np.concatenate([a.ravel(), b.ravel()]))[0]
    return places[: a.size].reshape(a.shape), places[a.size :].reshape(b.shape)


def radii(features: int) -> list[int]:
    """Numbers of differing features that the rounds reach: 0, 1, 3, ... up to two less than all."""
    steps = [2**i - 1 for i in range(features.bit_length() + 1) if 2**i - 1 < features - 2]
    return [*steps, *([features - 2] if features > 1 else [])]


def _odds(donors: DataFrame, asked: DataFrame, n: int) -> list[float]:
    """For each feature the share of all pairs of a row and a donor vector that agree on it."""

    def held(rows: DataFrame, name: str) -> DataFrame:
        values = rows.select("grp", F.posexplode("x").alias("feature", "value"))
        return values.groupBy("grp", "feature", "value").agg(F.count(F.lit(1)).cast("double").alias(name))

    met = held(donors, "a").join(held(asked, "b"), ["grp", "feature", "value"])
    found = {r.feature: r.met for r in met.groupBy("feature").agg(F.sum(F.col("a") * F.col("b")).alias("met")).collect()}
    return [found.get(i, 0.0) for i in range(n)]


def _sums_of_products(odds: list[float]) -> list[float]:
    """At place j the sum over all j of the features of the chance that these agree."""
    sums = [1.0]
    for p in odds:
        sums = [a + p * b for a, b in zip([*sums, 0.0], [0.0, *sums])]
    return sums


def _within(odds: list[float]) -> list[float]:
    """At place r the chance that a pair differs in r features at most, were they independent."""
    exact = [1.0]
    for p in odds:
        exact = [a * p + b * (1 - p) for a, b in zip([*exact, 0.0], [0.0, *exact])]
    return np.cumsum(exact).tolist()


class Plan(NamedTuple):
    """How one round finds the donors within ``radius``: by sets of features that agree."""

    cost: float
    radius: int
    sets: tuple[tuple[int, ...], ...]
    tops: bool  # only the k donors of lowest key that agree on a set are met


def _plan(odds: list[float], radius: int, done: int, asked: int, vectors: int, k: int) -> Plan:
    """The cheapest way to find all that matters within ``radius`` when all within ``done`` are known.

    Of pairs that agree on m features, any j agree at least among the first n - m + j: rows meet
    the donors that agree with them on such j of the most telling features. Where only the next
    radius is looked at, they meet the k lowest donors that agree on m features: of a donor that
    is beyond these in a set, all k come first.
    """
    n = len(odds)
    order = sorted(range(n), key=lambda i: odds[i])
    least, pairs, plans = n - radius, float(asked) * vectors, []
    near = pairs * _within(odds)[radius] * PAIR_FOUND
    for j in range(1, least + 1):
        first = order[: n - least + j]
        count = math.comb(len(first), j)
        if count > MOST_SETS and j > 1:
            continue
        met = pairs * _sums_of_products([odds[i] for i in first])[j] * PAIR_MET
        plans.append((count * (asked + vectors) * ROW_SENT + met + near, j, first, False))
    count = math.comb(n, least)
    if radius == done + 1 and count <= MOST_SETS:
        cost = count * (2 * vectors * ROW_SENT + asked * (ROW_SENT + k * PAIR_FOUND))
        plans.append((cost, least, order, True))
    cost, j, first, tops = min(plans)
    return Plan(cost, radius, tuple(combinations(first, j)), tops)


def _next_round(odds: list[float], done: int, asked: int, vectors: int, k: int) -> Plan:
    """The next of :func:`radii` at which a row is likely to have a donor, or less if that costs much more."""
    within = _within(odds)
    steps = [r for r in radii(len(odds)) if r > done]
    wanted = next((r for r in steps if vectors * within[r] >= 1), steps[-1])
    plans = [_plan(odds, r, done, asked, vectors, k) for r in range(done + 1, wanted + 1)]
    return next(p for p in reversed(plans) if p.cost <= max(ROUND, 2 * plans[0].cost) or p is plans[0])


def _coded(rows: DataFrame, n: int, name: str) -> DataFrame:
    """Adds a number, and 16 bits for each feature, four to a word: other bits, other values."""
    codes = [F.xxhash64(F.col("x")[i]).bitwiseAND(0xFFFF) for i in range(n)]
    words = [
        reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(c, 16 * i) for i, c in enumerate(codes[at : at + 4])))
        for at in range(0, n, 4)
    ]
    return rows.withColumns({name: F.monotonically_increasing_id(), **{f"w{i}": w for i, w in enumerate(words)}})


def _agreeing(donors: DataFrame, asked: DataFrame, n: int, k: int, plan: Plan, tasks: int) -> DataFrame:
    """``row, vector`` of pairs that may differ in ``plan.radius`` features at most, each once."""
    words = [f"w{i}" for i in range(-(-n // 4))]

    def keyed(rows: DataFrame, *columns: str) -> DataFrame:
        own = [F.xxhash64(F.lit(i), "grp", F.col("x")[i]).alias(f"h{i}") for i in range(n)]
        keys = [reduce(lambda a, b: a.bitwiseXOR(b), (F.col(f"h{i}") for i in chosen)) for chosen in plan.sets]
        return rows.select(*columns, *own).select(*columns, F.explode(F.array(*keys)).alias("key"))

    held = keyed(donors, "vector", "lowest", *words)
    if plan.tops:
        # A set is met by its k lowest, however many agree on it: Spark prunes each task to these.
        lowest = Window.partitionBy("key").orderBy("lowest")
        held = held.withColumn("nth", F.row_number().over(lowest)).where(F.col("nth") <= k)
    # A stated number of tasks: merged by size, the comparisons would run on a few cores.
    rows = keyed(asked, "row", *words).withColumnsRenamed({w: f"o{w}" for w in words})
    met = held.drop("lowest", "nth").repartition(tasks, "key").join(rows.repartition(tasks, "key"), "key")
    apart = [
        (F.col(f"w{i // 4}").bitwiseXOR(F.col(f"ow{i // 4}")).bitwiseAND(F.shiftleft(F.lit(0xFFFF).cast("long"), 16 * (i % 4))) != 0)
        for i in range(n)
    ]
    return met.where(sum((a.cast("int") for a in apart), F.lit(0)) <= plan.radius).select("row", "vector").distinct()


def nearest_by_mismatch(
    donors: DataFrame, asked: DataFrame, k: int, per_task: int = PER_TASK, tally: list[int] | None = None
) -> DataFrame:
    """``grp, x, gap, donor, y``: for each ``asked.x`` the k donors that differ in fewest fields.

    Here ``x`` is an array of texts. Each round reaches a number of differing features, see
    :func:`_plan`, and rows with k donors in reach are done. Beyond all but one feature, only
    the k donors of lowest key of each value matter, and the k lowest of all: any other is
    preceded by those. ``tally`` gets the rows asked in each round.
    """
    donors, asked = _grouped(donors), _grouped(asked)
    packed = _packed(donors)
    n = packed.agg(F.max(F.size("x"))).first()[0]
    if n is None:
        return packed.select("grp", "x", F.lit(0.0).alias("gap"), F.inline("donors"))
    lowest = F.array_min(F.transform("donors", lambda d: d["donor"]))
    packed = materialize(_coded(packed.withColumn("lowest", lowest), n, "vector"), "knn-donors")
    open_ = materialize(_coded(asked.select("grp", "x"), n, "row"), "knn-asked")
    vectors, asked_now = packed.count(), open_.count()
    odds = [met / max(1, vectors * asked_now) for met in _odds(packed, open_, n)]
    done, best, radius = [], None, -1
    mismatched = F.size(F.filter(F.zip_with("x", "held", lambda a, b: a != b), lambda d: d)).cast("double")
    while radius < n - 2 and asked_now:
        if tally is not None:
            tally.append(asked_now)
        plan = _next_round(odds, radius, asked_now, vectors, k)
        radius = plan.radius
        tasks = max(_tasks(packed), len(plan.sets) * (asked_now + vectors // 16) // per_task)
        near = materialize(_agreeing(packed, open_, n, k, plan, tasks), "knn-near")
        found = (
            near.join(packed.select("vector", F.col("grp").alias("own"), F.col("x").alias("held"), "donors"), "vector")
            .join(open_.select("row", "grp", "x"), "row")
            .select("grp", "x", "own", mismatched.alias("gap"), "donors")
            .where((F.col("own") == F.col("grp")) & (F.col("gap") <= radius))
            .select("grp", "x", "gap", F.inline("donors"))
        )
        if best is not None:
            found = found.unionByName(best.join(open_, ["grp", "x"], "left_semi"))
        # Donors that come twice, key and value, are one.
        best = materialize(_lowest(found.distinct(), k), "knn-best")
        enough = best.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        done.append(best.join(enough.select("grp", "x"), ["grp", "x"], "left_semi"))
        open_ = materialize(open_.join(enough, ["grp", "x"], "left_anti").select(*open_.columns), "knn-open")
        asked_now = open_.count()
    if not asked_now and done:
        return _union(done)
    if tally is not None:
        tally.append(asked_now)

    # One row for each feature and value, and one for all donors.
    values = F.posexplode(F.concat("x", F.array(F.lit("")))).alias("feature", "value")
    lowest = Window.partitionBy("grp", "feature", "value").orderBy("donor")
    top = (
        donors.select("grp", F.col("x").alias("held"), "donor", "y", values)
        .withColumn("nth", F.row_number().over(lowest))
        .where(F.col("nth") <= k)
        .drop("nth")
    )
    met = open_.select("grp", "x", values).join(materialize(top, "knn-tops"), ["grp", "feature", "value"])
    apart = F.size(F.filter(F.zip_with("x", "held", lambda a, b: a != b), lambda d: d))
    found = met.select("grp", "x", apart.cast("double").alias("gap"), "donor", "y")
    if best is not None:
        found = found.unionByName(best.join(open_, ["grp", "x"], "left_semi"))
    return _union([*done, _lowest(found.distinct(), k)])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def nearest_by_order(
    donors: DataFrame, asked: DataFrame, k: int, bins: int | None = None
) -> DataFrame:
    """:func:`nearest_by_distance` for one feature and group, where every power orders alike.

    Distinct donor values are numbered along the feature. The k nearest rows of a place
    lie within k donor values on either side, which an equi-join on the number fetches.
    """
    point = F.col("x")[0]
    held = donors.groupBy(point.alias("p")).agg(
        F.collect_list(F.struct("donor", "y")).alias("donors")
    )
    wanted = asked.select(point.alias("p"), F.lit(True).alias("asked"))

    # One row per distinct value, in range-partitioned bins.
    places = held.join(wanted, "p", "full")
    ranged = places.repartitionByRange(bins, "p") if bins else places.repartitionByRange("p")
    placed = materialize(ranged.withColumn("bin", F.spark_partition_id()), "knn-places")
    is_donor = F.col("donors").isNotNull().cast("long")

    # Number of a donor value = donor values in earlier bins + those up to it in its
    # bin. The bins are few: one row per partition.
    before = (
        Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy("bin")
        .agg(F.sum(is_donor).alias("inside"))
        .withColumn("offset", F.coalesce(F.sum("inside").over(before), F.lit(0)))
        .select("bin", "offset")
    )
    within = Window.partitionBy("bin").orderBy("p")
    numbered = materialize(
        placed.join(offsets, "bin")
        .withColumn("place", F.col("offset") + F.sum(is_donor).over(within))
        .select("p", "donors", "asked", "place"),
        "knn-numbered",
    )

    around = F.sequence(F.col("place") - (k - 1), F.col("place") + k)
    lookups = numbered.where("asked").select(
        F.col("p").alias("at"), F.explode(around).alias("place")
    )
    candidates = lookups.join(numbered.where("donors IS NOT NULL"), "place").select(
        F.lit(0).cast("long").alias("grp"), F.array("at").alias("x"), F.abs(F.col("p") - F.col("at")).alias("gap"), F.inline("donors")
    )
    return _lowest(candidates, k)
