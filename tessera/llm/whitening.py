"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it. A pass over the
centred rows X computes XᵀXQ for a block Q of a few vectors; a polynomial in the covariance,
one pass a degree, damps the unwanted part of the spectrum; QR and a Rayleigh-Ritz step
follow, until residuals certify the pairs and fresh vectors find nothing that was missed.

What the driver holds is the block: as many numbers as a vector has, for each of some 32.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.workspace import materialize

# Entries are kept within these, where sums over a block are exact. Bytes of a block.
LARGEST = 2**48
BLOCK_BYTES = 4 << 20
LONGEST = 2**63 - 1

# Vectors beside the wanted ones; degrees of a filter; residuals, over the largest
# eigenvalue, at which a pair is certified, and at which it is if they fall no more.
GUARDS = 16
DEGREES = (4, 24)
TOLERANCE, FLOOR = 1e-14, 1e-12
ROUNDS = 12


class Fit(NamedTuple):
    """Distinct vectors as packed blocks, and what all of them add up to."""

    blocks: DataFrame
    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray


class Components(NamedTuple):
    """Eigenvectors by falling eigenvalue, and the trace of the covariance."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float


def entries(vector: Column, scale: int, offset: int, dims: int) -> Column:
    """``floor(scale * c) + offset`` of each entry; shorter vectors go on with zeros."""

    def entry(c: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
        return scaled + F.lit(offset).cast("long")

    zeros = F.array_repeat(F.lit(offset).cast("long"), F.lit(dims) - F.size(vector))
    return F.concat(F.transform(vector, entry), zeros)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Arrays of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def pieces(rows: np.ndarray) -> Iterator[slice]:
    step = max(1, BLOCK_BYTES // max(8 * rows.shape[1], 1))
    return (slice(at, min(at + step, len(rows))) for at in range(0, len(rows), step))


def packed(x: DataFrame, dims: int) -> Fit:
    """Distinct ``x`` in blocks: entries above the lowest, in as few bytes as they need."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(0), dims)
            for part in pieces(rows):
                held = rows[part]
                low = int(held.min())
                width = next(w for w in (1, 2, 4, 8) if int(held.max()) - low < 256**w)
                yield pa.RecordBatch.from_pydict(
                    {
                        "n": [len(held)],
                        "low": [low],
                        "width": [width],
                        "data": [(held - low).astype(f"<u{width}").tobytes()],
                        "sums": [held.sum(axis=0).tolist()],
                    }
                )

    schema = "n long, low long, width long, data binary, sums array<long>"
    blocks = materialize(x.select("x").distinct().mapInArrow(pack, schema), "fit-blocks")
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    by_place = blocks.select(F.posexplode("sums").alias("place", "s")).groupBy("place")
    added = by_place.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * dims
    for row in added:
        sums[row.place] = int(row.s)
    # The mean is a whole part and a rest, so that centring loses no digit.
    whole = [round(s / n) if abs(s) < 2**53 else s // n for s in sums] if n else sums
    rest = [(s - n * w) / n for s, w in zip(sums, whole)] if n else sums
    return Fit(blocks, n, sums, np.array(whole, np.int64), np.array(rest, float))


def totals(fit: Fit, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``of`` summed over all centred blocks: one row a task, added up place by place."""
    centre, rest, dims = fit.centre, fit.rest, len(fit.centre)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for low, width, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                rows = np.frombuffer(data, f"<u{width}").reshape(-1, dims).astype(np.int64)
                part = of((rows + (low - centre)).astype(float) - rest).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"total": pa.array([total], pa.list_(pa.float64()))})

    each = fit.blocks.select("low", "width", "data").mapInArrow(work, "total array<double>")
    added = (
        each.select(F.posexplode("total").alias("place", "part"))
        .groupBy("place")
        .agg(F.sum("part").alias("part"))
        .toArrow()
    )
    out = np.zeros(len(added))
    out[added.column("place").to_numpy()] = added.column("part").to_numpy()
    return out


def covariance_times(fit: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """One pass over the rows for each call."""

    def times(q: np.ndarray) -> np.ndarray:
        return totals(fit, lambda x: x.T @ (x @ q)).reshape(q.shape) / fit.n

    return times


def chebyshev(
    times: Callable, q: np.ndarray, image: np.ndarray | None, low: float, cut: float, top: float, degree: int
) -> np.ndarray:
    """The polynomial that stays small from ``low`` to ``cut`` and grows beyond, applied to ``q``.

    ``image`` is ``times(q)`` where that is known. The recurrence is scaled by its value
    at ``top``, so that it cannot overflow.
    """
    middle, half = (cut + low) / 2, (cut - low) / 2
    sigma = first = half / (top - middle)
    before, now = q, ((times(q) if image is None else image) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def ritz(times: Callable, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Orthonormal Ritz vectors by falling value, their images, values and residuals."""
    scale = np.linalg.norm(block, axis=0)
    q = np.linalg.qr(block / np.where(scale > 0, scale, 1))[0]
    q = np.linalg.qr(q)[0]
    image = times(q)
    values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, image = q @ turn, image @ turn
    return q, image, values, np.linalg.norm(image - q * values, axis=0)


def leading(times: Callable, dims: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` eigenvectors of largest eigenvalue of a symmetric operator, certified.

    A block that does not settle within ``ROUNDS`` rounds is doubled; when it spans the
    whole space the Rayleigh-Ritz step is exact, so that there is an end.
    """
    draw = np.random.default_rng(seed)
    size = min(dims, wanted + GUARDS)
    q, image, values, gaps = ritz(times, draw.standard_normal((dims, size)))
    low, worst, rounds = math.inf, math.inf, 0
    while True:
        top = max(values[0], 0.0)
        low = max(min(low, (values - gaps).min()), 0.0)
        before, worst = worst, gaps[:wanted].max()
        settled = worst <= TOLERANCE * top or worst <= FLOOR * top and worst > before / 2
        if size == dims or top == 0:
            return q[:, :wanted], values[:wanted]
        if settled:
            missed = _missed(times, q[:, :wanted], values[wanted - 1], low, top, draw)
            if missed is None:
                return q[:, :wanted], values[:wanted]
            block = np.hstack([q, missed])[:, :dims]
            size, worst, rounds = block.shape[1], math.inf, 0
        elif rounds == ROUNDS:
            more = min(size, dims - size)
            block = np.hstack([q, draw.standard_normal((dims, more))])
            size, rounds = size + more, 0
        else:
            cut = values[(wanted + size) // 2]
            if cut <= low:
                cut = (low + values[wanted - 1]) / 2
            if not low < cut < top:
                block = np.hstack([q, draw.standard_normal((dims, min(size, dims - size)))])
                size = block.shape[1]
            else:
                degree = _degree(values, wanted, low, cut, worst / (TOLERANCE * top))
                block = chebyshev(times, q, image, low, cut, top, degree)
        q, image, values, gaps = ritz(times, block)
        rounds += 1


def _degree(values: np.ndarray, wanted: int, low: float, cut: float, reduction: float) -> int:
    """As high as the residuals need, unless the largest pair would drown the last one."""
    middle, half = (cut + low) / 2, (cut - low) / 2
    last = math.acosh(max((values[wanted - 1] - middle) / half, 1 + 1e-9))
    first = math.acosh(max((values[0] - middle) / half, 1 + 1e-9))
    needed = math.acosh(max(reduction, 1.0)) / last
    drowned = math.log(1e8) / (first - last) if first > last else math.inf
    return int(max(min(needed + 1, drowned, DEGREES[1]), min(DEGREES[0], drowned), 1))


def _missed(times, q, value, low, top, draw) -> np.ndarray | None:
    """Fresh vectors outside ``q``, filtered above ``value``, if one of them lies above it."""
    if not low < value < top:
        return None
    fresh = draw.standard_normal((len(q), min(GUARDS, len(q) - q.shape[1])))
    fresh = np.linalg.qr(fresh - q @ (q.T @ fresh))[0]
    fresh = chebyshev(times, fresh, None, low, value, top, 2 * DEGREES[0])
    fresh -= q @ (q.T @ fresh)
    fresh, _, values, _ = ritz(times, fresh)
    return fresh if values[0] > value * (1 + 1e-9) else None


def components_of(fit: Fit, wanted: int) -> Components:
    """Components of positive variance, ``wanted`` at most."""
    dims = len(fit.centre)
    if not fit.n or not dims:
        return Components(np.zeros((dims, 0)), np.zeros(0), 0.0)
    trace = float(math.fsum(totals(fit, lambda x: (x * x).sum(axis=0))) / fit.n)
    if trace == 0:
        return Components(np.zeros((dims, 0)), np.zeros(0), 0.0)
    vectors, values = leading(covariance_times(fit), dims, min(wanted, dims))
    kept = values > values[0] * 1e-12
    return Components(vectors[:, kept], values[kept], trace)


def whiten(
    vectors: DataFrame,
    wanted: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    column: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become ``x = floor(scale * c) + offset``. Covariances are over the ``n`` distinct
    x-vectors. For each row and leading component: the row's squared deviation from the
    mean times ``n`` squared, its whitened coordinate, the component's share of the
    variance, and the largest deviation of the whitened covariance from the identity.

    Rows whose vector is null or holds a null or an entry that is not finite are left out.
    Shorter vectors, empty ones too, go on with entries of 0; scaled entries stop at 2**48 on either
    side, and a deviation at the end of the longs. Repeated rows are returned each and
    fitted once; a null ``vec_id`` is returned. Components without variance (below 1e-12 of the
    first) have no coordinate and no rows: none for an empty table or equal vectors.
    Other columns are not read.
    """
    vector = F.col(column)
    good = vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    kept = vectors.where(good).select("vec_id", vector.alias("vector"))
    dims = kept.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    rows = materialize(
        kept.select("vec_id", entries(F.col("vector"), scale, offset, dims).alias("x")), "entries"
    )
    schema = (
        f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, "
        "deviation long, whitened double, explained double, identity_error double"
    )
    if not dims:
        return rows.sparkSession.createDataFrame([], schema)
    fit = packed(rows, dims)
    found = components_of(fit, wanted)
    turn = found.vectors / np.sqrt(found.values)
    held = len(found.values)
    if not held:
        return rows.sparkSession.createDataFrame([], schema)
    gram = totals(fit, lambda x: (x @ turn).T @ (x @ turn)).reshape(held, held) / fit.n
    error = float(np.abs(gram - np.eye(held)).max())
    explained = found.values / found.trace
    n, centre, rest = fit.n, fit.centre, fit.rest
    over = np.array([s - n * int(w) for s, w in zip(fit.sums, centre)], object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            for part in pieces(x):
                away = x[part] - centre
                times = away.shape[0] * [held]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part].take(pa.array(np.repeat(np.arange(len(away)), held))),
                        pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), len(away))),
                        pa.array(np.full(sum(times), n)),
                        pa.array(np.repeat(_squares(away, n, over), held)),
                        pa.array(((away.astype(float) - rest) @ turn).ravel()),
                        pa.array(np.tile(explained, len(away))),
                        pa.array(np.full(sum(times), error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)


def _squares(away: np.ndarray, n: int, over: np.ndarray) -> np.ndarray:
    """``sum((n * away - over) ** 2)`` of each row; Python's integers where longs may not do."""
    most = n * int(np.abs(away).max(initial=0)) + max(map(abs, over), default=0)
    if most * most * away.shape[1] <= LONGEST:
        return ((n * away - over.astype(np.int64)) ** 2).sum(axis=1)
    exact = ((n * away.astype(object) - over) ** 2).sum(axis=1)
    return np.array([min(int(v), LONGEST) for v in exact], np.int64)
