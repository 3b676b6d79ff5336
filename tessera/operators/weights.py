"""Model weights for the tasks: broadcast while small, a mapped file above that.

A broadcast is unpickled by every Python worker into memory of its own. Larger weights
are one file in the shared folder, named by their hash, that Spark brings to each
executor once. Its workers map the file, so that a host holds the pages once, and an
executor that replaces a lost one fetches it again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark import Broadcast, SparkFiles
from pyspark.sql import SparkSession

from tessera.sources.files import _store
from tessera.workspace import shared_folder

BROADCAST_BYTES = 8 << 20
ALIGNED = 64

# Type, shape and first byte of each array.
Places = list[tuple[str, tuple[int, ...], int]]


class MappedWeights:
    """Weights in a file that executors hold; ``value`` are read-only arrays on its pages."""

    def __init__(self, name: str, places: Places) -> None:
        self.name = name
        self.places = places

    @property
    def value(self) -> list[np.ndarray]:
        pages = np.memmap(SparkFiles.get(self.name), np.uint8, mode="r")
        arrays = []
        for kind, shape, start in self.places:
            size = np.dtype(kind).itemsize * int(np.prod(shape, dtype=np.int64))
            arrays.append(pages[start : start + size].view(kind).reshape(shape))
        return arrays


def layout(arrays: Sequence[np.ndarray]) -> tuple[Places, int]:
    places: Places = []
    end = 0
    for array in arrays:
        start = -(-end // ALIGNED) * ALIGNED
        places.append((array.dtype.str, array.shape, start))
        end = start + array.nbytes
    return places, end


def mapped_weights(spark: SparkSession, weights: Sequence[np.ndarray]) -> MappedWeights:
    """One file for all arrays, written once however often the same weights are given.

    The arrays need not be of one type or contiguous, but hold numbers, not objects.
    """
    arrays = [np.asarray(array) for array in weights]
    if any(array.dtype.hasobject for array in arrays):
        raise TypeError("weights must be arrays of numbers")
    places, size = layout(arrays)
    if not size:
        raise ValueError("weights without any number cannot be mapped")
    digest = hashlib.sha256(repr(places).encode())
    for array in arrays:
        digest.update(np.ascontiguousarray(array).data)
    name = f"weights-{digest.hexdigest()}"
    path = f"{shared_folder(spark)}/{name}"
    store, inner = _store(path)
    if store.get_file_info(inner).size != size:
        with store.open_output_stream(inner, compression=None) as out:
            end = 0
            for array, (_, _, start) in zip(arrays, places):
                out.write(bytes(start - end))
                out.write(np.ascontiguousarray(array).data)
                end = start + array.nbytes
    spark.sparkContext.addFile(path)
    return MappedWeights(name, places)


def shared_weights(
    spark: SparkSession, weights: Any, limit: int = BROADCAST_BYTES
) -> Broadcast | MappedWeights:
    """A handle with the weights as its ``value``: broadcast up to ``limit`` bytes of arrays.

    What is a handle already stays as it is; weights that are not a sequence of arrays
    have no size that could be checked and are broadcast.
    """
    if isinstance(weights, (Broadcast, MappedWeights)):
        return weights
    numeric = isinstance(weights, (list, tuple)) and all(
        isinstance(array, np.ndarray) and not array.dtype.hasobject for array in weights
    )
    if numeric and sum(array.nbytes for array in weights) > limit:
        return mapped_weights(spark, weights)
    return spark.sparkContext.broadcast(weights)
