"""Feature vectors from batches, with model weights shared once.

A model is a function ``model_fn(weights) -> predict`` where ``predict`` maps an
array whose first axis is the batch to an array of the same first axis. It is called
once per Python task, on the shared weights, and its result is reused for every
batch of that task. The handle of the weights travels in the closure of the UDF.

What the model is given at once is bounded by rows and by bytes of payload: decoded
pixels are held until either bound is reached, and a larger image is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.pixels import (
    FEATURE_WIDTH,
    INPUT_SIZE,
    pixels_from_rows,
    resize_all,
    scale_pixels,
)
from tessera.operators.weights import shared_weights

BATCH_BYTES = 64 << 20

Predict = Callable[[np.ndarray], np.ndarray]
ModelFn = Callable[[Any], Predict]


def linear_model(weights: Sequence[np.ndarray]) -> Predict:
    """Matrix product with ``weights[0]``, one output per row of the matrix."""
    matrix = np.asarray(weights[0], dtype=np.float64)
    return lambda batch: batch.astype(np.float64) @ matrix.T


def pooled_weights(seed: int = 42) -> list[np.ndarray]:
    """Stand-in weights for :func:`pooled_model`: 7 x 7 x 3 pooled cells to 1280."""
    draws = np.random.default_rng(seed)
    cells = 7 * 7 * 3
    kernel = draws.normal(0.0, cells**-0.5, (cells, FEATURE_WIDTH)).astype(np.float32)
    return [kernel, draws.normal(0.0, 0.1, FEATURE_WIDTH).astype(np.float32)]


def pooled_model(weights: Sequence[np.ndarray]) -> Predict:
    """224 x 224 x 3 to 1280 by average pooling, projection and a clip to 0..6.

    It has the shape and the cost structure of the pre-trained network's last inner
    layer, not its learned values; pass a model of your own for these.
    """
    kernel, bias = weights

    def predict(batch: np.ndarray) -> np.ndarray:
        step = INPUT_SIZE // 7
        rows = batch.reshape(len(batch), 7, step, -1).sum(axis=2)
        cells = rows.reshape(len(batch), 7, 7, step, 3).sum(axis=3) / step**2
        return np.clip(cells.reshape(len(batch), -1) @ kernel + bias, 0.0, 6.0)

    return predict


def bounded_batches(
    inputs: Iterable[tuple[int, np.ndarray]], batch_rows: int, batch_bytes: int
) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Row numbers and arrays, ``batch_rows`` and ``batch_bytes`` at most, or one larger array.

    ``inputs`` is read as batches are asked for: besides the batch, one array is held.
    """
    if batch_rows < 1 or batch_bytes < 1:
        raise ValueError("a batch holds one row and one byte at least")
    rows: list[int] = []
    held: list[np.ndarray] = []
    size = 0
    for row, array in inputs:
        if rows and (len(rows) == batch_rows or size + array.nbytes > batch_bytes):
            yield rows, held
            rows, held, size = [], [], 0
        rows.append(row)
        held.append(array)
        size += array.nbytes
    if rows:
        yield rows, held


def _in_batches(
    predict: Predict,
    prepare: Callable[[list[np.ndarray]], np.ndarray],
    inputs: Iterable[tuple[int, np.ndarray]],
    total: int,
    batch_rows: int,
    batch_bytes: int,
) -> pd.Series:
    """Vectors for ``total`` rows, null where ``inputs`` has none."""
    vectors = np.empty(total, dtype=object)
    for rows, held in bounded_batches(inputs, batch_rows, batch_bytes):
        flat = np.asarray(predict(prepare(held))).reshape(len(rows), -1)
        for row, vector in zip(rows, flat):
            vectors[row] = vector
    return pd.Series(vectors)


def _network_input(images: list[np.ndarray]) -> np.ndarray:
    return scale_pixels(resize_all(images))


def vector_features(
    df: DataFrame,
    column: str,
    weights: Sequence[np.ndarray],
    model_fn: ModelFn = linear_model,
    *,
    element: str = "float",
    batch_rows: int = 4096,
    batch_bytes: int = BATCH_BYTES,
    keep: Sequence[str] = ("path", "label"),
) -> DataFrame:
    """``path, label, features`` from an array column; a null vector stays null."""
    shared = shared_weights(df.sparkSession, weights)

    @F.pandas_udf(f"array<{element}>")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = model_fn(shared.value)
        for batch in batches:
            given = ((row, vector) for row, vector in enumerate(batch) if vector is not None)
            yield _in_batches(predict, np.stack, given, len(batch), batch_rows, batch_bytes)

    return df.select(*keep, infer(column).alias("features"))


def image_features(
    images: DataFrame,
    weights: Sequence[np.ndarray],
    model_fn: ModelFn = pooled_model,
    *,
    on_error: str = "null",
    partitions: int | None = None,
    batch_rows: int = 64,
    batch_bytes: int = BATCH_BYTES,
    keep: Sequence[str] = ("path", "label"),
) -> DataFrame:
    """``path, label, features`` from decoded images (an ``image`` struct column).

    ``on_error`` says what becomes of an image that could not be decoded: ``null``
    keeps its row without features, ``drop`` leaves it out, ``raise`` fails the job
    with its path. ``partitions`` shuffles all pixels, so it is for inputs whose scan
    has too few tasks; elsewhere size the scan with ``spark.sql.files.*``.
    """
    readable = F.col("image.height") > 0
    if on_error == "drop":
        images = images.where(readable)
    elif on_error not in ("null", "raise"):
        raise ValueError(f"on_error must be null, drop or raise, not {on_error!r}")
    if partitions is not None:
        images = images.repartition(partitions)
    pixels = F.col("image.data")
    if on_error == "raise":
        pixels = F.when(readable, pixels).otherwise(
            F.raise_error(F.concat(F.lit("not a readable image: "), F.col(keep[0]))).cast("binary")
        )
    shared = shared_weights(images.sparkSession, weights)

    @F.pandas_udf("array<float>")
    def infer(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        predict = model_fn(shared.value)
        for heights, widths, channels, data in batches:
            given = pixels_from_rows(heights, widths, channels, data)
            yield _in_batches(predict, _network_input, given, len(data), batch_rows, batch_bytes)

    features = infer(
        F.col("image.height"), F.col("image.width"), F.col("image.nChannels"), pixels
    )
    return images.select(*keep, features.alias("features"))


def content_features(
    images: DataFrame,
    weights: Sequence[np.ndarray],
    model_fn: ModelFn = pooled_model,
    *,
    decode: Callable[[bytes], np.ndarray],
    batch_rows: int = 64,
    batch_bytes: int = BATCH_BYTES,
    keep: Sequence[str] = ("path", "label"),
) -> DataFrame:
    """``path, label, features, error`` from a binary ``content`` column.

    For images kept as bytes in a table. ``decode`` gives height x width x 3 RGB bytes
    or raises ``ValueError``. A row that cannot be decoded has no
    features and says why in ``error``; errors of the model itself fail the job.
    """
    shared = shared_weights(images.sparkSession, weights)

    @F.pandas_udf("features array<float>, error string")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = model_fn(shared.value)
        for batch in batches:
            errors = np.empty(len(batch), dtype=object)

            def decoded(batch=batch, errors=errors) -> Iterator[tuple[int, np.ndarray]]:
                for row, content in enumerate(batch):
                    try:
                        pixels = decode(content)
                    except ValueError as error:
                        errors[row] = str(error)
                        continue
                    yield row, pixels

            features = _in_batches(
                predict, _network_input, decoded(), len(batch), batch_rows, batch_bytes
            )
            yield pd.DataFrame({"features": features, "error": errors})

    return images.select(*keep, infer("content").alias("out")).select(*keep, "out.*")
