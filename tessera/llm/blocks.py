"""Arrow batches in blocks of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20
SET_BYTES = 2 << 20  # where words, shingles or lines take several times the bytes of the text


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of ``batches`` with ``limit`` bytes in ``column`` at most, or one row.

    No row is left out or cut: a longer text is a block of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts, null as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def large_texts(texts: pa.Array) -> pa.Array:
    """The texts as an array of its own (not a slice) with wide offsets, null as empty."""
    own = texts.take(pa.array(range(len(texts)), pa.int64()))
    return pc.fill_null(own.cast(pa.large_string()), "")
