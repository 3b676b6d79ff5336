"""Content-defined segments: all windows of a text by the anchor that they hold.

Of the grams of a window the one of smallest hash, leftmost on a tie, is its
anchor. Windows of equal bytes have equal anchors at equal places. Successive
windows of one anchor form a segment.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WINDOW = 200
GRAM = 32
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)


class Segments(NamedTuple):
    """Segments of a block; places count bytes from the beginning of the block."""

    first: np.ndarray  # of the first window
    windows: np.ndarray  # number of windows
    anchor: np.ndarray  # hash of the anchor
    shift: np.ndarray  # of the anchor from the first window


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of every gram of ``data``, of its bytes alone."""
    n = len(data)
    if n < gram:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    value = (sums[gram:] - sums[:-gram]) * powers(INVERSE, n)[: n - gram + 1]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return value


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` successive values."""
    held, span = values, 1
    while 2 * span <= width:
        held = np.minimum(held[:-span], held[span:])
        span *= 2
    rest = width - span
    return np.minimum(held[:-rest], held[rest:]) if rest else held


def segments(data: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Segments:
    """Segments of texts that lie one after the other in ``data``; none crosses two texts."""
    empty = np.zeros(0, np.int64)
    if len(data) < window:
        return Segments(empty, empty, empty.astype(np.uint64), empty)
    hashes = gram_hashes(data, gram)
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_minimum(packed, window - gram + 1)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(at), bool)
    for size, end in zip(sizes.tolist(), ends.tolist()):
        # Windows that begin here run into the next text.
        inside[max(end - size, end - window + 1) : end] = False
    begins = np.empty(len(at), bool)
    begins[0] = True
    begins[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(begins & inside)
    stop = np.flatnonzero(np.r_[begins[1:] | ~inside[1:], True] & inside)
    return Segments(first, stop - first + 1, hashes[at[first]], at[first] - first)
