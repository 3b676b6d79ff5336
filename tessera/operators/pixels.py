"""Pixel work inside a task: channel order, resizing and scaling of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

# The network's input side and the width of its last inner layer.
INPUT_SIZE = 224
FEATURE_WIDTH = 1280


def pixels_from_rows(
    heights: Iterable, widths: Iterable, channels: Iterable, data: Iterable
) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers of the rows that were decoded, and their RGB arrays, one after the other.

    The image source stores blue first; grey images get three equal channels and a
    fourth, alpha, is dropped.
    """
    for row, (height, width, depth, raw) in enumerate(zip(heights, widths, channels, data)):
        if raw is None or not height > 0:
            continue
        pixels = np.frombuffer(raw, dtype=np.uint8).reshape(int(height), int(width), int(depth))
        if depth == 1:
            pixels = np.repeat(pixels, 3, axis=2)
        else:
            pixels = pixels[:, :, 2::-1]
        yield row, pixels


def scale_pixels(pixels: np.ndarray) -> np.ndarray:
    """0..255 to -1..1."""
    return np.asarray(pixels, dtype=np.float32) / np.float32(127.5) - np.float32(1.0)


def resize_all(images: Sequence[np.ndarray], side: int = INPUT_SIZE) -> np.ndarray:
    """``side`` x ``side`` images, whole numbers 0..255; equal sizes are resized together."""
    resized = np.empty((len(images), side, side, 3), dtype=np.float32)
    by_size: dict[tuple[int, int], list[int]] = {}
    for i, image in enumerate(images):
        by_size.setdefault(image.shape[:2], []).append(i)
    for (height, width), members in by_size.items():
        batch = np.stack([images[i] for i in members]).astype(np.float32)
        batch = _along(batch, _bicubic(width, side), axis=2)
        resized[members] = _along(batch, _bicubic(height, side), axis=1)
    return resized


def _along(batch: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """One pass of a separable resize, as one matrix product; whole numbers out."""
    target, source = weights.shape
    if target == source:
        return batch
    moved = np.moveaxis(batch, axis, 0)
    passed = weights @ np.ascontiguousarray(moved).reshape(source, -1)
    np.clip(np.rint(passed, out=passed), 0, 255, out=passed)
    return np.moveaxis(passed.reshape(target, *moved.shape[1:]), 0, axis)


def _bicubic(source: int, target: int) -> np.ndarray:
    """Weights of cubic convolution (a = -0.5), widened when the image shrinks."""
    ratio = source / target
    spread = max(ratio, 1.0)
    centres = (np.arange(target) + 0.5) * ratio
    distance = np.abs((np.arange(source) + 0.5)[None, :] - centres[:, None]) / spread
    near = 1.5 * distance**3 - 2.5 * distance**2 + 1.0
    far = -0.5 * distance**3 + 2.5 * distance**2 - 4.0 * distance + 2.0
    weights = np.where(distance < 1.0, near, np.where(distance < 2.0, far, 0.0))
    return (weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)
