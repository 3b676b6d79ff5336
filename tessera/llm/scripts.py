"""Scripts of letters by ranges of code points."""

from __future__ import annotations

import numpy as np

# First and last code point of the blocks of each script.
RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6),
              (0xF8, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x5D0, 0x5F4)],
    "arabic": [(0x620, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
NAMES = ["other", *RANGES]


def script_table() -> np.ndarray:
    """Number of the script in ``NAMES`` of every code point; 0 for all others."""
    script = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(RANGES.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return script


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def main_script(text: str, script: np.ndarray) -> str:
    """The script of most letters, the first in ``NAMES`` on a tie; ``other`` without any."""
    counts = np.bincount(script[code_points(text)], minlength=len(NAMES))
    counts[0] = 0
    return NAMES[int(counts.argmax())] if counts.any() else NAMES[0]
