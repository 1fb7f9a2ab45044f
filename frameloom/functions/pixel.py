"""Per-pixel expressions. All float results are cut, not rounded, and every
comparison with a threshold is strict."""

from __future__ import annotations

# The ordered dither matrices, in steps of 1/4, 1/16 and 1/64.
BAYER = {
    "bayer2x2": ((0, 2), (3, 1)),
    "bayer4x4": ((0, 8, 2, 10), (12, 4, 14, 6), (3, 11, 1, 9), (15, 7, 13, 5)),
    "bayer8x8": (
        (0, 32, 8, 40, 2, 34, 10, 42),
        (48, 16, 56, 24, 50, 18, 58, 26),
        (12, 44, 4, 36, 14, 46, 6, 38),
        (60, 28, 52, 20, 62, 30, 54, 22),
        (3, 35, 11, 43, 1, 33, 9, 41),
        (51, 19, 59, 27, 49, 17, 57, 25),
        (15, 47, 7, 39, 13, 45, 5, 37),
        (63, 31, 55, 23, 61, 29, 53, 21),
    ),
}
#: How far an ordered dither moves the threshold, in all.
SPREAD = 64


def matrix(pattern: str) -> list[list[float]]:
    """A dither matrix in [0, 1)."""
    if pattern not in BAYER:
        raise ValueError(f"unknown dither pattern {pattern!r}; use one of {sorted(BAYER)}")
    rows = BAYER[pattern]
    return [[v / len(rows) ** 2 for v in row] for row in rows]


def gray(r: str, g: str, b: str) -> str:
    """SQL for the luma of three channels: doubles, clamped, cut."""
    return f"cast(least(255D, greatest(0D, 0.299D * {r} + 0.587D * {g} + 0.114D * {b})) as int)"


def clamp(v: str, dtype: str) -> str:
    """SQL for a float in the range of an image's values, cut towards zero."""
    ranges = {"uint8": 255, "uint16": 65535}
    return f"cast(least({ranges[dtype]}D, greatest(0D, cast({v} as double))) as int)" if dtype in ranges else f"cast({v} as double)"


def over(v: str, threshold: float) -> str:
    return f"if({v} > {threshold!r}D, 1, 0)" if isinstance(threshold, float) else f"if({v} > {int(threshold)}, 1, 0)"


def dithered(v: str, x: str, y: str, threshold: float, pattern: str) -> str:
    """SQL for an ordered dither; the matrix is a literal."""
    rows = matrix(pattern)
    cells = ", ".join("array(" + ", ".join(f"{float(threshold) + (m - 0.5) * SPREAD!r}D" for m in row) + ")" for row in rows)
    n = len(rows)
    return f"if({v} > array({cells})[{y} % {n}][{x} % {n}], 1, 0)"
