"""Lanczos weights. The kernel is not widened for downscaling; taps outside
the image have no weight and the rest are normalised."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def kernel(x: float, a: int = 4) -> float:
    """sinc(x) * sinc(x / a) within a of 0."""
    if x == 0:
        return 1.0
    if abs(x) >= a:
        return 0.0
    return a * math.sin(math.pi * x) * math.sin(math.pi * x / a) / (math.pi**2 * x**2)


def weights(size: int, target: int, a: int = 4) -> list[list[tuple[int, float]]]:
    """For each output sample its (source, float32 weight) taps, in order.

    The centre is cut towards zero. Weights are rounded to float32 before and
    after they are divided by their sum, which is kept in double precision.
    """
    if size <= 0 or target <= 0:
        raise ValueError("sizes must be positive")
    if a != 4:
        raise NotImplementedError("only 4 lobes are supported")
    out = []
    for k in range(target):
        at = (k + 0.5) * (size / target) - 0.5
        centre = int(at)
        taps = [(i, np.float32(kernel(at - i, a))) for i in range(centre - a + 1, centre + a + 1) if 0 <= i < size]
        total = sum(float(w) for _, w in taps)
        out.append([(i, float(np.float32(float(w) / total)) if total > 0 else float(w)) for i, w in taps])
    return out


def taps(size: int, target: int, a: int = 4) -> tuple[Column, Column]:
    """The table as two array literals, 2 * a places and weights for each
    output sample one after the other; those outside the image weigh 0."""
    table = weights(size, target, a)
    at, w = np.zeros((target, 2 * a), dtype=np.int32), np.zeros((target, 2 * a), dtype=np.float32)
    for o, own in enumerate(table):
        for k, (i, x) in enumerate(own):
            at[o, k], w[o, k] = i, x
    return F.lit(at.reshape(-1)), F.lit(w.reshape(-1))


def convolve(value: str, target: int, a: int = 4) -> str:
    """SQL for ``target`` weighted sums, given the columns ``at`` and ``w`` and
    the value at place ``{i}``: float products, summed in double precision in
    the order of the taps, rounded to float."""
    n = 2 * a
    source = value.format(i=f"at[o * {n} + k]")
    return f"transform(sequence(0, {target - 1}), o -> cast(aggregate(sequence(0, {n - 1}), 0D, (s, k) -> s + cast(cast({source} as float) * w[o * {n} + k] as double)) as float))"


def resize_array(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """The same arithmetic on an array (height, width), as float32."""
    out = image.astype(np.float32)
    for axis, target in ((1, width), (0, height)):
        table = weights(out.shape[axis], target)
        moved = np.moveaxis(out, axis, 0)
        rows = []
        for taps in table:
            total = np.zeros(moved.shape[1:], dtype=np.float64)
            for i, w in taps:
                total += moved[i] * np.float32(w)
            rows.append(total.astype(np.float32))
        out = np.moveaxis(np.stack(rows), 0, axis)
    return out
