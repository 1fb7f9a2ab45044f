"""Lines and frames between Arrow and NumPy, without a Python value for each
pixel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def ends_of(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins in the flattened values, and the last one ends."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def frames_of(lines: pa.ListArray, field: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row, a list of structs of ``y`` and the field: the numbers of
    its lines, ascending, and their values, (height, width) for a field that is
    a list or (height, channels, width) for one of lists."""
    at, rows = ends_of(lines), lines.flatten()
    y, values = rows.field("y").to_numpy(zero_copy_only=False), rows.field(field)
    ends, channels = ends_of(values), None
    values = values.flatten()
    if pa.types.is_list(values.type):
        channels, ends, values = ends, ends_of(values)[ends], values.flatten()
    values = values.to_numpy(zero_copy_only=False)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        order = np.argsort(y[a:b], kind="stable")
        shape = (b - a, -1) if channels is None else (b - a, max(1, int(channels[b] - channels[a]) // max(1, b - a)), -1)
        own = values[ends[a] : ends[b]]
        out.append((y[a:b][order], own.reshape(shape)[order] if len(own) else own.reshape(*shape[:-1], 0)))
    return out


def lists_of(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An array of two dimensions or more as lists, or lists of lists."""
    out = pa.array(np.ascontiguousarray(values).reshape(-1), kind)
    for k in range(values.ndim - 1, 0, -1):
        n, width = int(np.prod(values.shape[:k])), values.shape[k]
        out = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), out)
    return out
