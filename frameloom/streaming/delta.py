"""Delta coding of frames as they arrive.

A running window is not possible on a stream. Each line's last picture is kept
as state instead, keyed by (clip_id, y), and frames of a micro-batch are coded
in order of their numbers. A frame that arrives after a later one can't be coded
any more, since its successors have been coded without it: it comes out raw and
marked ``late``, for a sink of its own or a rerun of the clip.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUT = "clip_id string, frame_no long, y int, row array<int>, late boolean"
_STATE = "frame_no long, row array<int>"


def _code(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches)).sort_values("frame_no", kind="stable")
    if not len(rows):
        return
    last, before = state.get if state.exists else (-1, None)
    numbers = rows["frame_no"].to_numpy()
    # Late are those up to the last number coded, and a number's second row.
    late = (numbers <= last) | (np.diff(numbers, prepend=last) <= 0)
    lines = rows["row"].to_numpy().copy()
    good = np.flatnonzero(~late)
    if len(good):
        new = np.stack(lines[good]).astype(np.int32)
        first = np.zeros_like(new[:1]) if before is None else np.array(before, dtype=np.int32)[None]
        coded = new ^ np.concatenate([first, new[:-1]])
        for k, line in zip(good.tolist(), coded, strict=True):
            lines[k] = line
        state.update((int(numbers[good[-1]]), new[-1].tolist()))
    yield pd.DataFrame({"clip_id": str(key[0]), "frame_no": numbers, "y": int(key[1]), "row": lines, "late": late})


def delta_encode_stream(scanlines: DataFrame) -> DataFrame:
    """(clip_id, frame_no, y, row, late) of a stream of one-channel bit lines
    with the first four columns; the first frame of each line is raw, and so
    are late ones."""
    return scanlines.groupBy("clip_id", "y").applyInPandasWithState(_code, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
