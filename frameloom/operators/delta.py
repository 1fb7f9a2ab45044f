"""XOR delta and run-length coding of one-bit clips, and both decoders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import planes
from ..schema import Clip, ProcessingError, binary_violations, require
from .neighbours import CHUNK, with_previous

CAP = 255


def delta_encode(scanlines: DataFrame, *, key_every: int | None = None) -> DataFrame:
    """Lines XORed with those of the frame before. Key frames stay raw: the
    first, and with ``key_every`` the first of each so many numbers."""
    key = F.col("before").isNull()
    if key_every:
        key = key | F.expr(f"frame_no div {key_every} <> before_no div {key_every}")
    xor = F.expr("zip_with(planes, before, (p, q) -> zip_with(p, q, (a, b) -> a ^ b))")
    return with_previous(scanlines).select("clip_id", "frame_no", "y", F.when(key, F.col("planes")).otherwise(xor).alias("planes"))


def _lines(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """The values of all planes, a copy, where each row's begin (and the last
    end), and the planes themselves."""
    lines = batch.column("planes")
    inner = lines.flatten()
    return inner.flatten().to_numpy(zero_copy_only=False).copy(), planes.ends_of(inner)[planes.ends_of(lines)], lines


def _again(lines: pa.ListArray, values: np.ndarray) -> pa.ListArray:
    """Planes of the same shape with other values."""
    inner = pa.ListArray.from_arrays(pa.array(planes.ends_of(lines.flatten()), pa.int32()), pa.array(values, pa.int32()))
    return pa.ListArray.from_arrays(pa.array(planes.ends_of(lines), pa.int32()), inner)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running XORs of sorted (clip_id, y, segment, frame_no, planes)."""
    key, state = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values, at, lines = _lines(batch)
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("clip_id", "y", "segment")), strict=True))
        a = 0
        while a < len(keys):
            b = a + 1
            while b < len(keys) and keys[b] == keys[a]:
                b += 1
            own = values[at[a] : at[b]].reshape(b - a, -1)  # lines of one place are of one width
            if keys[a] == key:
                own[0] ^= state
            np.bitwise_xor.accumulate(own, axis=0, out=own)
            key, state, a = keys[a], own[-1].copy(), b
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("clip_id", "frame_no", "y")), _again(lines, values)], ["clip_id", "frame_no", "y", "planes"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The XOR of the lines of each (clip_id, y, segment) in a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values, at, _ = _lines(batch)
        first: dict[tuple, int] = {}
        for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("clip_id", "y", "segment")), strict=True)):
            if (j := first.setdefault(key, k)) != k:
                values[at[j] : at[j + 1]] ^= values[at[k] : at[k + 1]]
        part = batch.take(pa.array(sorted(first.values())))
        kept = np.concatenate([values[at[k] : at[k + 1]] for k in sorted(first.values())])
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("clip_id", "y", "segment")), _again(part.column("planes"), kept)], ["clip_id", "y", "segment", "planes"])


def _before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted sums, what all segments before each one come to."""
    key, segment, state = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values, at, lines = _lines(batch)
        out, keep = np.zeros_like(values), []
        for k, (clip, y, s) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("clip_id", "y", "segment")), strict=True)):
            own = values[at[k] : at[k + 1]]
            if (clip, y) != key:
                key, segment, state = (clip, y), None, np.zeros_like(own)
            if s != segment:
                out[at[k] : at[k + 1]] = state
                keep.append(k)
                segment = s
            state = state ^ own
        found = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("clip_id", "y", "segment")), _again(lines, out)], ["clip_id", "y", "segment", "planes"])
        yield found.take(pa.array(keep, pa.int64()))


def delta_decode(scanlines: DataFrame, *, key_every: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """The exact inverse: a running XOR of each line from its key frame on.

    A segment from one key frame to the next is a task's unit, and a line of it
    a row. Without key frames a segment has ``chunk`` numbers, and what all
    earlier ones come to is carried into it, a row for each segment and line:
    one long clip spreads over tasks.
    """
    kind = "clip_id string, frame_no long, y int, planes array<array<int>>"
    rows = scanlines.select("clip_id", "y", F.expr(f"frame_no div {key_every or chunk}").alias("segment"), "frame_no", F.col("planes").cast("array<array<int>>").alias("planes"))
    if not key_every:
        sums = "clip_id string, y int, segment long, planes array<array<int>>"
        before = rows.drop("frame_no").mapInArrow(_sums, sums).repartition("clip_id", "y").sortWithinPartitions("clip_id", "y", "segment").mapInArrow(_before, sums)
        rows = rows.unionByName(before.withColumn("frame_no", F.lit(None).cast("long")))
    rows = rows.repartition("clip_id", "y", "segment").sortWithinPartitions("clip_id", "y", "segment", F.col("frame_no").asc_nulls_first())
    return rows.mapInArrow(_running, kind).filter("frame_no is not null")


def rle_rows(scanlines: DataFrame, *, cap: int | None = CAP) -> DataFrame:
    """(clip_id, frame_no, y, runs): (n, v) runs of the first channel; a run
    of more than ``cap`` goes on in further runs of the same value."""
    rows = scanlines.select("clip_id", "frame_no", "y", F.col("planes")[0].alias("row")).filter(F.size("row") > 0)
    # Lambdas see their own arguments only: an outer array in a lambda would be computed again for each element.
    begins = "filter(zip_with(transform(row, (v, i) -> struct(i, v)), concat(array(cast(null as int)), row), (a, p) -> struct(a.i as i, a.v as v, a.i is not null and (p is null or p <> a.v) as b)), m -> m.b)"
    rows = rows.withColumn("s", F.expr(begins))
    rows = rows.withColumn("runs", F.expr("zip_with(s, concat(transform(slice(s, 2, size(s)), q -> q.i), array(size(row))), (a, e) -> struct(e - a.i as n, a.v as v))"))
    if cap:
        rows = rows.withColumn("runs", F.expr(f"flatten(transform(runs, r -> transform(sequence(0, (r.n - 1) div {cap}), k -> struct(cast(least({cap}L, r.n - {cap}L * k) as int) as n, r.v as v))))"))
    return rows.select("clip_id", "frame_no", "y", "runs")


def rle_frames(scanlines: DataFrame) -> DataFrame:
    """(clip_id, frame_no, runs): uncapped runs over a frame's lines in
    order."""
    frames = scanlines.groupBy("clip_id", "frame_no").agg(F.sort_array(F.collect_list(F.struct("y", F.col("planes")[0].alias("p")))).alias("f"))
    flat = frames.select("clip_id", "frame_no", F.lit(0).alias("y"), F.array(F.flatten(F.expr("transform(f, q -> q.p)"))).alias("planes"))
    return rle_rows(flat, cap=None).drop("y")


def rle_decode(runs: DataFrame) -> DataFrame:
    """Lines from runs; runs of length 0 are padding."""
    return runs.select("clip_id", "frame_no", "y", F.expr("array(flatten(transform(runs, r -> array_repeat(r.v, r.n))))").alias("planes"))


def rle_sizes(runs: DataFrame) -> DataFrame:
    """(clip_id, max_row_size): bytes of the longest coded line, two a run."""
    return runs.groupBy("clip_id").agg(F.max(2 * F.size("runs")).alias("max_row_size"))


def padded(runs: DataFrame) -> DataFrame:
    """(clip_id, frame_no, y, bytes): (count, value) byte pairs, zeros up to
    the clip's longest line."""
    code = F.expr("flatten(transform(runs, r -> array(r.n, r.v)))")
    rows = runs.join(rle_sizes(runs), "clip_id")
    return rows.select("clip_id", "frame_no", "y", F.concat(code, F.array_repeat(F.lit(0), F.col("max_row_size") - F.size(code))).alias("bytes"))


def delta_encode_clip(clip: Clip, *, key_every: int | None = None, check: bool = True) -> Clip:
    """A clip of deltas. ``check`` looks at all pixels first."""
    require(clip, "delta_encode", {"BW"})
    if check and clip.scanlines.transform(binary_violations).first().n_bad:
        raise ProcessingError("values other than 0 and 1", "delta_encode")
    return clip.but("delta_encode", {"key_every": key_every}, scanlines=delta_encode(clip.scanlines, key_every=key_every), stats=clip.stats | {"key_every": key_every})


def delta_decode_clip(clip: Clip) -> Clip:
    """The clip that delta_encode_clip was given."""
    require(clip, "delta_decode", {"BW"})
    key_every = clip.stats.get("key_every")
    return clip.but("delta_decode", {"key_every": key_every}, scanlines=delta_decode(clip.scanlines, key_every=key_every))
