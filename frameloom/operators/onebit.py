"""Grayscale and one-bit conversion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixel, planes
from ..schema import Clip, ProcessingError, require

METHODS = ("none", "ordered", "floyd_steinberg")


def _planes(expression: str):
    return F.expr(expression).alias("planes")


def to_gray(scanlines: DataFrame) -> DataFrame:
    """One channel: the luma of three, or the one that is there."""
    # Lambdas see their own arguments only: an outer array in a lambda would be computed again for each element.
    luma = f"zip_with(zip_with(planes[0], planes[1], (r, g) -> struct(r as r, g as g)), planes[2], (q, b) -> {pixel.gray('q.r', 'q.g', 'b')})"
    return scanlines.select("clip_id", "frame_no", "y", _planes(f"if(size(planes) = 3, array({luma}), slice(planes, 1, 1))"))


def replicate(scanlines: DataFrame, channels: int = 3) -> DataFrame:
    """Each line's first channel, so many times."""
    return scanlines.select("clip_id", "frame_no", "y", _planes(f"array_repeat(planes[0], {channels})"))


def channel(scanlines: DataFrame, c: int = 0) -> DataFrame:
    """One of the channels."""
    return scanlines.select("clip_id", "frame_no", "y", _planes(f"array(planes[{c}])"))


def threshold(scanlines: DataFrame, t: float) -> DataFrame:
    """1 where a value is over the threshold, else 0."""
    return scanlines.select("clip_id", "frame_no", "y", _planes(f"transform(planes, p -> transform(p, v -> {pixel.over('v', t)}))"))


def ordered_dither(scanlines: DataFrame, t: float, pattern: str = "bayer4x4") -> DataFrame:
    """Threshold moved by a matrix that tiles the frame."""
    return scanlines.select("clip_id", "frame_no", "y", _planes(f"transform(planes, p -> transform(p, (v, x) -> {pixel.dithered('v', 'x', 'y', t, pattern)}))"))


#: The modulus of the noise, a prime: squares of what is below it fit in 64 bits.
NOISE_PRIME = 2**31 - 1


def noise_dither(scanlines: DataFrame, t: float, seed: int = 0, spread: int = 16) -> DataFrame:
    """Threshold after uniform noise that a hash of place and seed gives, so
    that a rerun gives the same bits: an MD5 for each line, then squares modulo
    a prime for each pixel."""
    line = f"cast(conv(substring(md5(concat_ws(':', {seed}, clip_id, frame_no, y)), 1, 7), 16, 10) as long)"
    step = lambda h, add: f"(({h}) * ({h}) + {add}) % {NOISE_PRIME}L"
    # As a generator's output the line's hash is a column, computed once.
    lines = scanlines.select("*", F.explode(F.array(F.expr(line))).alias("l"))
    lines = lines.withColumn("h", F.expr(f"transform(sequence(0, size(planes[0]) - 1), x -> (l * 8L + x * 40503L) % {NOISE_PRIME}L)"))
    for add in (12345, 777):
        lines = lines.withColumn("h", F.expr(f"transform(h, q -> {step('q', add)})"))
    value = f"least(255D, greatest(0D, v + (q / {NOISE_PRIME}D - 0.5D) * {2 * spread}))"
    return lines.select("clip_id", "frame_no", "y", _planes(f"transform(planes, p -> zip_with(p, h, (v, q) -> {pixel.over(value, float(t))}))"))


def diffuse(frames: np.ndarray, t: float) -> np.ndarray:
    """Floyd-Steinberg over (frames, height, width). Errors are computed in
    double precision and kept in float32; what falls outside is lost.

    A pixel waits for its left neighbour and three above, so all with the same
    x + 2 * y can go at once, in all frames. Two of them reach the same pixel
    in one step: the one above comes first, as in a pass line by line.
    """
    n, height, width = frames.shape
    work = np.zeros((height + 1, width + 2, n), dtype=np.float32)
    work[:height, 1:-1] = np.moveaxis(frames, 0, -1)
    out = np.zeros((height, width, n), dtype=np.int32)
    for step in range(width + 2 * (height - 1)):
        y = np.arange(max(0, (step - width + 2) // 2), min(height - 1, step // 2) + 1)
        x = step - 2 * y + 1
        old = work[y, x].astype(np.float64)
        new = np.where(old > t, 255.0, 0.0)
        out[y, x - 1] = new > 0
        error = old - new
        for down, along, share in ((1, -1, 3), (1, 0, 5), (1, 1, 1), (0, 1, 7)):
            work[y + down, x + along] = (work[y + down, x + along] + error * share / 16).astype(np.float32)
    return np.moveaxis(out, -1, 0)


#: Pixels that are diffused at a time, about; bounds a worker's memory.
TOGETHER = 1 << 22


def _diffused(t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = planes.frames_of(batch.column("lines"), "p")
            shapes: dict[tuple[int, int], list[int]] = {}
            for k, (_, frame) in enumerate(found):
                shapes.setdefault(frame.shape, []).append(k)
            for (height, width), rows in shapes.items():
                most = max(1, TOGETHER // max(1, height * width))
                for some in (rows[a : a + most] for a in range(0, len(rows), most)):
                    bits = diffuse(np.stack([found[k][1] for k in some]), t)
                    own = batch.select(["clip_id", "frame_no"]).take(pa.array(np.repeat(some, height)))
                    y = np.concatenate([found[k][0] for k in some])
                    yield pa.RecordBatch.from_arrays([own.column("clip_id"), own.column("frame_no"), pa.array(y, pa.int32()), planes.lists_of(bits.reshape(-1, 1, width), pa.int32())], ["clip_id", "frame_no", "y", "planes"])

    return run


def floyd_steinberg(scanlines: DataFrame, t: float) -> DataFrame:
    """Error diffusion of one-channel lines. A frame is the unit: its lines
    are gathered once."""
    frames = scanlines.groupBy("clip_id", "frame_no").agg(F.collect_list(F.struct("y", F.col("planes")[0].alias("p"))).alias("lines"))
    return frames.mapInArrow(_diffused(t), "clip_id string, frame_no long, y int, planes array<array<int>>")


def convert(scanlines: DataFrame, t: float = 128, method: str = "none", pattern: str = "bayer4x4") -> DataFrame:
    """Gray, then one of the methods."""
    if method not in METHODS:
        raise ValueError(f"unknown dither method {method!r}; use one of {METHODS}")
    gray = to_gray(scanlines)
    if method == "ordered":
        return ordered_dither(gray, t, pattern)
    return floyd_steinberg(gray, t) if method == "floyd_steinberg" else threshold(gray, t)


def pixel_stats(scanlines: DataFrame) -> DataFrame:
    """total_pixels, white_pixels, black_pixels, white_percentage of BW lines."""
    counts = scanlines.agg(F.coalesce(F.sum(F.size(F.flatten("planes"))), F.lit(0)).alias("total_pixels"), F.coalesce(F.sum(F.expr("aggregate(flatten(planes), 0L, (s, v) -> s + v)")), F.lit(0)).alias("white_pixels"))
    share = F.when(F.col("total_pixels") > 0, F.col("white_pixels") * 100.0 / F.col("total_pixels")).otherwise(0.0)
    return counts.withColumns({"black_pixels": F.col("total_pixels") - F.col("white_pixels"), "white_percentage": share})


def to_1bit(clip: Clip, t: int = 128, method: str = "none", pattern: str = "bayer4x4", *, stats: bool = False) -> Clip:
    """A BW clip. Statistics cost a pass over the pixels and are off unless
    asked for."""
    require(clip, "to_1bit", {"RGB", "GRAY"})
    if not 0 <= t <= 255:
        raise ProcessingError("the threshold must be within 0 and 255", "to_1bit")
    if pattern not in pixel.BAYER:
        raise ProcessingError(f"unknown dither pattern {pattern!r}", "to_1bit")
    lines = convert(clip.scanlines, t, method, pattern)
    found = pixel_stats(lines).first().asDict() if stats else {}
    return clip.but("to_1bit", {"threshold": t, "dither_method": method, "dither_pattern": pattern} | found, scanlines=lines, color_mode="BW", dtype="uint8")
