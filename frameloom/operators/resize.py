"""Separable Lanczos resampling in space."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lanczos, pixel, planes
from ..schema import Clip, ProcessingError, require


def horizontal(scanlines: DataFrame, width: int, target: int) -> DataFrame:
    """Lines of ``target`` floats: no shuffle, a line is the unit."""
    at, w = lanczos.taps(width, target)
    return scanlines.withColumns({"at": at, "w": w}).select("clip_id", "frame_no", "y", F.expr(f"transform(planes, p -> {lanczos.convolve('p[{i}]', target)})").alias("planes"))


def vertical(scanlines: DataFrame, height: int, target: int) -> DataFrame:
    """Frames of ``target`` lines of floats. A frame's lines are gathered
    once, after the horizontal pass has changed their width, and only finished
    lines are exploded."""
    at, w = lanczos.taps(height, target)
    frames = scanlines.groupBy("clip_id", "frame_no").agg(F.sort_array(F.collect_list(F.struct("y", "planes"))).alias("f"))
    # As a generator's output the frame is a column: lambdas would compute an expression again for each element.
    frames = frames.select("clip_id", "frame_no", F.explode(F.array("f")).alias("f")).withColumns({"at": at, "w": w})
    sums = lanczos.convolve("f[{i}].planes[c][x]", target)
    # For each channel and place the sums of all lines, turned into lines.
    down = f"transform(sequence(0, size(f[0].planes) - 1), c -> transform(sequence(0, size(f[0].planes[0]) - 1), x -> {sums}))"
    frames = frames.select("clip_id", "frame_no", F.explode(F.array(F.expr(down))).alias("d"))
    lines = f"transform(sequence(0, {target - 1}), o -> transform(d, plane -> transform(plane, column -> column[o])))"
    return frames.select("clip_id", "frame_no", F.posexplode(F.expr(lines)).alias("y", "planes"))


def restore(scanlines: DataFrame, dtype: str = "uint8") -> DataFrame:
    """Floats back to the values of an image: clamped and cut."""
    return scanlines.select("clip_id", "frame_no", "y", F.expr(f"transform(planes, p -> transform(p, v -> {pixel.clamp('v', dtype)}))").alias("planes"))


def lanczos_resize(scanlines: DataFrame, size: tuple[int, int], target: tuple[int, int], dtype: str = "uint8") -> DataFrame:
    """Both passes and the image's own values again."""
    lines = horizontal(scanlines, size[0], target[0])
    return restore(vertical(lines, size[1], target[1]), dtype)


def _resized(size: tuple[int, int], target: tuple[int, int], dtype: str):
    most = {"uint8": 255, "uint16": 65535}.get(dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.select(["clip_id", "frame_no"])
            kind = pa.int32() if most else pa.float64()
            for k, (_, image) in enumerate(planes.frames_of(batch.column("lines"), "planes")):
                out = np.stack([lanczos.resize_array(image[:, c], *target) for c in range(image.shape[1])], axis=1)
                out = np.clip(out, 0, most).astype(np.int32) if most else out.astype(np.float64)
                own = keys.take(pa.array(np.full(len(out), k)))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.arange(len(out)), pa.int32()), planes.lists_of(out, kind)], ["clip_id", "frame_no", "y", "planes"])

    return run


def lanczos_resize_arrow(scanlines: DataFrame, size: tuple[int, int], target: tuple[int, int], dtype: str = "uint8") -> DataFrame:
    """The same on whole frames with NumPy: faster for large frames, where the
    interpreted lambdas of the native form dominate."""
    frames = scanlines.groupBy("clip_id", "frame_no").agg(F.collect_list(F.struct("y", "planes")).alias("lines"))
    value = "int" if dtype in ("uint8", "uint16") else "double"
    return frames.mapInArrow(_resized(size, target, dtype), f"clip_id string, frame_no long, y int, planes array<array<{value}>>")


#: Scanlines, (width, height), the target and the type of values, to scanlines.
Resizer = Callable[[DataFrame, tuple[int, int], tuple[int, int], str], DataFrame]


def resize(clip: Clip, target: tuple[int, int], *, kernel_size: int = 4, arrow: bool | None = None, using: Resizer | None = None) -> Clip:
    """A clip of the target (width, height); the same clip if it has it.

    ``arrow`` picks NumPy over native expressions; by default it does so from
    a quarter of a megapixel on. ``using`` resizes by another function.
    """
    width, height = target
    if kernel_size < 2:
        raise ProcessingError("the kernel needs 2 lobes at least", "resize")
    if width <= 0 or height <= 0:
        raise ProcessingError("the target resolution must be positive", "resize")
    if (width, height) == clip.resolution:
        return clip
    require(clip, "resize", {"RGB", "GRAY"})
    if kernel_size != 4 and not using:
        raise NotImplementedError("only 4 lobes are supported")
    arrow = clip.width * clip.height >= 1 << 18 if arrow is None else arrow
    lines = (using or (lanczos_resize_arrow if arrow else lanczos_resize))(clip.scanlines, clip.resolution, (width, height), clip.dtype)
    return clip.but("resize", {"target_resolution": f"{width}x{height}", "lanczos_kernel": kernel_size}, scanlines=lines, width=width, height=height)
