"""Resampling in time: fewer frames by ratio or by score."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Clip, ProcessingError, require
from .neighbours import with_previous


def _slot(r: float, reach: str) -> str:
    """SQL for the greatest slot w near frame_no / r with int(w * r) <= frame_no;
    products are doubles and cut, as the selection itself is defined."""
    guess = f"cast(frame_no / {r!r}D as bigint)"
    return f"array_max(filter(sequence({guess} - 1, {guess} + 2), w -> w >= 0 and cast(w * {r!r}D as bigint) <= {reach}))"


def simple(scanlines: DataFrame, frame_count: int, source: float, target: float) -> DataFrame:
    """Frames int(i * source / target) for i below int(frame_count / ratio):
    a filter, without any join. Adds ``out_no``."""
    if target >= source:
        return scanlines.withColumn("out_no", F.col("frame_no"))
    r = source / target
    n = int(frame_count / r)
    rows = scanlines.withColumn("out_no", F.expr(_slot(r, "frame_no")))
    return rows.filter(F.expr(f"out_no < {n} and least(cast(out_no * {r!r}D as bigint), {frame_count - 1}L) = frame_no"))


def frame_variance(scanlines: DataFrame) -> DataFrame:
    """(clip_id, frame_no, variance) over all pixels and channels, from exact
    integer sums."""
    flat = F.flatten("planes")
    rows = scanlines.select("clip_id", "frame_no", F.size(flat).cast("long").alias("n"), F.aggregate(flat, F.lit(0).cast("long"), lambda s, v: s + v).alias("s"), F.aggregate(flat, F.lit(0).cast("long"), lambda s, v: s + v.cast("long") * v).alias("q"))
    sums = rows.groupBy("clip_id", "frame_no").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    return sums.select("clip_id", "frame_no", ((F.col("n") * F.col("q") - F.col("s") * F.col("s")) / (F.col("n") * F.col("n"))).alias("variance"))


def frame_difference(scanlines: DataFrame) -> DataFrame:
    """(clip_id, frame_no, difference): mean absolute change from the frame
    before, 0 for the first, infinite where the lines' shapes differ."""
    return frame_metrics(scanlines).select("clip_id", "frame_no", "difference")


def frame_metrics(scanlines: DataFrame) -> DataFrame:
    """(clip_id, frame_no, variance, difference), both in one pass; columns
    that nobody reads are pruned."""
    rows = with_previous(scanlines).select("clip_id", "frame_no", F.flatten("planes").alias("p"), F.flatten("before").alias("b"), (F.transform("planes", F.size) != F.transform("before", F.size)).alias("odd"))
    total = lambda x, y: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + y(v))
    change = F.when(F.col("b").isNull(), F.lit(0).cast("long")).otherwise(total(F.zip_with("p", "b", lambda x, y: F.abs(x - y)), lambda v: v))
    rows = rows.select("clip_id", "frame_no", F.size("p").cast("long").alias("n"), total(F.col("p"), lambda v: v).alias("s"), total(F.col("p"), lambda v: v.cast("long") * v).alias("q"), change.alias("d"), "odd")
    sums = rows.groupBy("clip_id", "frame_no").agg(*(F.sum(c).alias(c) for c in "nsqd"), F.coalesce(F.max("odd"), F.lit(False)).alias("odd"))
    variance = (F.col("n") * F.col("q") - F.col("s") * F.col("s")) / (F.col("n") * F.col("n"))
    return sums.select("clip_id", "frame_no", variance.alias("variance"), F.when(F.col("odd"), F.lit(float("inf"))).otherwise(F.col("d") / F.col("n")).alias("difference"))


def frame_scores(scanlines: DataFrame, variance_weight: float = 0.7, difference_weight: float = 0.3) -> DataFrame:
    """(clip_id, frame_no, variance, difference, score): both metrics over
    their clip's maximum, weighted. The maxima are one row a clip."""
    both = frame_metrics(scanlines)
    most = both.groupBy("clip_id").agg(F.max("variance").alias("mv"), F.max("difference").alias("md"))
    over = lambda x, m: F.col(x) / F.when(F.col(m) > 0, F.col(m)).otherwise(1.0)
    score = variance_weight * over("variance", "mv") + difference_weight * over("difference", "md")
    return both.join(most, "clip_id").select("clip_id", "frame_no", "variance", "difference", score.alias("score"))


def best_frames(scores: DataFrame, frame_count: int, source: float, target: float) -> DataFrame:
    """(clip_id, out_no, frame_no): the best of each window, ties to the
    earlier frame; frames after the last whole window are left out."""
    r = source / target
    n = int(frame_count / r)
    rows = scores.withColumn("out_no", F.expr(_slot(r, "frame_no"))).filter(f"out_no < {n}")
    best = F.max_by("frame_no", F.struct("score", -F.col("frame_no")))
    return rows.groupBy("clip_id", "out_no").agg(best.alias("frame_no"))


def intelligent(scanlines: DataFrame, frame_count: int, source: float, target: float, *, variance_weight: float = 0.7, difference_weight: float = 0.3) -> DataFrame:
    """The best-scored frame of each window. Adds ``out_no``."""
    if target >= source:
        return scanlines.withColumn("out_no", F.col("frame_no"))
    chosen = best_frames(frame_scores(scanlines, variance_weight, difference_weight), frame_count, source, target)
    return scanlines.join(chosen, ["clip_id", "frame_no"])


def stats(frame_count: int, kept: int, source: float, target: float, technique: str) -> dict:
    ratio = kept / frame_count if frame_count else 0.0
    return {"original_frame_count": frame_count, "output_frame_count": kept, "compression_ratio": ratio, "source_fps": source, "target_fps": target, "technique": technique, "frame_drop_percentage": (1 - ratio) * 100 if frame_count else 0.0}


TECHNIQUES: dict[str, Callable[..., DataFrame]] = {"simple": simple, "intelligent": intelligent}


def reframe(clip: Clip, fps: float, technique: str | Callable[..., DataFrame] = "intelligent", *, variance_weight: float = 0.7, difference_weight: float = 0.3) -> Clip:
    """A clip at a lower rate; the same clip if it has that rate. A technique
    may be a function of (scanlines, frame_count, source, target) that adds
    ``out_no``, 0 to int(frame_count * target / source) - 1."""
    require(clip, "reframe")
    if fps <= 0 or clip.fps <= 0:
        raise ProcessingError("frame rates must be positive", "reframe")
    if fps - clip.fps >= 0.01:
        raise ProcessingError(f"the target rate {fps} is above the source's {clip.fps}", "reframe")
    if not (0 <= variance_weight <= 1 and 0 <= difference_weight <= 1):
        raise ProcessingError("weights must be within 0 and 1", "reframe")
    if abs(variance_weight + difference_weight - 1) > 0.01:
        warnings.warn("the weights don't sum to 1", stacklevel=2)
    if abs(fps - clip.fps) < 0.01:
        return clip
    name = technique if isinstance(technique, str) else getattr(technique, "__name__", "custom")
    if isinstance(technique, str) and technique not in TECHNIQUES:
        raise ProcessingError(f"unknown technique {technique!r}", "reframe")
    run = TECHNIQUES[technique] if isinstance(technique, str) else technique
    own = {"variance_weight": variance_weight, "difference_weight": difference_weight} if name == "intelligent" else {}
    lines = run(clip.scanlines, clip.frame_count, clip.fps, fps, **own)
    kept = int(clip.frame_count / (clip.fps / fps))
    found = stats(clip.frame_count, kept, clip.fps, fps, name)
    lines = lines.select("clip_id", F.col("out_no").cast("long").alias("frame_no"), "y", "planes")
    return clip.but("reframe", found | own, scanlines=lines, fps=float(fps), frame_count=kept, stats=clip.stats | {"reframe": found | own})
