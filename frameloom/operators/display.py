"""What a player would show, as tables: values for a screen, captions, the
frame rate that was reached, chosen frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import Clip

#: Gaps between frames that the displayed rate is the mean of.
RECENT = 30


def normalise(clip: Clip) -> DataFrame:
    """Color values from 0 to 1; gray and one-bit ones as they are, one
    channel."""
    planes = "transform(planes, p -> transform(p, v -> v / 255D))" if clip.color_mode == "RGB" else "transform(slice(planes, 1, 1), p -> transform(p, v -> cast(v as double)))"
    return clip.scanlines.select("clip_id", "frame_no", "y", F.expr(planes).alias("planes"))


def captions(clip: Clip, rates: DataFrame | None = None) -> DataFrame:
    """(frame_no, caption) of each frame, as ``Clip.info`` has it. ``rates``
    has the reached rate of frames, (frame_no, rate); other frames have none."""
    frames = clip.scanlines.filter("y = 0").select("frame_no")  # a line for each frame: no shuffle
    rate = F.lit("N/A")
    if rates is not None:
        frames = frames.join(rates.select("frame_no", "rate"), "frame_no", "left")
        rate = F.when(F.col("rate").isNotNull(), F.format_string("%.1f", "rate")).otherwise(rate)
    seconds = F.col("frame_no") / clip.fps if clip.fps > 0 else F.lit(0.0)
    last = f"\nLast Process: {clip.history[-1].component}" if clip.history else ""
    head = F.format_string(f"Frame: %d/{clip.frame_count}\nTime: %.2fs\nResolution: {clip.width}x{clip.height}\nVideo FPS: {clip.fps:.1f}\nDisplay FPS: ", F.col("frame_no") + 1, seconds)
    return frames.select("frame_no", F.concat(head, rate, F.lit(f"\nColor: {clip.color_mode}{last}")).alias("caption"))


def reached_rate(shown: DataFrame) -> DataFrame:
    """(clip_id, shown_us, rate) from (clip_id, shown_us, frame_no): frames a
    second over the last RECENT gaps, null while there is none."""
    order = Window.partitionBy("clip_id").orderBy("shown_us", "frame_no")
    gaps = shown.withColumn("gap", F.col("shown_us") - F.lag("shown_us").over(order))
    last = order.rowsBetween(1 - RECENT, 0)
    total = F.sum("gap").over(last)
    return gaps.select("clip_id", "shown_us", "frame_no", F.when(total > 0, F.count("gap").over(last) * 1e6 / total).alias("rate"))


def gather(scanlines: DataFrame, frame_numbers: DataFrame) -> DataFrame:
    """Chosen frames: (out_no, frame_no) pairs picked by an equi-join, so that
    any list of frames, repeated ones too, is possible. Adds ``out_no``."""
    return scanlines.join(frame_numbers.select("out_no", "frame_no"), "frame_no").select("clip_id", "frame_no", "y", "planes", "out_no")
