"""Extensions: scanline and interlaced output. Even lines are the ones that
show first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neighbours import with_previous


def scanline_mode(scanlines: DataFrame) -> DataFrame:
    """Odd lines are black."""
    return scanlines.select("clip_id", "frame_no", "y", F.expr("if(y % 2 = 0, planes, transform(planes, p -> transform(p, v -> 0)))").alias("planes"))


def interlaced_mode(scanlines: DataFrame) -> DataFrame:
    """A frame updates the lines of its own parity; the others show the frame
    before. The first frame is whole."""
    own = (F.col("y") + F.col("frame_no")) % 2 == 0
    return with_previous(scanlines).select("clip_id", "frame_no", "y", F.when(own | F.col("before").isNull(), F.col("planes")).otherwise(F.col("before")).alias("planes"))
