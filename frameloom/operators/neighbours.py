"""Each line beside the same line of the frame before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Frames of a chunk; a line's history is cut so that one clip spreads over tasks.
CHUNK = 256


def with_previous(scanlines: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Adds ``before``, the planes of the previous frame, and ``before_no``,
    its number (null for the first).

    A window over all frames of a line would have as many partitions as lines.
    Frames are cut into chunks instead, and the last frame that a chunk has of
    a line is sent to the next chunk that has any; numbers may have gaps.
    """
    own = F.expr(f"frame_no div {chunk}")
    rows = scanlines.withColumn("chunk", own).withColumn("halo", F.lit(False))
    line = Window.partitionBy("clip_id", "y").orderBy("chunk")
    last = rows.groupBy("clip_id", "y", "chunk").agg(F.max("frame_no").alias("frame_no"), F.max_by("planes", "frame_no").alias("planes"))
    last = last.withColumn("chunk", F.lead("chunk").over(line)).filter("chunk is not null").withColumn("halo", F.lit(True))
    both = Window.partitionBy("clip_id", "y", "chunk").orderBy("frame_no")
    rows = rows.unionByName(last, allowMissingColumns=True).withColumns({"before": F.lag("planes").over(both), "before_no": F.lag("frame_no").over(both)})
    return rows.filter("not halo").drop("chunk", "halo")
