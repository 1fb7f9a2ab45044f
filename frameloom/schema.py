"""Tables of a clip, its metadata and the checks on both.

``scanlines`` is the working table: one row for a line of a frame, with one
array of values for each channel, so that per-pixel and per-line operators need
no shuffle. ``pixels`` is its exploded form. Values are ints in memory; Spark has
no unsigned byte.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCANLINES = T.StructType(
    [
        T.StructField("clip_id", T.StringType(), False),
        T.StructField("frame_no", T.LongType(), False),
        T.StructField("y", T.IntegerType(), False),
        T.StructField("planes", T.ArrayType(T.ArrayType(T.IntegerType(), False), False), False),
    ]
)
PIXELS = T.StructType(
    [
        T.StructField("clip_id", T.StringType(), False),
        T.StructField("frame_no", T.LongType(), False),
        T.StructField("y", T.IntegerType(), False),
        T.StructField("x", T.IntegerType(), False),
        T.StructField("c", T.IntegerType(), False),
        T.StructField("v", T.IntegerType(), False),
    ]
)
FRAMES = T.StructType(
    [
        T.StructField("clip_id", T.StringType(), False),
        T.StructField("frame_no", T.LongType(), False),
        T.StructField("ts", T.DoubleType(), False),
        T.StructField("pixels", T.BinaryType(), False),
    ]
)
MODES = {"RGB": 3, "GRAY": 1, "BW": 1}
#: The least and greatest value of each kind of image; floats are not clamped.
RANGES = {"uint8": (0, 255), "uint16": (0, 65535), "float32": None, "float64": None}


class ProcessingError(Exception):
    """A stage can't work on what it was given."""

    def __init__(self, message: str, component: str = "", details: dict | None = None):
        super().__init__(f"[{component}] {message}" if component else message)
        self.component, self.details = component, details or {}


@dataclass(frozen=True)
class Step:
    """What a stage did; histories only grow by copies."""

    component: str
    parameters: dict
    timestamp: str = field(default_factory=lambda: datetime.datetime.now().isoformat(timespec="seconds"))


@dataclass(frozen=True)
class Clip:
    """A clip: metadata on the driver, scanlines in the cluster."""

    scanlines: DataFrame
    clip_id: str
    fps: float
    width: int
    height: int
    color_mode: str
    frame_count: int
    dtype: str = "uint8"
    source: dict = field(default_factory=dict)
    stats: dict = field(default_factory=dict)
    history: tuple[Step, ...] = ()

    def __post_init__(self):
        if self.color_mode not in MODES:
            raise ProcessingError(f"color mode must be one of {sorted(MODES)}, not {self.color_mode!r}", "Clip")
        if self.width <= 0 or self.height <= 0:
            raise ProcessingError("width and height must be positive", "Clip")
        if self.frame_count < 0:
            raise ProcessingError("a clip can't have fewer than 0 frames", "Clip")
        if self.dtype not in RANGES:
            raise ProcessingError(f"values of type {self.dtype} are not known", "Clip")

    @property
    def resolution(self) -> tuple[int, int]:
        return self.width, self.height

    @property
    def channels(self) -> int:
        return MODES[self.color_mode]

    def but(self, component: str, parameters: dict, **changes) -> Clip:
        """The clip after a stage."""
        return replace(self, **changes, history=(*self.history, Step(component, parameters)))

    def memory(self) -> dict:
        """What the frames take as dense bytes: an estimate for sizing
        partitions, not a limit."""
        frame = self.width * self.height * self.channels * {"uint8": 1, "uint16": 2, "float32": 4, "float64": 8}[self.dtype]
        return {"frame_size_bytes": frame, "total_bytes": frame * self.frame_count, "total_mb": frame * self.frame_count / 2**20, "frame_count": self.frame_count}

    def batch_size(self, wanted: int | None = None, *, single_mb: float = 2048, batch_mb: float = 1024) -> int:
        """Frames that fit in a batch: all below ``single_mb``, else what
        ``batch_mb`` holds, and no more than wanted."""
        need = self.memory()
        if need["total_mb"] <= single_mb:
            return self.frame_count
        safe = max(1, min(self.frame_count, int(batch_mb * 2**20 / need["frame_size_bytes"])))
        return min(wanted, safe) if wanted else safe

    @property
    def duration(self) -> float:
        """Seconds, by frames and rate; 0 without a rate."""
        return self.frame_count / self.fps if self.fps > 0 else 0.0

    def info(self, frame_no: int, shown_fps: float | None = None) -> str:
        """The caption of a frame, in lines; ``shown_fps`` is the rate that a
        player reached."""
        facts = {
            "Frame": f"{frame_no + 1}/{self.frame_count}",
            "Time": f"{frame_no / self.fps if self.fps > 0 else 0:.2f}s",
            "Resolution": f"{self.width}x{self.height}",
            "Video FPS": f"{self.fps:.1f}",
            "Display FPS": "N/A" if shown_fps is None else f"{shown_fps:.1f}",
            "Color": self.color_mode,
        }
        if self.history:
            facts["Last Process"] = self.history[-1].component
        return "\n".join(f"{name}: {value}" for name, value in facts.items())


def require(clip: Clip, component: str, modes: set[str] | None = None) -> None:
    """The checks that need metadata only."""
    if clip.frame_count == 0:
        raise ProcessingError("the clip has no frames", component)
    if modes and clip.color_mode not in modes:
        raise ProcessingError(f"color mode {clip.color_mode} is not supported; use one of {sorted(modes)}", component)


def to_pixels(scanlines: DataFrame) -> DataFrame:
    """PIXELS from SCANLINES."""
    rows = scanlines.select("clip_id", "frame_no", "y", F.posexplode("planes").alias("c", "plane"))
    return rows.select("clip_id", "frame_no", "y", "c", F.posexplode("plane").alias("x", "v")).select(*PIXELS.names)


def to_scanlines(pixels: DataFrame) -> DataFrame:
    """SCANLINES from PIXELS: gathers each line, which must be whole."""
    line = pixels.groupBy("clip_id", "frame_no", "y").agg(F.sort_array(F.collect_list(F.struct("c", "x", "v"))).alias("p"))
    planes = "transform(sequence(0, array_max(transform(p, q -> q.c))), k -> transform(filter(p, q -> q.c = k), q -> q.v))"
    return line.select("clip_id", "frame_no", "y", F.expr(planes).alias("planes"))


def binary_violations(scanlines: DataFrame) -> DataFrame:
    """n_values and n_bad (neither 0 nor 1): one row, for checks of BW data."""
    flat = scanlines.select(F.flatten("planes").alias("v"))
    return flat.agg(F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("n_values"), F.coalesce(F.sum(F.expr("size(filter(v, q -> q not in (0, 1)))")), F.lit(0)).alias("n_bad"))
