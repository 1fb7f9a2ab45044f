"""Clips from arrays, raw files and decoders, and back.

A decoder turns a file into frames and an encoder turns frames into a file.
Both are plug-ins: none is built in, since video codecs are not part of Spark.
``read_video`` and ``read_files`` run a decoder on the executors on what Spark's
binary reader hands over, one file a row; ``encode_files`` runs an encoder on
runs of frames in order.
"""

from __future__ import annotations

import itertools
import json
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import planes
from ..schema import FRAMES, MODES, RANGES, SCANLINES, Clip, ProcessingError, Step

# The file names and codecs that are expected.
EXTENSIONS = (".mp4", ".avi", ".mov", ".mkv", ".webm", ".flv", ".wmv", ".m4v")
CODECS = ("h264", "h265", "hevc", "vp8", "vp9", "av1", "mpeg4", "xvid")
DEFAULT_FPS = 30.0


@dataclass(frozen=True)
class VideoInfo:
    """What a decoder says of a file; rates and codecs may be missing."""

    width: int
    height: int
    fps: float | None = None
    frame_count: int | None = None
    duration: float | None = None
    codec: str = "unknown"
    pixel_format: str = "unknown"


#: bytes of a file -> its metadata and an iterator of (height, width, channels) arrays.
Decoder = Callable[[bytes], tuple[VideoInfo, Iterable[np.ndarray]]]


def check_name(path: str) -> None:
    """Warns of a file name that is none of the known ones."""
    if not path.lower().strip().endswith(EXTENSIONS):
        warnings.warn(f"{path}: not a known kind of video file", stacklevel=2)


def check_info(info: VideoInfo) -> VideoInfo:
    """The metadata with a rate; ValueError if there is no picture."""
    if info.width <= 0 or info.height <= 0:
        raise ValueError(f"a picture of {info.width} x {info.height} pixels")
    if info.codec not in (*CODECS, "unknown"):
        warnings.warn(f"codec {info.codec} is not a known one", stacklevel=2)
    if not info.fps or info.fps <= 0:
        if info.fps is not None:
            warnings.warn(f"{DEFAULT_FPS} frames a second are assumed", stacklevel=2)
        info = VideoInfo(**{**info.__dict__, "fps": DEFAULT_FPS})
    return info


def estimated_frames(info: VideoInfo, max_frames: int | None = None) -> int:
    """The number of frames if it isn't known before decoding."""
    n = info.frame_count or (int(info.duration * (info.fps or DEFAULT_FPS)) if info.duration else 0) or 1000
    return min(n, max_frames) if max_frames is not None else n


def lines_of(frame: np.ndarray) -> list[list[list[int]]]:
    """planes of each line of a (height, width[, channels]) array."""
    frame = frame[..., None] if frame.ndim == 2 else frame
    return np.moveaxis(frame, 2, 1).tolist()


def from_array(spark: SparkSession, frames: np.ndarray, fps: float, color_mode: str, *, clip_id: str = "clip", resolution: tuple[int, int] | None = None) -> Clip:
    """A clip of a dense array: (frames, height, width[, channels])."""
    color_mode = color_mode.upper()
    if frames.ndim not in (3, 4):
        raise ProcessingError("frames must have 3 or 4 dimensions", "from_array")
    if color_mode == "RGB" and (frames.ndim != 4 or frames.shape[3] != 3):
        raise ProcessingError("RGB frames need 3 channels", "from_array")
    if color_mode in ("GRAY", "BW") and frames.ndim == 4:
        frames = frames[..., :1]
    n, height, width = frames.shape[:3]
    if resolution is not None and tuple(resolution) != (width, height):
        raise ProcessingError(f"the resolution {resolution} is not that of the frames, {(width, height)}", "from_array")
    rows = [(clip_id, k, y, planes) for k in range(n) for y, planes in enumerate(lines_of(frames[k]))]
    dtype = str(frames.dtype) if str(frames.dtype) in RANGES else "uint8"
    schema = SCANLINES if dtype.startswith("u") else "clip_id string, frame_no long, y int, planes array<array<double>>"
    return Clip(spark.createDataFrame(rows, schema), clip_id, float(fps), width, height, color_mode, n, dtype)


def to_array(clip: Clip) -> np.ndarray:
    """The dense array of a clip, for small ones: all frames come to the
    driver."""
    rows = clip.scanlines.select("frame_no", "y", "planes").orderBy("frame_no", "y").collect()
    if not rows:
        raise ValueError("there are no frames")
    data = np.array([r.planes for r in rows], dtype=clip.dtype)
    out = np.moveaxis(data.reshape(-1, clip.height, *data.shape[1:]), 2, 3)
    return out if clip.channels > 1 else out[..., 0]


def pack_frames(clip: Clip) -> DataFrame:
    """FRAMES: one row a frame, the picture as bytes in row-major order with
    interleaved channels (uint8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.moveaxis(frame, 1, 2).astype(np.uint8).tobytes() for _, frame in planes.frames_of(batch.column("lines"), "planes")]
            yield pa.RecordBatch.from_arrays([batch.column("clip_id"), batch.column("frame_no"), batch.column("ts"), pa.array(out, pa.binary())], FRAMES.names)

    lines = clip.scanlines.groupBy("clip_id", "frame_no").agg(F.collect_list(F.struct("y", "planes")).alias("lines"))
    return lines.select("clip_id", "frame_no", (F.col("frame_no") / clip.fps).alias("ts"), "lines").mapInArrow(run, FRAMES)


def unpack_frames(frames: DataFrame, width: int, height: int, channels: int) -> DataFrame:
    """SCANLINES from FRAMES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, body in enumerate(batch.column("pixels")):
                frame = np.frombuffer(body.as_buffer(), np.uint8).reshape(height, width, channels)
                own = batch.select(["clip_id", "frame_no"]).take(pa.array(np.full(height, k)))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.arange(height), pa.int32()), planes.lists_of(np.moveaxis(frame, 2, 1).astype(np.int32), pa.int32())], SCANLINES.names)

    return frames.select("clip_id", "frame_no", "pixels").mapInArrow(run, SCANLINES)


def write_clip(clip: Clip, path: str, *, layout: str = "scanlines") -> None:
    """The clip as Parquet, by frame number, with its metadata beside it."""
    if layout not in ("scanlines", "frames"):
        raise ValueError("layout is 'scanlines' or 'frames'")
    rows = clip.scanlines if layout == "scanlines" else pack_frames(clip)
    keys = ["frame_no", "y"] if layout == "scanlines" else ["frame_no"]
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{layout}")
    spark = clip.scanlines.sparkSession
    about = json.dumps({"source": clip.source, "stats": clip.stats, "history": [asdict(step) for step in clip.history]}, default=str)
    kind = "clip_id string, fps double, width int, height int, color_mode string, frame_count long, dtype string, layout string, about string"
    spark.createDataFrame([(clip.clip_id, clip.fps, clip.width, clip.height, clip.color_mode, clip.frame_count, clip.dtype, layout, about)], kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/clip")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or,
    where that is missing, a temporary one for a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="frameloom-shared-")
    return f"{root.rstrip('/')}/clip-{uuid.uuid4().hex}"


def read_clip(spark: SparkSession, path: str, *, max_frames: int | None = None) -> Clip:
    """What write_clip wrote, with its statistics and history, so that a coded
    clip can be decoded. ``max_frames`` reaches the Parquet scan."""
    meta = spark.read.parquet(f"{path}/clip").first()
    rows = spark.read.parquet(f"{path}/{meta.layout}")
    n = meta.frame_count
    if max_frames is not None:
        rows, n = rows.filter(F.col("frame_no") < max_frames), min(n, max_frames)
    if meta.layout == "frames":
        rows = unpack_frames(rows, meta.width, meta.height, MODES[meta.color_mode])
    about = json.loads(meta.about)
    history = tuple(Step(**step) for step in about["history"])
    return Clip(rows, meta.clip_id, meta.fps, meta.width, meta.height, meta.color_mode, n, meta.dtype, source=about["source"] | {"path": path}, stats=about["stats"], history=history)


def _as_mode(frame: np.ndarray, color_mode: str | None) -> np.ndarray:
    """A decoded (height, width[, channels]) picture in a color mode; None
    leaves it as it is."""
    if color_mode is None:
        return frame
    frame = frame[..., None] if frame.ndim == 2 else frame
    if color_mode == "RGB":
        return frame if frame.shape[2] == 3 else np.repeat(frame[..., :1], 3, axis=2)
    if frame.shape[2] < 3:
        return frame[..., :1]
    luma = 0.299 * frame[..., 0] + 0.587 * frame[..., 1] + 0.114 * frame[..., 2]
    return np.clip(luma, 0, 255).astype(np.uint8)[..., None]


def _checked_mode(color_mode: str) -> str:
    if color_mode.upper() not in ("RGB", "GRAY"):
        raise ValueError(f"color mode must be RGB or GRAY, not {color_mode!r}")
    return color_mode.upper()


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def file_infos(spark: SparkSession, path: str, decoder: Decoder) -> DataFrame:
    """What the decoder says of each file at ``path``, checked: path, width,
    height, fps, frame_count, duration, codec, pixel_format, and how many
    frames to expect. No frame is decoded if the decoder is lazy."""
    kind = "path string, width int, height int, fps double, frame_count long, duration double, codec string, pixel_format string, expected long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                check_name(name)
                info = check_info(decoder(body.as_py())[0])
                row = [name, info.width, info.height, float(info.fps), info.frame_count, info.duration, info.codec, info.pixel_format, estimated_frames(info)]
                types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], ["path", "width", "height", "fps", "frame_count", "duration", "codec", "pixel_format", "expected"])

    return _files(spark, path).mapInArrow(run, kind)


def read_files(spark: SparkSession, path: str, decoder: Decoder, *, color_mode: str | None = None, max_frames: int | None = None) -> DataFrame:
    """FRAMES of all files at ``path``; the path is the clip's id."""
    mode = color_mode and _checked_mode(color_mode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                check_name(name)
                info, frames = decoder(body.as_py())
                info, seen = check_info(info), 0
                for k, frame in enumerate(itertools.islice(frames, max_frames)):
                    seen += 1
                    pixels = np.ascontiguousarray(_as_mode(frame, mode), dtype=np.uint8).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([k / info.fps]), pa.array([pixels], pa.binary())], FRAMES.names)
                if not seen and max_frames != 0:
                    raise ProcessingError(f"{name}: no frames could be decoded", "read_files")

    return _files(spark, path).mapInArrow(run, FRAMES)


def read_video(spark: SparkSession, path: str, decoder: Decoder, *, color_mode: str = "RGB", max_frames: int | None = None, keep: str | None = None) -> Clip:
    """One file as a clip with its metadata. Frames are counted, for which the
    file is decoded; with ``keep``, a folder for Parquet, only this once."""
    mode = _checked_mode(color_mode)
    infos = file_infos(spark, path, decoder).limit(2).collect()
    if len(infos) != 1:
        raise ProcessingError(f"{path}: {'more than one file' if infos else 'no file'}", "read_video")
    info = infos[0]
    frames = read_files(spark, path, decoder, color_mode=mode, max_frames=max_frames)
    if keep:
        frames.write.mode("overwrite").parquet(keep)
        frames = spark.read.schema(FRAMES).parquet(keep)
    clip = Clip(unpack_frames(frames, info.width, info.height, MODES[mode]), info.path, info.fps, info.width, info.height, mode, frames.count())
    source = {"source_file": path, "original_duration": info.duration or 0.0, "codec": info.codec, "pixel_format": info.pixel_format}
    return clip.but("read_video", {"color_mode": mode, "max_frames": max_frames}, source=source)


#: Metadata and frames, (height, width, 3) each, to the bytes of a file.
Encoder = Callable[[VideoInfo, Iterable[np.ndarray]], bytes]


def encode_files(clip: Clip, encoder: Encoder, *, frames_per_file: int = 1 << 14, codec: str = "libx264", pixel_format: str = "yuv420p") -> DataFrame:
    """(clip_id, part, first_frame, n_frames, content): files of consecutive
    frames, made by the encoder on the executors. Gray and one-bit frames have
    three equal channels, one-bit ones as 0 and 255. A file is a task's work,
    so ``frames_per_file`` bounds it; frames reach the encoder one by one."""
    width, height, channels, fps, scale = clip.width, clip.height, clip.channels, clip.fps, 255 if clip.color_mode == "BW" else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("part", "clip_id", "frame_no", "pixels")), strict=True))
        for (part, name), own in itertools.groupby(rows, key=lambda r: r[:2]):
            first = next(own)
            seen = [0]

            def pictures(first=first, own=own, seen=seen) -> Iterator[np.ndarray]:
                for row in itertools.chain([first], own):
                    seen[0] += 1
                    picture = np.frombuffer(row[3], np.uint8).reshape(height, width, channels) * np.uint8(scale)
                    yield picture if channels == 3 else np.repeat(picture, 3, axis=2)

            content = encoder(VideoInfo(width, height, fps, None, None, codec, pixel_format), pictures())
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), pa.array([first[2]], pa.int64()), pa.array([seen[0]], pa.int64()), pa.array([content], pa.binary())], ["clip_id", "part", "first_frame", "n_frames", "content"])

    frames = pack_frames(clip).withColumn("part", F.expr(f"frame_no div {frames_per_file}"))
    frames = frames.repartition("clip_id", "part").sortWithinPartitions("part", "clip_id", "frame_no")
    return frames.mapInArrow(run, "clip_id string, part long, first_frame long, n_frames long, content binary")


class RawVideoSource(DataSource):
    """``spark.read.format("rawframes")``: files of plain frames without a
    header (options path, width, height, channels, fps, max_frames), read in
    ranges of frames. The path must be one that every executor sees."""

    @classmethod
    def name(cls) -> str:
        return "rawframes"

    def schema(self) -> str:
        return "clip_id string, frame_no long, ts double, pixels binary"

    def reader(self, schema) -> DataSourceReader:
        return RawVideoReader(self.options)


class FrameRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class RawVideoReader(DataSourceReader):
    #: Bytes of a partition, about.
    SPLIT = 32 << 20

    def __init__(self, options):
        self.path = options["path"]
        self.size = int(options["width"]) * int(options["height"]) * int(options.get("channels", "1"))
        self.fps = float(options.get("fps", str(DEFAULT_FPS)))
        self.max_frames = int(options["max_frames"]) if "max_frames" in options else None

    def _open(self):
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        return store, name

    def partitions(self) -> list[FrameRange]:
        store, name = self._open()
        n = store.get_file_info(name).size // self.size
        n = n if self.max_frames is None else min(n, self.max_frames)
        each = max(1, self.SPLIT // self.size)
        return [FrameRange(a, min(n, a + each)) for a in range(0, n, each)] or [FrameRange(0, 0)]

    def read(self, part: FrameRange) -> Iterator[tuple]:
        store, name = self._open()
        with store.open_input_file(name) as f:
            f.seek(part.first * self.size)
            for k in range(part.first, part.last):
                yield self.path, k, k / self.fps, f.read(self.size)
