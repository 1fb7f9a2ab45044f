"""Command line: python -m frameloom -i CLIP -o OUT [options]. CLIP is what
``write_clip`` wrote, or raw frames with --raw WxHxC."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession

from ..functions import pixel
from ..operators import delta
from ..schema import Clip
from ..sources import frames
from . import chain


def resolution(text: str) -> tuple[int, int]:
    """120x75"""
    if not (m := re.fullmatch(r"(\d+)x(\d+)", text.strip().lower())) or not int(m[1]) or not int(m[2]):
        raise argparse.ArgumentTypeError(f"{text!r} is not WIDTHxHEIGHT")
    return int(m[1]), int(m[2])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="frameloom", description=__doc__)
    p.add_argument("--input", "-i", required=True)
    p.add_argument("--raw", help="the input is raw frames of WIDTHxHEIGHTxCHANNELS")
    p.add_argument("--source-fps", type=float, default=frames.DEFAULT_FPS, help="of raw frames")
    p.add_argument("--max-frames", type=int)
    p.add_argument("--resolution", "-r", type=resolution)
    p.add_argument("--threshold", "-t", type=int, default=60)
    p.add_argument("--lanczos", "-lc", type=int, default=4)
    p.add_argument("--dither", "--dt", action="store_true", help="ordered dithering, unless another method is named")
    p.add_argument("--workers", "-w", type=int, help="threads of a local master, where no session exists")
    p.add_argument("--execution-mode", "-e", choices=("threading", "multiprocessing"), help="accepted; Spark schedules the tasks")
    p.add_argument("--batch-size", "-b", type=int, help="rows of an Arrow batch, at most")
    p.add_argument("--cuda", "-c", help="not available")
    p.add_argument("--interactive", "-it", action="store_true", help="not available")
    p.add_argument("--target-fps", "-f", type=float)
    p.add_argument("--reframe-technique", choices=("simple", "intelligent"), default="intelligent")
    p.add_argument("--dither-method", type=lambda x: x.replace("-", "_"), choices=("none", "ordered", "floyd_steinberg"), default="none")
    p.add_argument("--dither-pattern", choices=sorted(pixel.BAYER), default="bayer4x4")
    p.add_argument("--delta", action="store_true")
    p.add_argument("--key-every", type=int)
    p.add_argument("--rle", "--run-length", action="store_true", help="write coded lines; implies --delta")
    p.add_argument("--mc", action="store_true", help="motion compensation; not available")
    p.add_argument("--scanline", action="store_true")
    p.add_argument("--interlaced", action="store_true")
    p.add_argument("--output-format", choices=("scanlines", "frames"), default="scanlines")
    p.add_argument("--output-path", "-o", required=True)
    return p


def plan(a: argparse.Namespace, fps: float) -> chain.Chain:
    """The stages that the options ask for, in the usual order."""
    rules = [
        (a.interlaced and (a.rle or a.delta or a.mc), "--interlaced excludes --rle, --delta and --mc"),
        (a.scanline and a.interlaced, "--scanline and --interlaced exclude each other"),
        (a.scanline and a.mc, "--scanline excludes --mc"),
        (a.mc, "--mc: there is no motion compensation"),
        (a.cuda is not None, "--cuda: frames are computed by Spark's executors"),
        (a.interactive, "--interactive: there is no player"),
        (a.lanczos < 2, "--lanczos needs 2 or more"),
        (a.target_fps is not None and a.target_fps <= 0, "--target-fps must be positive"),
        (a.target_fps is not None and a.target_fps > fps, f"--target-fps must not be above the source's {fps}"),
        (not 0 <= a.threshold <= 255, "--threshold must be within 0 and 255"),
        (any(x is not None and x < 1 for x in (a.workers, a.batch_size, a.key_every)), "--workers, --batch-size and --key-every must be positive"),
    ]
    for broken, rule in rules:
        if broken:
            raise SystemExit(rule)
    c = chain.Chain()
    if a.resolution:
        c = c.then(chain.resizing(*a.resolution, kernel_size=a.lanczos))
    if a.target_fps and a.target_fps < fps:
        c = c.then(chain.reframing(a.target_fps, a.reframe_technique))
    method = "ordered" if a.dither and a.dither_method == "none" else a.dither_method
    c = c.then(chain.one_bit(a.threshold, method, a.dither_pattern))
    if a.scanline:
        c = c.then(chain.scanlines())
    if a.interlaced:
        c = c.then(chain.interlacing())
    return c.then(chain.delta_coding(a.key_every)) if a.delta or a.rle else c


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> Clip:
    a = parser().parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName("frameloom")
        spark = (builder.master(f"local[{a.workers}]") if a.workers else builder).getOrCreate()
    if a.batch_size:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(a.batch_size))
    if a.raw:
        width, height, channels = map(int, a.raw.lower().split("x"))
        spark.dataSource.register(frames.RawVideoSource)
        options = {"width": width, "height": height, "channels": channels, "fps": a.source_fps} | ({"max_frames": a.max_frames} if a.max_frames is not None else {})
        rows = spark.read.format("rawframes").options(**options).load(a.input)
        clip = Clip(frames.unpack_frames(rows, width, height, channels), a.input, a.source_fps, width, height, "RGB" if channels == 3 else "GRAY", rows.count(), source={"path": a.input})
    else:
        clip = frames.read_clip(spark, a.input, max_frames=a.max_frames)
    done = plan(a, clip.fps).run(clip)
    if a.rle:
        delta.padded(delta.rle_rows(done.scanlines)).write.mode("overwrite").parquet(f"{a.output_path}/rle")
    frames.write_clip(done, a.output_path, layout=a.output_format)
    for step in done.history:
        print(step.component, step.parameters)
    return done
