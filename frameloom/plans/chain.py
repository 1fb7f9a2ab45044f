"""Stages that follow each other, as functions from clip to clip."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import delta, modes, onebit, reframe, resize
from ..schema import Clip, ProcessingError
from .log import log

@dataclass(frozen=True)
class Stage:
    """A named function of a clip. ``per_frame``: a frame's result depends on
    that frame only, so frames may be dropped before it."""

    name: str
    run: Callable[[Clip], Clip]
    per_frame: bool = False
    #: Of a reframing stage by ratio: it only looks at frame numbers.
    by_number: bool = False


def resizing(width: int, height: int, **how) -> Stage:
    # What another function does with frames is not known.
    return Stage("resize", lambda clip: resize.resize(clip, (width, height), **how), per_frame=how.get("using") is None)


def reframing(fps: float, technique: str = "intelligent", **how) -> Stage:
    return Stage("reframe", lambda clip: reframe.reframe(clip, fps, technique, **how), by_number=technique == "simple")


def one_bit(threshold: int = 128, method: str = "none", pattern: str = "bayer4x4", **how) -> Stage:
    return Stage("to_1bit", lambda clip: onebit.to_1bit(clip, threshold, method, pattern, **how), per_frame=True)


def delta_coding(key_every: int | None = None) -> Stage:
    return Stage("delta_encode", lambda clip: delta.delta_encode_clip(clip, key_every=key_every))


def delta_decoding() -> Stage:
    return Stage("delta_decode", delta.delta_decode_clip)


def scanlines() -> Stage:
    return Stage("scanline", lambda clip: clip.but("scanline", {}, scanlines=modes.scanline_mode(clip.scanlines)), per_frame=True)


def interlacing() -> Stage:
    return Stage("interlaced", lambda clip: clip.but("interlaced", {}, scanlines=modes.interlaced_mode(clip.scanlines)))


class Progress:
    """Steps done of a total, the seconds since it began and what the last
    ``recent`` steps took; ``report`` gets (done, total, seconds) at each."""

    def __init__(self, total: int, report: Callable[[int, int, float], None] | None = None, recent: int = 10):
        self.total, self.report, self.done = total, report, 0
        self.times: deque[float] = deque(maxlen=recent)
        self.began = self.last = time.monotonic()

    @property
    def seconds(self) -> float:
        return time.monotonic() - self.began

    @property
    def recent(self) -> float | None:
        """The mean of what the last steps took."""
        return sum(self.times) / len(self.times) if self.times else None

    def step(self, n: int = 1) -> None:
        now = time.monotonic()
        self.times.append(now - self.last)
        self.last, self.done = now, min(self.total, self.done + n)
        log.info("%d of %d steps, %.1f s", self.done, self.total, self.seconds)
        if self.report:
            self.report(self.done, self.total, self.seconds)

    def finish(self) -> None:
        if self.done < self.total:
            self.step(self.total - self.done)


@dataclass(frozen=True)
class Chain:
    """Stages in order; ``then`` gives a longer chain."""

    stages: tuple[Stage, ...] = field(default_factory=tuple)

    def then(self, stage: Stage) -> Chain:
        return Chain((*self.stages, stage))

    def optimized(self) -> Chain:
        """Reframing by ratio moves before the per-frame stages that precede
        it: they then work on kept frames only, with the same result."""
        out: list[Stage] = []
        for stage in self.stages:
            at = len(out)
            while stage.by_number and at and out[at - 1].per_frame:
                at -= 1
            out.insert(at, stage)
        return Chain(tuple(out))

    def run(self, clip: Clip, report: Callable[[int, int, float], None] | None = None) -> Clip:
        """The clip after all stages. They only build a plan, but for the
        checks and statistics that were asked for; ``report`` sees each."""
        stages = self.optimized().stages
        progress = Progress(len(stages), report)
        for stage in stages:
            log.info("%s: %d frames of %dx%d", stage.name, clip.frame_count, clip.width, clip.height)
            try:
                clip = stage.run(clip)
            except (ProcessingError, NotImplementedError):
                raise
            except Exception as e:
                raise ProcessingError(str(e), stage.name, {"original_exception": repr(e)}) from e
            progress.step()
        return clip


def summary(clip: Clip) -> DataFrame:
    """(step, component, parameters): what was done to a clip."""
    rows = [(k, s.component, {a: str(b) for a, b in s.parameters.items()}) for k, s in enumerate(clip.history, 1)]
    return clip.scanlines.sparkSession.createDataFrame(rows, "step int, component string, parameters map<string, string>").orderBy(F.col("step"))
