"""A log file for a run, beside whatever handlers the application has."""

from __future__ import annotations

import contextlib
import datetime
import logging
from collections.abc import Iterator
from pathlib import Path

log = logging.getLogger("frameloom")


@contextlib.contextmanager
def to_file(folder: str, level: int = logging.INFO) -> Iterator[Path]:
    """Writes the package's messages, fields parted by bars, to a new file of
    the driver's ``folder`` while the context lasts. Nothing is written by
    importing the package or building a chain."""
    path = Path(folder) / f"chainable_processing_{datetime.datetime.now():%Y%m%d_%H%M%S_%f}.log"
    path.parent.mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(path, encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s | %(levelname)s | %(name)s | %(message)s"))
    before = log.level
    log.addHandler(handler)
    log.setLevel(min(level, before or level))
    try:
        yield path
    finally:
        log.removeHandler(handler)
        log.setLevel(before)
        handler.close()
