"""Byte-level BPE with the tiktoken library and a local rank file.

Texts beyond ``PIECE`` characters are cut before white space that follows a
character that is not white space. No match of the splitting pattern holds such
a pair, and its only lookahead asks about white space, so the pieces give the
ids of the whole. A stretch without such a place stays whole. Decoding joins
the raw bytes of the ids, so an id sequence that ends inside a character
decodes as well.

Null and empty texts have no ids. Each input row gives one row, repeated rows
too, and an empty table none; columns other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PIECE = 1 << 16
#: A place where a text may be cut, in any engine's reading of white space.
SAFE = re.compile(r"(?<=[^\s\x1c-\x1f᠎​﻿])(?=[ \t\n\r\x0b\x0c])")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``size`` characters that encode apart."""
    at = 0
    while len(text) - at > size and (m := SAFE.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


class RankEncoder:
    """Encodes and decodes by a rank file and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.decimal = [str(k) for k in range(size)]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        return [k for piece in pieces(text) for k in self.encoding.encode_ordinary(piece)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], RankEncoder] = {}


def encoder(path: str, pattern: str) -> RankEncoder:
    """One for each Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = RankEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            ids = [enc.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _rows(docs).mapInArrow(common.tidy(run), "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            out = [enc.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(common.tidy(run), "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, *, with_ids: bool = False) -> DataFrame:
    """Encodes each whole text and decodes its ids, in one pass: doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256,
    exact (the bytes are those of the text) and, if asked, the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            n, of_ids, of_bytes, exact, kept = [], [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                ids = enc.encode(text)
                raw = enc.decode(ids)
                n.append(len(ids))
                of_ids.append(sha(",".join(map(enc.decimal.__getitem__, ids)).encode()))
                of_bytes.append(sha(raw))
                exact.append(raw == text.encode())
                if with_ids:
                    kept.append(np.array(ids, dtype=np.int32))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()), pa.array(exact, pa.bool_())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"]
            if with_ids:
                cols, names = [*cols, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"
    return _rows(docs).mapInArrow(common.tidy(run), kind + ", ids array<int>" * with_ids)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
