"""Line dedup: lines that too many documents share go, but for one holder.

A line's key is the line without ASCII white space at its ends, with A-Z in
lower case. Keys of at least ``min_chars`` code points are hashed to 128 bits;
each document sends each of its keys once. Two aggregations count documents for
each hash, the second on partial counts, so a line that every document holds
is no hot spot. Hashes in ``min_docs`` documents or more lose their lines in
all but the largest doc_id that holds them. The losses are gathered by document
and the text is put together again from the lines that stay, in their places.

Rows that share a doc_id count as one document; rows without doc_id are one
document that comes before all others. Null text counts as empty: one empty
line, which stays. All rows come back, repeated ones too. Texts are read whole,
however long; a text that loses very many lines meets them in one row. An empty
table gives an empty result. Carried columns may have any names, but those of
results give way to these.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLANK = " \t\n\v\f\r"


def line_keys(text: str | None, min_chars: int) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text, and for each its 16-byte key or None if short."""
    lines, keys = (text or "").split("\n"), []
    for line in lines:
        bare = line.strip(BLANK)
        # bytes.lower() changes A-Z only
        keys.append(blake2b(bare.encode().lower(), digest_size=16).digest() if len(bare) >= min_chars else None)
    return lines, keys


def _exploded(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = {k for k in line_keys(text.as_py(), min_chars)[1] if k}
                keys += own
                docs += [doc] * len(own)
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc", "k1", "k2"])

    return run


def _assembled(min_chars: int):
    """(fl_row, fl_text, fl_lost) to fl_row and the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            for text, lost in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py() or ""
                if not lost.is_valid:
                    n_lines.append(text.count("\n") + 1)
                    n_dropped.append(0)
                    texts.append(text)
                    continue
                halves = lost.values
                gone = {*map(bytes, np.stack([halves.field(k).to_numpy() for k in (0, 1)], axis=1).astype("<i8"))}
                lines, keys = line_keys(text, min_chars)
                stay = [line for line, k in zip(lines, keys, strict=True) if k not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                texts.append("\n".join(stay))
            cols = [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["fl_row", "fl_n_lines", "fl_n_dropped", "fl_kept"])

    return run


def line_dedup(docs: DataFrame, *, min_chars: int = 20, min_docs: int = 3, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: the ``carry`` columns (doc_id if not
    given) and fl_n_lines, fl_n_dropped, fl_kept (the text that stays)."""
    scratch = common.Scratch(docs.sparkSession, "line-dedup")
    carry = ["doc_id"] if carry is None else carry
    rows = docs.select(common.key_of("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    keys = scratch.keep(rows.mapInArrow(common.tidy(_exploded(min_chars)), "doc long, k1 long, k2 long"), "keys")
    held = keys.groupBy("k1", "k2", "doc").agg(F.lit(1).alias("one"))
    common_lines = held.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc").alias("last")).filter(F.col("n") >= min_docs)
    # Written first: the join then has plain exchanges on both sides, which adaptive execution splits if a line is hot.
    common_lines = scratch.keep(common_lines.select("k1", "k2", "last"), "common")
    lost = keys.join(common_lines, ["k1", "k2"]).filter("doc <> last").select("doc", F.struct("k1", "k2").alias("k"))
    lost = lost.groupBy("doc").agg(F.collect_set("k").alias("fl_lost"))
    whole = docs.select(common.carried(carry), F.col("text").cast("string").alias("fl_text"), common.key_of("doc_id").alias("fl_doc"))
    joined = whole.join(lost, F.col("fl_doc") == lost["doc"], "left").select("fl_row", "fl_text", "fl_lost")
    kind = f"fl_row {common.carried_kind(docs, carry)}, fl_n_lines long, fl_n_dropped long, fl_kept string"
    return joined.mapInArrow(common.tidy(_assembled(min_chars)), kind).select(*common.spread(carry, ["fl_n_lines", "fl_n_dropped", "fl_kept"]))
