"""Token-id output: frequency-ranked ids in a byte-aligned variable-length code.

A shard holds whole documents in ascending ``doc_id`` order:

    magic 8 bytes | version, ranked flag, n_docs, n_ids, start: five int64
    doc_id int64[n_docs] | ids of each document int64[n_docs]
    control bytes: 2 bits an id, four ids a byte, its length less 1
    data bytes: the id's rank, 1 to 4 little-endian bytes

An id is stored as its rank by frequency over the whole corpus (ties: smaller
id first), so the most frequent 256 take one byte. Control and data bytes lie
apart; a table turns control bytes into the places of an id's bytes, so NumPy
decodes a shard without a loop over ids.

A folder of token files holds ``shards`` (a row for each: part, seq, start,
n_docs, n_ids, body), ``ranks`` (rank, id) and ``info``. Spark's writers commit
them, so they appear whole or not at all on any store that Spark writes to, and
no file is ever replaced. By (part, seq), as by start, shards ascend.

Writing takes one shuffle of the texts: they are dealt by ranges of doc_id and
of the first characters of the text, so that rows of one id or without any
spread as well, sorted, encoded once and kept as raw shards in the scratch
folder; counts are summed over all of them, and each raw shard is read once
more to be written with ranks.

Null text counts as empty. Rows with equal doc_id follow each other by text,
null ids come first; an empty table gives no shards. A very long text is
encoded whole and lies in one shard, however long; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .subwords import encoder

MAGIC = b"FLTOKEN1"
HEAD = 8 + 5 * 8
#: Lengths of the four ids of a control byte, and which of ``wide`` bytes each of them has.
LENGTHS = np.array([[1 + (c >> s & 3) for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)
MASKS = {wide: np.arange(wide, dtype=np.uint8) < LENGTHS[:, :, None] for wide in (2, 4)}


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of non-negative values below 2**32."""
    n, wide = len(values), 2 if int(values.max(initial=0)) <= 0xFFFF else 4
    values = np.ascontiguousarray(values, dtype=f"<u{wide}")
    extra = np.zeros(-n % 4 + n, dtype=np.uint8)
    extra[:n] = values > 0xFF
    if wide == 4:
        extra[:n] += (values > 0xFFFF).astype(np.uint8) + (values > 0xFFFFFF)
    four = extra.view("<u4")
    control = (four & 3 | four >> 6 & 12 | four >> 12 & 48 | four >> 18 & 192).astype(np.uint8)
    return control, values.view(np.uint8).reshape(-1, wide)[MASKS[wide][control].reshape(-1, wide)[:n]]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values, by table lookup: where each one's bytes go follows from
    its control bits."""
    wide = 2 if int(LENGTHS[control].max(initial=1)) <= 2 else 4
    values = np.zeros((n, wide), dtype=np.uint8)
    values[MASKS[wide][control].reshape(-1, wide)[:n]] = data
    return values.reshape(-1).view(f"<u{wide}")


def _head(ranked: bool, ids: np.ndarray, sizes: np.ndarray, start: int) -> bytes:
    return MAGIC + np.array([1, ranked, len(ids), int(sizes.sum()), start], dtype="<i8").tobytes() + ids.astype("<i8").tobytes() + sizes.astype("<i8").tobytes()


def parse(body: bytes | pa.Buffer) -> tuple[bool, int, np.ndarray, np.ndarray, int]:
    """ranked, start, doc ids, ids of each document, and where the codes begin."""
    body = memoryview(body)
    if body[:8] != MAGIC:
        raise ValueError("not a token file")
    version, ranked, n_docs, n_ids, start = np.frombuffer(body, "<i8", 5, 8).tolist()
    if version != 1:
        raise ValueError(f"version {version} is not known")
    ids, sizes = (np.frombuffer(body, "<i8", n_docs, HEAD + 8 * n_docs * k) for k in (0, 1))
    if int(sizes.sum()) != n_ids:
        raise ValueError("the sizes of the documents don't match the header")
    return bool(ranked), start, ids, sizes, HEAD + 16 * n_docs


def decode_shard(body: bytes | pa.Buffer, by_rank: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """start, doc ids, ids of each document and all ids of a ranked shard."""
    ranked, start, ids, sizes, at = parse(body)
    if not ranked:
        raise ValueError("the shard has not been ranked")
    n = int(sizes.sum())
    split = at + -(-n // 4)
    ranks = unpack(np.frombuffer(body, np.uint8, split - at, at), np.frombuffer(body, np.uint8)[split:], n)
    return start, ids, sizes, by_rank[ranks]


#: A raw shard: ids as they are, and what the whole corpus has to know of them.
RAW = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("start", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
SHARDS = "part long, seq long, start long, n_docs long, n_ids long, body binary"


def _raw_shards(tokenizer: str, end_id: int | None, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        tail = b"" if end_id is None else np.array([end_id], dtype=enc.dtype).tobytes()
        wide, before, seq = enc.dtype.itemsize, 0, 0
        docs: list[int] = []
        codes: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            nonlocal before, seq, held
            sizes = np.array([len(code) // wide for code in codes], dtype=np.int64)
            blob, n = b"".join(codes), int(sizes.sum())
            counts = np.bincount(np.frombuffer(blob, enc.dtype), minlength=enc.vocab_size)
            used = np.flatnonzero(counts)
            body = _head(False, np.array(docs, dtype=np.int64), sizes, before) + blob
            row = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "start": [before], "n_docs": [len(docs)], "n_ids": [n], "body": [body], "ids": [used], "counts": [counts[used]]}, schema=RAW)
            before, seq, held = before + n, seq + 1, 0
            docs.clear()
            codes.clear()
            return row

        for batch in batches:
            for doc, code in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1).to_pylist()), strict=True):
                docs.append(doc)
                codes.append(code + tail)
                held += len(code) + len(tail)
                if held >= shard_ids * wide:
                    yield shard()
        if docs:
            yield shard()

    return run


def _ranked(dtype: np.dtype, rank_of: np.ndarray, base: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                body = body.as_buffer()
                _, start, ids, sizes, at = parse(body)
                control, data = pack(rank_of[np.frombuffer(body, dtype, offset=at)])
                start += base[part]
                body = b"".join([_head(True, ids, sizes, start), control, data])
                yield pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "start": [start], "n_docs": [len(ids)], "n_ids": [int(sizes.sum())], "body": [body]})

    return run


def write_token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, uri: str, *, end_id: int | None = 0, shard_ids: int = 1 << 21) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) and writes the shards below ``uri``.

    ``tokenizer`` is a file of the tokenizers library, ``end_id`` is put after
    each document (None: nothing), ``shard_ids`` is the size from which a new
    shard begins. Returns a row for each shard: part, seq, start, n_docs, n_ids.
    """
    # The driver holds counts for each id of the vocabulary and a start for each partition, nothing for each document.
    scratch = common.Scratch(spark, "token-files")
    rows = docs.select(common.key_of("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc", F.left("text", F.lit(64))).sortWithinPartitions("doc", "text")
    made = rows.mapInArrow(_raw_shards(tokenizer, end_id, shard_ids), SHARDS + ", ids array<long>, counts array<long>")
    made = scratch.keep(made, "raw", whole_values=True)
    enc = encoder(tokenizer)
    counts = np.zeros(enc.vocab_size, dtype=np.int64)
    for k, n in made.select(F.explode(F.arrays_zip("ids", "counts")).alias("x")).groupBy("x.ids").agg(F.sum("x.counts")).collect():
        counts[k] = n
    by_rank = np.lexsort([np.arange(len(counts)), -counts]).astype(np.uint32)
    rank_of = np.empty(len(by_rank), dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    base, before = {}, 0
    for part, n in made.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect():
        base[part] = before
        before += n
    ranks = spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank long, id long")
    ranks.coalesce(1).write.mode("overwrite").parquet(f"{uri}/ranks")
    done = made.select("part", "seq", "body").mapInArrow(_ranked(enc.dtype, rank_of, base), SHARDS)
    common.write_whole(done, f"{uri}/shards")
    spark.createDataFrame([(end_id, before, len(by_rank))], "end_id long, n_ids long, vocab_size long").coalesce(1).write.mode("overwrite").parquet(f"{uri}/info")
    scratch.close()
    return spark.read.schema(SHARDS).parquet(f"{uri}/shards").drop("body")


def _digests(by_rank: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                start, docs, sizes, ids = decode_shard(body.as_buffer(), by_rank)
                ends = np.cumsum(sizes)
                blob = memoryview(ids.astype("<u4").tobytes())
                cuts = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
                cols = {
                    "doc": docs,
                    "start": start + ends - sizes,
                    "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(blob[4 * a : 4 * b]) for a, b in cuts],
                }
                if with_ids:
                    cols["ids"] = [ids[a:b].astype(np.int64) for a, b in cuts]
                yield pa.RecordBatch.from_pydict(cols)

    return run


def read_token_files(spark: SparkSession, uri: str, *, with_ids: bool = False) -> DataFrame:
    """A row for each document of the shards below ``uri``: doc_id, start (ids
    of all documents before it), n_tokens, ids_crc32 and, if asked, ids."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{uri}/ranks").collect()  # as many as the vocabulary has
    by_rank = np.zeros(len(ranks), dtype=np.uint32)
    for rank, k in ranks:
        by_rank[rank] = k
    files = spark.read.schema(SHARDS).parquet(f"{uri}/shards").select("body")
    kind = "doc long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    rest = ["start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return files.mapInArrow(_digests(by_rank, with_ids), kind).select(common.id_of("doc").alias("doc_id"), *rest)
