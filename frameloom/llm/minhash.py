"""Near-duplicate documents by DartMinHash signatures and banded joining.

A text is the set of its five-word shingles (fewer words: one shingle of all;
no words: no shingles, and the document stays by itself), weighted by 1 or by
their counts. Darts are hashed into the plane over each element: a Poisson
process whose points have a weight and a rank, and a coordinate of the
signature. Those below the element's weight hit it. Each coordinate keeps the
hit of least rank; two sets agree in a coordinate with the probability of their
weighted Jaccard similarity. Ranks are opened from 0 upward only as far as all
coordinates need, in cells that halve towards 0, so a set of n elements costs
O(n + k log k).

Then, without ever listing the pairs of a group:

1. equal shingle sets become one node with a number of its own, whatever ids
   they have; its representative is the smallest doc_id;
2. bands of the signature give buckets. Large buckets are cut into blocks, and
   pairs of blocks are compared in memory by one byte a coordinate; a block
   pair yields only a spanning forest of what might be similar enough;
3. candidates' components are compared exactly, shingle set by shingle set, as
   matrix products of blocks, again yielding spanning forests only;
4. components of the exact links are the classes.

A pair at the threshold shares a band with probability 0.9999 and passes the
estimate of step 2 with all but about one in a million; step 3 also finds links
that no band showed.

Words are what str.split() gives, between any Unicode white space. Each input
row is a text and gives a row, repeated ones too. Rows that share a doc_id,
whatever their texts, are in one class; each links by its own text. Null ids
count as one id, the smallest. Null texts and those without words link with
nothing. Very long texts are taken whole, in slices that bound a worker's
memory. An empty table gives an empty result; columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import mix

WORDS = 5
BANDS, ROWS = 24, 5
#: Documents in a block of a bucket, and in one of a component.
BUCKET_BLOCK, SET_BLOCK = 256, 128
#: Cells worked on at a time; bounds a worker's memory.
CELLS = 1 << 20
_FINE = 6  # ranks below 1 lie in cells [0, 2**-6), [2**-6, 2**-5), ... [1/2, 1)
_LOW = np.array([0.0, *(2.0 ** (k - _FINE) for k in range(_FINE))])
_LONG = np.array([2.0**-_FINE, *(2.0 ** (k - _FINE) for k in range(_FINE))])
_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xA0761D6478BD642F)]
_NONE = np.uint64(2**64 - 1)

_WORD_HASHES: dict[str, int] = {}


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles, and how often each occurs."""
    own = (text or "").split()
    if not own:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    known = _WORD_HASHES
    if len(known) > 150_000:
        known.clear()
    for w in set(own).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w.encode())
    h = np.fromiter(map(known.__getitem__, own), dtype=np.uint64, count=len(own))
    n = min(words, len(h))
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = mix(out * _SALT[0] + h[k : len(h) - n + 1 + k])
    return np.unique(out + np.uint64(n), return_counts=True)


def _poisson() -> np.ndarray:
    """Distribution functions for the mean of each cell; the last row, mean 1,
    also serves all cells from rank 1 on."""
    rows = []
    for mean in (*_LONG, 1.0):
        term, total, row = math.exp(-mean), 0.0, []
        for k in range(20):
            total += term
            row.append(total)
            term *= mean / (k + 1)
        rows.append(row)
    return np.array(rows)


_CDF = _poisson()


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _throw(elements: np.ndarray, caps: np.ndarray, doc_of: np.ndarray, cells: np.ndarray, k: int, best: np.ndarray) -> None:
    """Puts the least darts of unit regions into ``best`` (docs x k, flat)."""
    each = cells[doc_of]
    at = np.repeat(np.arange(len(elements)), each)
    cell = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
    h = mix(elements[at] + (cell + 1).astype(np.uint64) * _SALT[1])
    kind = np.minimum(cell, _FINE + 1)
    u = _unit(h)
    live, j = np.flatnonzero(u > _CDF[kind, 0]), 0
    while len(live):
        d = mix(h[live] + np.uint64((j + 1) * int(_SALT[2]) % 2**64))
        e = mix(d ^ _SALT[3])
        c, kd = cell[live], kind[live]
        fine = kd <= _FINE
        low = np.where(fine, _LOW[np.minimum(kd, _FINE)], c - _FINE)
        rank = low + np.where(fine, _LONG[np.minimum(kd, _FINE)], 1.0) * _unit(d)
        hit = _unit(mix(e + _SALT[0])) < caps[at[live]]
        packed = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | e >> np.uint64(32)
        slot = doc_of[at[live]] * k + ((e & np.uint64(0xFFFFFFFF)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(best, slot[hit], packed[hit])
        j += 1
        live = live[u[live] > _CDF[kind[live], j]] if j < _CDF.shape[1] else live[:0]


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """DartMinHash signatures (docs x k, uint64) of non-empty weighted sets;
    without weights each element weighs 1."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets) if n else np.zeros(0, dtype=np.uint64)
    doc_of = np.repeat(np.arange(n), sizes)
    w = np.ones(len(elements)) if weights is None else np.concatenate(weights).astype(np.float64)
    # A weight of w is a stack of whole unit regions and one that is cut off.
    high = np.maximum(1, np.ceil(w)).astype(np.int64)
    level = np.arange(int(high.sum())) - np.repeat(np.cumsum(high) - high, high)
    caps = np.minimum(1.0, np.repeat(w, high) - level)
    elements = mix(np.repeat(elements, high) ^ (level + 1).astype(np.uint64) * _SALT[0])
    doc_of = np.repeat(doc_of, high)
    mass = np.bincount(doc_of, weights=caps, minlength=n)
    best = np.full(n * k, _NONE)
    theta = k * (math.log(k) + 3) / np.maximum(mass, 1e-300)
    todo = np.arange(n)
    while len(todo):
        t = theta[todo]
        cells = np.where(t <= _LONG[0], 1, np.where(t <= 1, 1 + np.ceil(np.log2(np.maximum(t, 1e-9)) + _FINE), _FINE + 1 + np.ceil(t - 1))).astype(np.int64)
        every = np.zeros(n, dtype=np.int64)
        every[todo] = cells
        own = np.flatnonzero(every[doc_of] > 0)
        _throw(elements[own], caps[own], doc_of[own], every, k, best)
        todo = todo[(best.reshape(n, k)[todo] == _NONE).any(axis=1)]
        theta[todo] *= 2
    return best.reshape(n, k)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """docs x bands, as signed longs."""
    rows = sig.shape[1] // bands
    out = np.empty((len(sig), bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            h = mix(h * _SALT[1] + sig[:, r])
        out[:, b] = h
    return out.view(np.int64)


def _print(found: tuple[np.ndarray, np.ndarray], weighting: str) -> bytes:
    """Tells shingle sets, with "count" also their weights, apart."""
    return blake2b(b"".join(x.tobytes() for x in found[: 1 + (weighting == "count")]), digest_size=16).digest()


def _sketches(words: int, bands: int, k: int, weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            work = [max(len(t), 6 * k) for t in (x.as_py() or "" for x in batch.column(1))]
            for a, b in common.slices(work, CELLS) if work else ():
                found = [shingles(batch.column(1)[i].as_py(), words) for i in range(a, b)]
                full = [i for i, (s, _) in enumerate(found) if len(s)]
                sig = signatures([found[i][0] for i in full], [found[i][1] for i in full] if weighting == "count" else None, k)
                keys, small = band_keys(sig, bands), (mix(sig) & np.uint64(255)).astype(np.uint8)
                prints = np.frombuffer(b"".join(_print(found[i], weighting) for i in full), "<i8").reshape(-1, 2)
                row = dict(zip(full, range(len(full)), strict=True))
                at = [row.get(i) for i in range(b - a)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": pa.array(docs[a:b]),
                        "f1": pa.array([None if x is None else int(prints[x, 0]) for x in at], pa.int64()),
                        "f2": pa.array([None if x is None else int(prints[x, 1]) for x in at], pa.int64()),
                        "bands": pa.array([None if x is None else keys[x] for x in at], pa.list_(pa.int64())),
                        "sig": pa.array([None if x is None else small[x].tobytes() for x in at], pa.binary()),
                    }
                )

    return run


def by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from sorted batches, with the places where
    groups begin (and the number of rows last). Groups share the first
    ``keys`` columns, which are longs."""
    held: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, dtype=bool)
        new[:1] = True
        for k in range(keys):
            col = t.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows and (at := starts(held))[-1] > 0:
            yield held.slice(0, int(at[-1])), at
            held = held.slice(int(at[-1]))
    if held is not None and held.num_rows:
        yield held, np.append(starts(held), held.num_rows)


def _candidates(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in by_group(batches, 3):
            ids = t.column("node").to_numpy()
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
            edges: list[tuple[int, int]] = []
            two = at[:-1][np.diff(at) == 2]
            near = two[(sig[two] == sig[two + 1]).sum(axis=1) >= least]
            edges += zip(ids[near].tolist(), ids[near + 1].tolist(), strict=True)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if b - a > 2:
                    own = sig[a:b]
                    agree = np.stack([(own == own[i]).sum(axis=1) for i in range(b - a)]) if b - a > 200 else (own[:, None] == own[None]).sum(axis=2)
                    edges += common.spanning(ids[a:b], agree >= least)
            yield _edges(edges)

    return run


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    found = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the
    elements that occur twice, a bounded number of columns at a time."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    row, col = row[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), dtype=np.int64)
    wide = max(1, (1 << 22) // max(1, n))
    for first in range(0, int(shared.sum()), wide):
        a, b = np.searchsorted(col, [first, first + wide])
        block = np.zeros((n, wide), dtype=np.float32)
        block[row[a:b], col[a:b] - first] = 1
        out += (block @ block.T).astype(np.int64)
    return out


def _linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    n = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        shared = np.array([[n[0], both], [both, n[1]]])
    else:
        shared = overlaps(sets)
    union = n[:, None] + n[None] - shared
    return shared >= threshold * union - 1e-9


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in by_group(batches, 3):
            ids, blobs = t.column("node").to_numpy(), t.column("set")
            edges: list[tuple[int, int]] = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                # Rows of one id and text bring the same set.
                own, first = np.unique(ids[a:b], return_index=True)
                if len(own) > 1:
                    sets = [np.frombuffer(blobs[a + i].as_py(), np.uint64) for i in first.tolist()]
                    edges += common.spanning(own, _linked(sets, threshold))
            yield _edges(edges)

    return run


def _sets(words: int, marks: np.ndarray, weighting: str):
    """Shingle sets of the texts whose mark is set: all that are wanted and
    few others, which the join with the exact nodes removes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.flatnonzero(common.hits(marks, batch.column("b").to_numpy())).tolist()
            rows: dict[tuple[int, bytes], bytes] = {}
            for k, doc in zip(hit, batch.column("doc").take(pa.array(hit, pa.int64())).to_pylist(), strict=True):
                found = shingles(batch.column("text")[k].as_py(), words)
                rows[doc, _print(found, weighting)] = found[0].tobytes()
            docs, prints = zip(*rows, strict=True) if rows else ((), ())
            halves = np.frombuffer(b"".join(prints), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(list(rows.values()), pa.binary())], ["doc", "f1", "f2", "set"])

    return run


def _in_blocks(df: DataFrame, group: str, node: str, block: int, payload: str) -> DataFrame:
    """Rows (group, lo, hi, node, payload) for each pair of blocks of a group
    of ``m`` nodes, gathered by these keys and sorted. A group of up to
    ``block`` nodes is one block, and a node is sent once for each block."""
    df = df.withColumn("nb", F.expr(f"cast(greatest(1, (m + {block - 1}) div {block}) as int)"))
    df = df.withColumns({"own": F.pmod(F.xxhash64(node, group), F.col("nb")).cast("int"), "to": F.explode(F.sequence(F.lit(0), F.col("nb") - 1))})
    df = df.select(group, F.least("own", "to").cast("long").alias("lo"), F.greatest("own", "to").cast("long").alias("hi"), node, payload)
    return df.repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi", node)


def near_duplicates(docs: DataFrame, *, threshold: float = 0.8, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, weighting: str = "distinct") -> DataFrame:
    """One row for each row of ``docs``: doc (null as NULL_ID), copy_of (the
    smallest document with the same shingles) and class_id (the smallest
    document of its class, itself if alone).

    ``threshold`` is on the Jaccard similarity of the shingle sets.
    ``weighting`` sets what the signatures see: "distinct" or "count".
    """
    if weighting not in ("distinct", "count"):
        raise ValueError("weighting is 'distinct' or 'count'")
    spark, k = docs.sparkSession, bands * rows
    scratch = common.Scratch(spark, "minhash")
    keep: Callable[[DataFrame, str], DataFrame] = scratch.keep
    texts = docs.select(common.key_of("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    sketch = keep(texts.mapInArrow(common.tidy(_sketches(words, bands, k, weighting)), "doc long, f1 long, f2 long, bands array<long>, sig binary"), "sketch")
    full = sketch.filter("f1 is not null")
    empty = sketch.filter("f1 is null").select("doc", F.col("doc").alias("copy_of"), F.col("doc").alias("class_id"))
    # Equal sets have equal signatures: the first stands for all.
    nodes = full.groupBy("f1", "f2").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    spread = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keep(spread.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "buckets")
    hits = keep(spread.join(buckets, "key").select("key", "m", "node"), "hits")
    hits = hits.join(nodes.select("node", "sig"), "node")
    # 4.8 standard deviations below what a pair at the threshold is expected to agree in
    least = math.floor(k * threshold - 4.8 * math.sqrt(k * threshold * (1 - threshold)))
    near = _in_blocks(hits, "key", "node", BUCKET_BLOCK, "sig").mapInArrow(common.tidy(_candidates(least)), "a long, b long")
    clusters = keep(common.components(near.distinct(), scratch, "near").select("node", F.col("comp").alias("q")), "clusters")
    sizes = keep(clusters.groupBy("q").agg(F.count("*").alias("m")), "sizes")
    prints = nodes.select(F.col("node").alias("n_node"), "rep", "f1", "f2")
    clustered = keep(clusters.join(sizes, "q").join(prints, F.col("node") == F.col("n_node")).select("q", "m", "node", "rep", "f1", "f2"), "clustered")
    scratch.drop("buckets", "hits", "clusters", "sizes")

    sets = texts.select("doc", common.mark("doc").alias("b"), "text").mapInArrow(common.tidy(_sets(words, common.marks(clustered, "rep"), weighting)), "doc long, f1 long, f2 long, set binary")
    sets = sets.join(clustered.withColumnRenamed("rep", "doc"), ["doc", "f1", "f2"]).select("q", "m", "node", "set")
    links = _in_blocks(sets, "q", "node", SET_BLOCK, "set").mapInArrow(common.tidy(_verified(threshold)), "a long, b long")
    classes = keep(common.components(links.distinct(), scratch, "links"), "classes")
    classes = keep(classes.join(prints, F.col("node") == F.col("n_node")).select("node", "comp", "rep"), "linked")
    labels = keep(classes.groupBy("comp").agg(F.min("rep").alias("label")), "labels")
    classes = classes.join(labels, "comp").select(F.col("node").alias("l_node"), "label")
    # What a set has found, by its fingerprint; its rows join once.
    named = nodes.select("node", "f1", "f2", "rep").join(classes, F.col("node") == F.col("l_node"), "left")
    named = keep(named.select("f1", "f2", F.col("rep").alias("copy_of"), F.coalesce("label", "rep").alias("class_id")), "named")
    found = full.select("doc", "f1", "f2").join(named, ["f1", "f2"]).select("doc", "copy_of", "class_id").unionByName(empty)
    found = keep(found, "found")
    scratch.drop("sketch", "nodes", "clustered", "classes", "linked", "labels", "named")
    return common.joined_by_id(found, "doc", "class_id", scratch)
