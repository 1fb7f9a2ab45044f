"""Near-duplicate embeddings by an inverted multi-index.

Vectors are normalised and cut in halves. A codebook for each half, fitted on
a bounded sample, spans a product grid of cells; every vector lies in one cell.
A multi-sequence traversal visits the cells of a vector in order of the summed
distances to both halves' centroids, up to ``reach`` beyond the nearest cell.
The reach follows from a target recall: vectors of the sample are paired with
noisy copies at just the threshold, and it is the least that lets this share of
the pairs meet, one visiting the other's cell. Then every vector is compared
exactly, in double precision, with all vectors of the cells it visits.

There are about ``cell_rows`` vectors to a cell at any size of the corpus. The
sample is ``sample`` vectors, or eight for each codeword of a half if that is
more: it grows with the square root of the corpus, from 10^8 vectors on.

Equal vectors are one node with a count and a number of its own, whatever ids
they have. A crowded cell is cut into blocks and its visitors into parts, so it
is spread over tasks; each pair of block and part is one matrix product. It
yields a count for each vector and a star for each connected group in it, never
the pairs. A pair that only one side finds counts for both: a vector is dealt
with the list of cells it visits.

Vectors of each length have an index and cells of their own; only equal lengths
can link. Vectors that are null, empty, zero, or that hold null or non-finite
components link with nothing. Each input row counts as a
vector and gives a row; an empty table gives none. Rows that share a vec_id are
in one component, though their vectors may differ and only those that link
count. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .minhash import by_group

#: Vectors the codebooks are fitted on, at least; vectors a cell holds, about.
SAMPLE, CELL_ROWS = 20_000, 16
#: Vectors of a block, and visitors that meet it at a time.
BLOCK, VISITORS = 1024, 4096
TARGET_RECALL = 0.998


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if it has no direction."""
    if not values or any(x is None for x in values):
        return None
    v = np.array(values, dtype=np.float64)
    most = np.abs(v).max()
    if not np.isfinite(most) or most == 0:
        return None
    v = v / most  # so that squares neither vanish nor overflow
    return v / np.sqrt(v @ v)


def units(column: pa.ListArray) -> list[np.ndarray | None]:
    """``unit`` of each list, all of a length at once."""
    out: list[np.ndarray | None] = [None] * len(column)
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        flat = column.take(pa.array(rows)).flatten()
        # A null becomes NaN, which has no direction either.
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
        most = np.abs(x).max(axis=1)
        good = np.isfinite(most) & (most > 0)
        x = x[good] / most[good, None]  # so that squares neither vanish nor overflow
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        for k, v in zip(rows[good].tolist(), x, strict=True):
            out[k] = v
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [None if v is None else v.tobytes() for v in units(batch.column(1))]
        prints = [None if v is None else np.frombuffer(blake2b(v, digest_size=16).digest(), "<i8").tolist() for v in found]
        yield pa.RecordBatch.from_pydict(
            {
                "vec": batch.column(0),
                "f1": pa.array([p and p[0] for p in prints], pa.int64()),
                "f2": pa.array([p and p[1] for p in prints], pa.int64()),
                "dim": pa.array([None if v is None else len(v) // 8 for v in found], pa.int64()),
                "v": pa.array(found, pa.binary()),
            }
        )


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None])


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from k distinct rows; an empty centroid stays in place."""
    x = np.ascontiguousarray(x)
    c = x[rng.permutation(len(x))[:k]].copy()
    step = max(1, (1 << 22) // len(c))  # rows at a time: bounds the matrix of distances
    for _ in range(rounds):
        own = np.concatenate([_squares(x[a : a + step], c).argmin(1) for a in range(0, len(x), step)])
        order = np.argsort(own, kind="stable")
        n = np.bincount(own, minlength=len(c))
        used = np.flatnonzero(n)
        c[used] = np.add.reduceat(x[order], (np.cumsum(n) - n)[used]) / n[used, None]
    return c


def traverse(d1: np.ndarray, d2: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the distances to both codebooks the cells
    (k1 * codewords of the second + k2) of d1[k1] + d2[k2] within ``reach`` of
    the least, nearest first: (rows, cells), by row.

    Both sequences are sorted; for each place in the first one, the places of
    the second that are near enough are a beginning of it, and the next place
    has no more of them. All rows take each step together.
    """
    sequences = []
    for d in (d1, d2):
        d = d - d.min(axis=1)[:, None]
        wide = int((d <= reach).sum(axis=1).max(initial=0))
        order = np.argsort(d, axis=1, kind="stable")[:, :wide]
        sequences += [order, np.take_along_axis(d, order, axis=1)]
    a, s1, b, s2 = sequences
    rows, cells, sums = [], [], []
    for i in range(a.shape[1]):
        live = np.flatnonzero(s1[:, i] <= reach)
        near = s1[live, i, None] + s2[live] <= reach
        r, j = np.nonzero(near)
        rows.append(live[r])
        cells.append(a[live[r], i] * d2.shape[1] + b[live[r], j])
        sums.append(s1[live[r], i] + s2[live[r], j])
    row, cell, total = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (rows, cells, sums))
    order = np.lexsort([cell, total, row])
    return row[order], cell[order]


class MultiIndex:
    """Two codebooks and how far beyond the nearest cell to visit."""

    def __init__(self, sample: np.ndarray, codewords: int, threshold: float, recall: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.half = max(1, sample.shape[1] // 2)
        self.books = [kmeans(x, min(codewords, len(x)), rng) for x in (sample[:, : self.half], sample[:, self.half :])]
        self.wide = len(self.books[1])
        self.cells = len(self.books[0]) * self.wide
        some = np.repeat(sample[rng.permutation(len(sample))[:4000]], max(1, 2000 // len(sample)), axis=0)
        # Half of the copies differ in any direction, half in one in which vectors of the sample differ.
        noise = rng.standard_normal(some.shape)
        noise[::2] = (some - some[rng.permutation(len(some))])[::2] + 1e-9 * noise[::2]
        noise -= (noise * some).sum(1)[:, None] * some
        size = np.sqrt((noise * noise).sum(1))[:, None]
        near = threshold * some + math.sqrt(max(0.0, 1 - threshold**2)) * noise / np.maximum(size, 1e-12)
        apart = np.sort(np.minimum(self._beyond(some, near), self._beyond(near, some)))
        self.reach = float(apart[min(len(apart) - 1, math.ceil(recall * len(apart)) - 1)])

    def _beyond(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How much farther y's cells are than the nearest ones, from x."""
        out = np.zeros(len(x))
        for k, (dx, dy) in enumerate(zip(self.distances(x), self.distances(y), strict=True)):
            out += dx[np.arange(len(x)), dy.argmin(1)] - dx.min(1)
        return out

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squares(x[:, : self.half], self.books[0]), _squares(x[:, self.half :], self.books[1])

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cells), by row, nearest first: a row's first cell is its own."""
        rows, cells, step = [], [], max(1, (1 << 22) // max(map(len, self.books)))
        for at in range(0, len(x), step):
            r, c = traverse(*self.distances(x[at : at + step]), self.reach)
            rows.append(r + at)
            cells.append(c)
        return np.concatenate(rows), np.concatenate(cells)


def _placed(indexes: dict[int, tuple[int, MultiIndex | None]]):
    """The cells of each vector, by the first cell of its length and the index
    (None: one cell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                base, index = indexes[dim]
                if index is None:
                    cells = np.full(part.num_rows, base, dtype=np.int64)
                    at = np.arange(part.num_rows + 1)
                else:
                    rows, cells = index.visits(np.frombuffer(b"".join(part.column("v").to_pylist())).reshape(part.num_rows, -1))
                    at, cells = np.searchsorted(rows, np.arange(part.num_rows + 1)), cells + base
                visits = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(cells, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "n", "v")), pa.array(cells[at[:-1]], pa.int64()), visits], ["node", "n", "v", "own", "visits"])

    return run


def _dealt(placed: DataFrame, scratch: common.Scratch) -> DataFrame:
    """Each vector in its own cell and, as a visitor, in each that it visits,
    by (cell, block, part): an owner goes to one block and all parts of the
    visitors, a visitor to one part and all blocks."""
    owners = placed.select(F.col("own").alias("cell"), F.lit(False).alias("visitor"), "node", "n", "own", "v", "visits")
    visitors = placed.select(F.explode("visits").alias("cell"), F.lit(True).alias("visitor"), "node", "n", "own", "v", F.lit(None).cast("array<long>").alias("visits"))
    both = owners.unionByName(visitors)
    # Only crowded cells are listed: none or few, so that Spark can broadcast them, but nothing rests on that.
    counts = both.groupBy("cell").agg(F.count_if(~F.col("visitor")).alias("rows"), F.count_if("visitor").alias("visitors"))
    counts = counts.select("cell", F.expr(f"cast(ceil(rows / {BLOCK}) as long)").alias("blocks"), F.expr(f"cast(ceil(visitors / {VISITORS}) as long)").alias("parts"))
    crowded = scratch.keep(counts.filter("blocks > 1 or parts > 1"), "crowded")
    rows = both.join(crowded, "cell", "left").withColumns({"blocks": F.greatest(F.coalesce("blocks", F.lit(1)), F.lit(1)), "parts": F.greatest(F.coalesce("parts", F.lit(1)), F.lit(1))})
    rows = rows.withColumn("t", F.explode(F.expr("sequence(0L, if(visitor, blocks, parts) - 1)")))
    place = "pmod(xxhash64(visitor, node), {})".format
    rows = rows.withColumns({"block": F.expr(f"if(visitor, t, {place('blocks')})"), "part": F.expr(f"if(visitor, {place('parts')}, t)")})
    rows = rows.select("cell", "block", "part", "visitor", "node", "n", "own", "v", "visits")
    return rows.repartition("cell", "block", "part").sortWithinPartitions("cell", "block", "part", "visitor", "node")


def _matched(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in by_group(batches, 3):
            counts: list[np.ndarray] = []
            stars: list[np.ndarray] = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                _match(t.slice(a, b - a), threshold, counts, stars)
            for kind, found in ((0, counts), (1, stars)):
                if found:
                    rows = np.concatenate(found)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, dtype=np.int32)), pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["kind", "a", "b"])

    return run


def _match(t: pa.Table, threshold: float, counts: list[np.ndarray], stars: list[np.ndarray]) -> None:
    visitor = t.column("visitor").to_numpy()
    q, y = np.flatnonzero(visitor), np.flatnonzero(~visitor)
    if not len(q) or not len(y):
        return
    ids, n, own = (t.column(c).to_numpy() for c in ("node", "n", "own"))
    x = np.frombuffer(b"".join(t.column("v").to_pylist())).reshape(len(ids), -1)
    near = (x[q] @ x[y].T >= threshold) & (ids[q][:, None] != ids[y][None])
    if not near.any():
        return
    counts.append(np.stack([ids[q], near @ n[y]], axis=1)[near.any(1)])
    # y finds q by itself if it visits q's cell; where it doesn't, this link counts for y as well.
    cells, which = np.unique(own[q], return_inverse=True)
    sees = np.zeros((len(y), len(cells)), dtype=bool)
    visits = t.column("visits").combine_chunks().take(pa.array(y))
    flat, row = visits.flatten().to_numpy(), np.repeat(np.arange(len(y)), visits.value_lengths().to_numpy())
    spot = np.searchsorted(cells, flat)
    known = (spot < len(cells)) & (cells[np.minimum(spot, len(cells) - 1)] == flat)
    sees[row[known], spot[known]] = True
    alone = near & ~sees[:, which].T
    if alone.any():
        counts.append(np.stack([ids[y], n[q] @ alone], axis=1)[alone.any(0)])
    q, y, near = q[near.any(1)], y[near.any(0)], near[near.any(1)][:, near.any(0)]
    top = np.iinfo(np.int64).max
    left, right = ids[q].copy(), ids[y].copy()
    while True:
        new_left = np.minimum(left, np.where(near, right[None], top).min(1))
        new_right = np.minimum(right, np.where(near, new_left[:, None], top).min(0))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    found = np.concatenate([np.stack([left, ids[q]], axis=1), np.stack([right, ids[y]], axis=1)])
    stars.append(found[found[:, 0] != found[:, 1]])


def _index(nodes: DataFrame, total: int, threshold: float, recall: float, sample: int, cell_rows: int) -> MultiIndex | None:
    """The index of ``total`` vectors of one length; None if they are so few
    that one cell does."""
    codewords = round(math.sqrt(total / cell_rows))
    if codewords < 2:
        return None
    share = min(1.0, max(sample, 8 * codewords) / total)
    # Chosen by hash; the index holds every row.
    picked = nodes.filter(F.pmod(F.xxhash64(F.lit(3), "f1"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").collect()
    picked = picked or nodes.select("v").limit(sample).collect()
    return MultiIndex(np.frombuffer(b"".join(bytes(r[0]) for r in picked)).reshape(len(picked), -1), codewords, threshold, recall)


def embedding_links(vectors: DataFrame, *, threshold: float = 0.95, recall: float = TARGET_RECALL, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec (null as NULL_ID), n_links (other rows linked directly) and
    component (the smallest vec reachable by links), one row for each row of
    ``vectors`` (vec_id, embedding)."""
    scratch = common.Scratch(vectors.sparkSession, "embeddings")
    keep = scratch.keep
    rows = vectors.select(common.key_of("vec_id").alias("vec"), F.col("embedding").cast("array<double>").alias("embedding"))
    full = keep(rows.mapInArrow(common.tidy(_units), "vec long, f1 long, f2 long, dim long, v binary"), "units")
    # Without a direction a vector links with nothing.
    alone = full.filter("dim is null").select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component"))
    full = full.filter("dim is not null")
    # An id may be null or repeated on other vectors, so each distinct vector has a number, fixed once it is written.
    nodes = full.groupBy("f1", "f2").agg(F.min("dim").alias("dim"), F.min("vec").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
    nodes = keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    indexes, cells = {}, 0
    for dim, total in nodes.groupBy("dim").count().orderBy("dim").collect():
        index = _index(nodes.filter(F.col("dim") == dim), total, threshold, recall, sample, cell_rows)
        indexes[dim] = (cells, index)
        cells += index.cells if index else 1
    if not indexes:
        return alone
    placed = keep(nodes.select("node", "n", "v", "dim").mapInArrow(common.tidy(_placed(indexes)), "node long, n long, v binary, own long, visits array<long>"), "placed")
    found = keep(_dealt(placed, scratch).mapInArrow(common.tidy(_matched(threshold)), "kind int, a long, b long"), "found")
    scratch.drop("placed")
    counts = keep(found.filter("kind = 0").groupBy(F.col("a").alias("c_node")).agg(F.sum("b").alias("links")), "counts")
    stars = common.components(found.filter("kind = 1").select("a", "b"), scratch, "links")
    known = keep(counts.join(stars, counts["c_node"] == stars["node"]).join(nodes.select(F.col("node").alias("r_node"), "rep"), F.col("c_node") == F.col("r_node")).select("c_node", "links", "comp", "rep"), "known")
    scratch.drop("found", "counts")
    least = known.groupBy("comp").agg(F.min("rep").alias("label"))
    known = keep(known.join(keep(least, "least"), "comp").select("c_node", "links", "label"), "named")
    # What a distinct vector has found, by its fingerprint; its rows join once.
    named = nodes.join(known, nodes["node"] == known["c_node"], "left")
    named = keep(named.select("f1", "f2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component")), "vectors")
    out = full.select("vec", "f1", "f2").join(named, ["f1", "f2"]).select("vec", "n_links", "component").unionByName(alone)
    out = keep(out, "labelled")
    scratch.drop("units", "nodes", "known", "least", "named", "vectors")
    return common.joined_by_id(out, "vec", "component", scratch)
