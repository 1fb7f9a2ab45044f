"""Helpers shared by the text and vector operators of this subpackage.

* ``Scratch`` keeps intermediate tables as Parquet in the shared folder that
  ``spark.checkpoint.dir`` names, so that a lost executor loses none of them.
* ``components`` finds connected components without ever bringing links to
  the driver.
* ``key_of`` gives rows without an id a place of their own: a null ``doc_id``
  is carried as the smallest long and becomes null again in results.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(2**63)
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def key_of(column: str) -> Column:
    """The id as a long, null as NULL_ID."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def id_of(column: str) -> Column:
    """Undoes key_of."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


def carried(carry: list[str]) -> Column:
    """The carried columns as one struct, fl_row: none of their names can
    clash with those that an operator works with."""
    return F.struct(*(F.col(f"`{c}`") for c in carry)).alias("fl_row")


def carried_kind(docs: DataFrame, carry: list[str]) -> str:
    """The type of that struct."""
    return docs.select(carried(carry)).schema[0].dataType.simpleString()


def spread(carry: list[str], results: list[str]) -> list[Column]:
    """The carried columns by themselves again, and the results; a carried
    column with the name of a result gives way to it."""
    taken = {r.lower() for r in results}
    return [*(F.col("fl_row")[c].alias(c) for c in carry if c.lower() not in taken), *(F.col(r) for r in results)]


def whole_rows(docs: DataFrame, *needed: str) -> DataFrame:
    """fl_row with every column, beside those that are needed: what a stage
    hands to an operator when rows must come back as they were."""
    return docs.select(carried(docs.columns), *(F.col(f"`{c}`") for c in needed))


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster. Where the setting is missing, only a
    local master gets one of its own; elsewhere that is an error, since other
    machines could not read it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="frameloom-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _release() -> None:
    """Gives the memory back that this worker has freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library
        pass


def tidy(run: Batches) -> Batches:
    """A function for mapInArrow whose worker, which waits for other tasks
    afterwards, keeps no more memory than it needs."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _release()

    return tidied


def write_whole(df: DataFrame, path: str) -> None:
    """Parquet for rows that hold large binary values: no dictionaries, small
    row groups, so that neither side holds many of them at a time."""
    df.write.mode("overwrite").option("compression", "none").option("parquet.enable.dictionary", "false").option("parquet.block.size", str(16 << 20)).parquet(path)


class Scratch:
    """Tables of one run, below the shared folder. A table that its result
    reads stays until the driver's JVM ends, which then removes it; ``drop``
    and ``close`` remove the others."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.uri = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        store, path = _store(spark, self.uri)
        store.mkdirs(path)
        store.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str, *, whole_values: bool = False) -> DataFrame:
        """Writes df and reads it again: what follows starts from the files."""
        path = f"{self.uri}/{name}"
        if whole_values:
            write_whole(df, path)
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that nothing will read again."""
        for name in names:
            remove(self.spark, f"{self.uri}/{name}")

    def close(self) -> None:
        """Removes all of them."""
        remove(self.spark, self.uri)


def _store(spark: SparkSession, uri: str):
    """Hadoop's file system and path of a URI: any store that Spark knows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, uri: str) -> None:
    store, path = _store(spark, uri)
    store.delete(path, True)


#: Bits of a sketch of ids: 1 MB, whatever the corpus.
MARKS = 1 << 23


def mark(column: str) -> Column:
    """The place of an id in a sketch."""
    return F.pmod(F.xxhash64(column), F.lit(MARKS))


def marks(ids: DataFrame, column: str) -> np.ndarray:
    """A sketch of the ids of a column, gathered as bitmaps of 4 KB: it holds
    all of them and, by chance, few others until it fills up."""
    rows = ids.select((mark(column) + 1).alias("v")).groupBy(F.bitmap_bucket_number("v").alias("g")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).collect()
    out = np.zeros(MARKS // 8, dtype=np.uint8)
    for g, m in rows:
        out[(g - 1) * 4096 : g * 4096] = np.frombuffer(bytes(m), np.uint8)
    return out


def hits(sketch: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places of ids are set."""
    return (sketch[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to about ``most``; each holds an
    element at least, so one very long text makes a range of its own."""
    begin = total = end = 0
    for end, n in enumerate(sizes):
        if end > begin and total + n > most:
            yield begin, end
            begin, total = end, 0
        total += n
    if total or end >= begin:
        yield begin, end + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public murmur3 one), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Forest:
    """Union-find over small dense ids; the smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """True if x and y were apart."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        if x > y:
            x, y = y, x
        self.up[y] = x
        return True


def spanning(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a block: ids by row, a boolean matrix."""
    forest, out = Forest(len(ids)), []
    for x, y in zip(*(a.tolist() for a in np.nonzero(np.triu(linked, 1))), strict=True):
        if forest.join(x, y):
            out.append((int(ids[x]), int(ids[y])))
    return out


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each component of the links within one Arrow batch."""
    for batch in batches:
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(where[: len(a)].tolist(), where[len(a) :].tolist(), strict=True):
            forest.join(x, y)
        roots = np.array([forest.root(x) for x in range(len(nodes))], dtype=np.int64)
        rest = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[roots[rest]]), pa.array(nodes[rest])], ["a", "b"])


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) for every node of ``edges`` (two long columns), comp being
    the smallest node of its component.

    Alternating large and small stars: a node's neighbours move to its
    smallest neighbour until all components are stars, which takes about
    log(nodes) rounds. Each round is two aggregations, whose partial results
    absorb hot nodes, and two joins with what they found. That is written
    first: both sides of a join then come straight from an exchange, and
    adaptive execution splits the rows of a hot node. A round is written to
    the shared folder, and the one before it is removed.
    """
    a, b = edges.columns
    now = scratch.keep(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").mapInArrow(tidy(_contract), "a long, b long"),
        f"{name}-0",
    )
    mark, k = None, 0
    while True:
        new = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(now.select("a", "a")).distinct()
        mark, k = new, k + 1
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-{k}-least")
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        large = scratch.keep(large, f"{name}-{k}-large")
        least = scratch.keep(large.groupBy("b").agg(F.min("a").alias("m")), f"{name}-{k}-down")
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a <> b").distinct()
        now = scratch.keep(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        for part in ("large", "least", "down"):
            scratch.drop(f"{name}-{k}-{part}")


def joined_by_id(labelled: DataFrame, key: str, label: str, scratch: Scratch) -> DataFrame:
    """Labels become one, the smallest, where rows of one key have several.
    (Those of a null key need none of that: it is the smallest of its label.)"""
    several = labelled.groupBy(key).agg(F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo < hi")
    several = scratch.keep(several.select(key, "lo"), "several")
    if several.isEmpty():
        return labelled
    same = labelled.join(several, key).select("lo", label).filter(f"lo <> {label}").distinct()
    merged = components(same, scratch, "ids")
    out = labelled.join(merged, labelled[label] == merged["node"], "left")
    return out.select(*(F.coalesce("comp", label).alias(c) if c == label else F.col(c) for c in labelled.columns))
