"""Token counts by an exact length histogram.

Documents are aggregated by encoded length, first within each Arrow batch and
then by Spark, so what moves is one row for each length. Suffix sums over the
histogram then answer totals, quantiles and truncated totals for every context
limit without another look at the texts. The sums are taken in two levels,
within blocks of lengths and over the blocks, so no task sees all lengths.

Null and empty texts count as documents of 0 tokens. Repeated rows count each
time. Texts are encoded whole, however long. An empty table has an empty
histogram. Columns other than text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .subwords import encoder

BLOCK = 1024


def histogram(docs: DataFrame, tokenizer: str, *, end_tokens: int = 0) -> DataFrame:
    """(length, n_docs): documents by their number of ids, ``end_tokens``
    added to each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = Counter(len(code) // enc.wide + end_tokens for code in enc.encode_all(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_pydict({"length": pa.array(n.keys(), pa.int64()), "n": pa.array(n.values(), pa.int64())})

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "length long, n long")
    return found.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """What each context limit means: one row for each length that occurs.

    context_limit, n_docs (of just that length), docs_reaching and
    tokens_reaching (documents at least that long), total_tokens, kept_tokens
    (if longer ones are cut there), lost_tokens, quantile (share of documents
    that fit).
    """
    rows = hist.withColumns({"block": F.floor(F.col("length") / BLOCK), "tokens": F.col("length") * F.col("n_docs")})
    last = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(last), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(last), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(whole).alias("all_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    here = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = rows.join(blocks, "block").select(
        F.col("length").alias("context_limit"),
        "n_docs",
        (F.sum("n_docs").over(here) + F.col("docs_after")).alias("docs_reaching"),
        (F.sum("tokens").over(here) + F.col("tokens_after")).alias("tokens_reaching"),
        "all_docs",
        "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("tokens_reaching") + F.col("context_limit") * F.col("docs_reaching")
    return reach.select(
        "context_limit",
        "n_docs",
        "docs_reaching",
        "tokens_reaching",
        "total_tokens",
        kept.alias("kept_tokens"),
        (F.col("total_tokens") - kept).alias("lost_tokens"),
        ((F.col("all_docs") - F.col("docs_reaching") + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def totals_at(hist: DataFrame, at: list[int]) -> DataFrame:
    """(context_limit, kept_tokens, docs_cut) for any limits, one pass over
    the histogram."""
    n = F.col("n_docs")
    cut = hist.agg(*(F.struct(F.lit(k).cast("long").alias("context_limit"), F.coalesce(F.sum(F.least("length", F.lit(k)) * n), F.lit(0)).alias("kept_tokens"), F.coalesce(F.sum(F.when(F.col("length") > k, n)), F.lit(0)).alias("docs_cut")).alias(f"x{i}") for i, k in enumerate(at)))
    return cut.select(F.explode(F.array(*(f"x{i}" for i in range(len(at))))).alias("x")).select("x.*")


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the
    documents doesn't exceed."""
    at = limits(hist)
    out = at.agg(*(F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("context_limit"))).alias("length")).alias(f"x{i}") for i, q in enumerate(shares)))
    return out.select(F.explode(F.array(*(f"x{i}" for i in range(len(shares))))).alias("x")).select("x.*")
