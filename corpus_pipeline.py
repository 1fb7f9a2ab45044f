"""A corpus from raw documents to training ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's documents:

1. language: documents in no language that was learned (``und``: no letters)
   go; a missing label is filled with the prediction;
2. lines: lines that three documents or more share stay in one of them;
3. near duplicates: the smallest document of each class stays;
4. mix: documents in the order in which the sources' shares follow their
   target weights; none is dropped;
5. ids: byte-level BPE ids of each text, proven by decoding.

All but the last return the columns they were given, which may have any names
beside those of ``documents``: whole rows travel as one struct. Rows that share
a doc_id are one document, and so are the rows without one; stages 2 and 3 keep
or drop all of them. Empty tables pass all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm import bpe, common, lang_id, line_dedup, minhash, mixing

#: Target shares of the sources; those not named have a weight of 1 each.
WEIGHTS = {"src0": 5, "src1": 3, "src2": 2}


#: Rows of an Arrow batch, at most: texts are long, and workers and JVMs keep the room that a batch once took.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    """Lowers the session's batch size; what runs in the stages reads it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def _columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of docs out of fl_row, but for those that are changed."""
    return [changed[c].alias(c) if c in changed else F.col("fl_row")[c].alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = lang_id.language_id(common.whole_rows(docs, "doc_id", "text", "lang"), carry=["fl_row"])
    return found.filter(F.col("fl_lang") != lang_id.UNKNOWN).select(*_columns(docs, lang=F.coalesce(F.col("fl_row")["lang"], "fl_lang")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    rest = docs.drop("text")
    rows = docs.select(common.carried(rest.columns), "doc_id", "text")
    found = line_dedup.line_dedup(rows, carry=["fl_row"])
    changed = {"text": F.col("fl_kept")}
    if "n_chars" in rest.columns:
        changed["n_chars"] = F.char_length("fl_kept").cast(docs.schema["n_chars"].dataType)
    return found.select(*_columns(docs, **changed))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    # The documents that go are the fewer; their ids alone decide. Rows of one id are one document, so all stay or go.
    found = minhash.near_duplicates(docs).filter("doc <> class_id").select(F.col("doc").alias("fl_gone")).distinct()
    gone = common.Scratch(spark, "gone").keep(found, "ids")
    return docs.join(gone, common.key_of("doc_id") == gone["fl_gone"], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = mixing.mix(common.whole_rows(docs, "doc_id", "text", "source"), WEIGHTS, carry=["fl_row"])
    return found.repartitionByRange("fl_position").sortWithinPartitions("fl_position").select(*_columns(docs))


def ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("ids", ids)]

#: Language models and MinHash classes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents``."""
    scratch, before = common.Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
