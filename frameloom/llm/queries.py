"""The queries of this subpackage, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common, embed_dedup, lang_id, line_dedup, minhash, mixing, pii, quality, token_counts, token_files
from .oracles import oracle_sql  # noqa: F401  (part of this module's contract)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = f"{common.Scratch(spark, 'op1').uri}/shards"
    token_files.write_token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), uri)
    return token_files.read_token_files(spark, uri)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(*(common.id_of(c).alias(n) for c, n in (("doc", "doc_id"), ("copy_of", "copy_of"), ("class_id", "class_id"))), (F.col("doc") == F.col("class_id")).alias("kept"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = token_counts.histogram(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.limits(common.Scratch(spark, "op4").keep(hist, "histogram"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("fl_n_lines").alias("n_lines"), F.col("fl_n_dropped").alias("n_dropped"), F.sha2("fl_kept", 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_id.language_id(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("fl_held_out").alias("held_out"), F.col("fl_lang").alias("lang_pred"), F.col("fl_score").alias("score"))


#: Target shares of the sources; those not named have a weight of 1 each.
WEIGHTS = {"src0": 5, "src1": 3, "src2": 2}


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS)
    return found.select("doc_id", "source", *(F.col(f"fl_{c}").alias(c) for c in ("block", "slot", "position")))


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.apply_policies(quality.ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(quality.BASE)) != 0
    return found.select("doc_id", *quality.MEASURES, "failed", *(f"kept_{p.version}" for p in quality.POLICIES), base.alias("base_failed"), (~base & quality.passes(quality.POLICIES[-1])).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed_dedup.embedding_links(table(spark, sf_dir, "embeddings"))
    return found.select(common.id_of("vec").alias("vec_id"), "n_links", common.id_of("component").alias("component_id"), (F.col("vec") == F.col("component")).alias("kept"))


#: Stands for the secret that a real run passes to pii.pseudonymise.
SURROGATE_KEY = "a fixed key, so that runs can be compared"


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", F.col("fl_clean").alias("text"), *(F.col(f"fl_{k}").alias(f"n_{k}") for k in pii.KINDS))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_minhash": op2_minhash,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_token_counts": op4_token_counts,
        "op5_line_dedup": op5_line_dedup,
        "op6_language_id": op6_language_id,
        "op7_source_mix": op7_source_mix,
        "op8_quality_ledger": op8_quality_ledger,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_pii_surrogates": op10_pii_surrogates,
    }
