"""The queries of the training-data operators over the whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.llm import (
    hard_negatives,
    hnsw,
    language,
    packing,
    pii,
    prefix_bpe,
    recompression,
    risk_rules,
    rule_ensemble,
    sharding,
    simhash,
    spelling,
    token_files,
)
from finledger.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def find_package(spark: SparkSession) -> None:
    """Lets Python workers that do not start in the repository's folder import the package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        find_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.remove_repeats(read_table(spark, folder, "documents"))


@query
def op2_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        read_table(spark, folder, "documents"), WORD_TOKENIZER, with_ids=False
    )


@query
def op3_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_vectors(read_table(spark, folder, "embeddings"))


@query
def op4_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"), shards=24)


@query
def op5_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.score_documents(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


@query
def op6_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_bpe.encode_documents(
        read_table(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN, digests=True
    )


@query
def op7_risk_rules(spark: SparkSession, folder: str) -> DataFrame:
    return risk_rules.judge_documents(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


@query
def op8_crf_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_in_documents(read_table(spark, folder, "documents"))


@query
def op9_simhash_variants(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@query
def op10_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(spark, read_table(spark, folder, "documents"), BYTE_TOKENIZER)


@query
def op11_ppm_languages(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(read_table(spark, folder, "documents"))


@query
def op12_dense_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, folder, "documents"), altered_every=31)


@query
def op13_l2ap_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


SQL["op13_l2ap_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor, other, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor = n.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
