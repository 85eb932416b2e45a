"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weighbridge.llm import bpe, exact_dedup, jaccard_join, packing, quality, resampling, secret_scan, sharding
from weighbridge.llm import simhash, suffix_dedup, toxicity, tree_search, vector_codes
from weighbridge.llm.common import text_of

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 40

# The operator draws a uniform shuffle whose shards' row counts are at most one apart.
LAW = "rows"
# Bytes that a row takes besides its text.
ROW_BYTES = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir))


def op3_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return tree_search.nearest(vectors, F.col("vec_id") % tree_search.QUERY_STEP == 0)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of("text").cast("binary")
    rows = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
    )
    return sharding.shuffle_to_shards(rows, SHARDS).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.scored(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(_documents(spark, sf_dir), TOKENIZER)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(_documents(spark, sf_dir), TOKENIZER)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(_documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_documents(spark, sf_dir))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(_documents(spark, sf_dir))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_simhash_dedup, op3_tree_search, op4_sharding, op5_quality, op6_packing, op7_bpe,
        op8_toxicity, op9_secrets, op10_suffix_dedup, op11_jaccard_join, op12_resampling, op13_vector_codes,
    )
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
from texts window same as (partition by t)
""",
}
