"""Training corpus from raw documents: five operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Between
stages the rows are written as Parquet and read again. All but the last return the columns of
``docs``, whatever others there are besides doc_id and text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weighbridge.llm import exact_dedup, packing, quality, secret_scan, simhash
from weighbridge.llm.common import bounded_batches, staged

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_rows(docs, quality.fit(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_kept(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked."""
    return simhash.near_kept(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked. A column n_chars is brought up to date."""
    bounded_batches(spark)
    masked = docs.withColumn("text", secret_scan.mask_secrets("text"))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as ``packing.packed`` describes them."""
    return packing.packed_documents(docs, TOKENIZER)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

# A trained classifier, fingerprints and byte-pair encoding are beyond SQL; the stages are
# tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
