"""Joins and cut points that hold when one key owns a large share of the rows."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# At most 1/HOT_KEYS of all rows can share a key that is not among the HOT_KEYS heaviest.
HOT_KEYS = 1000
SALTS = 256


def join_heaviest_first(
    rows: DataFrame, lookup: DataFrame, keys: list[str], weight: str, spread: list[Column]
) -> DataFrame:
    """Left join of skewed rows with a lookup that has one row per key.

    ``weight`` is the lookup's count of rows per key. The HOT_KEYS heaviest lookup rows
    are broadcast (a fixed number, whatever the data). Rows they answer then ride
    through the shuffled join under a salt made from ``spread``, matching nothing; the
    others meet the rest of the lookup under their key. The lookup is read by both joins
    and so written once. Adds the column ``found``, a struct of the lookup's other columns,
    NULL where the key is absent.
    """
    fields = [c for c in lookup.columns if c not in keys]
    packed = cut_lineage(
        lookup.select(*keys, F.col(weight).alias("_weight"), F.struct(*fields).alias("_found"))
    )
    hot = packed.orderBy(F.desc("_weight"), *keys).limit(HOT_KEYS).select(
        *keys, F.col("_found").alias("_hot")
    )
    marked = rows.join(F.broadcast(hot), keys, "left")
    answered = F.col("_hot").isNotNull()
    salted = marked.select(
        "*",
        *[F.when(~answered, F.col(k)).alias(f"_k_{k}") for k in keys],
        F.when(answered, F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(0).alias("_salt"),
    )
    # Always 0, but computed: a literal would be folded out of the join keys, and with it
    # the salt out of the partitioning.
    no_salt = F.pmod(F.xxhash64(*keys), F.lit(1))
    rest = packed.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_found"), no_salt.alias("_salt")
    )
    joined = salted.join(rest, [*[f"_k_{k}" for k in keys], "_salt"], "left")
    return joined.select(*rows.columns, F.coalesce("_hot", "_found").alias("found"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's own setting. A temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weighbridge-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Rows written to the shared checkpoint folder and read back from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_to_files(df: DataFrame) -> DataFrame:
    """Like ``cut_lineage``, for large results: compressed columns, where a checkpoint keeps plain rows."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/weighbridge/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
