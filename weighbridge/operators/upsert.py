"""Insert, upsert and retention over versioned rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weighbridge.functions.values import before, correlation_id, derived_id
from weighbridge.operators.skew import cut_lineage, cut_to_files, join_heaviest_first
from weighbridge.schemas import ARRIVAL_COLUMNS, KEY_COLUMNS, MEASURE_COLUMNS

# Keys that are broadcast rather than joined by a shuffle; a fixed number, whatever the data.
MOST_TOLD = 100_000


def file_id(file_sha256: Column) -> Column:
    """Id of a file row; known before the insert, so nothing is looked up."""
    return derived_id(file_sha256)


def transaction_id(keys: list[str] = KEY_COLUMNS) -> Column:
    return derived_id(*[F.col(k) for k in keys])


def insert_file_lookup_id(files: DataFrame) -> DataFrame:
    """File rows with the id that an insert followed by a lookup by hash would give."""
    return files.withColumn("id", file_id(F.col("file_sha256")))


def rows_with_file_id(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Rows of the files given, each with its file's id."""
    return rows.join(files.select(key, F.col("id").alias("ingestion_file_id")), key)


def upsert_latest(
    versions: DataFrame,
    keys: list[str] = KEY_COLUMNS,
    order: list[str] = ARRIVAL_COLUMNS,
    measures: list[str] = [*MEASURE_COLUMNS, "ingestion_file_id"],  # noqa: B006
    committed_at: str | None = "committed_at",
) -> DataFrame:
    """Current row per key: measures of the last arrival, birth date of the first.

    The latest version is the maximum of (order, measures), an aggregate that each task
    applies to its own rows first, so a key with very many versions does not gather in
    one task. Id and correlation id come from the key and so survive every update.
    """
    latest = F.max(F.struct(*order, *[m for m in measures if m not in order]))
    times = []
    if committed_at:
        times = [
            F.min(committed_at).alias("created_at"),
            touch_updated_at(F.col(committed_at)).alias("updated_at"),
        ]
    current = versions.groupBy(*keys).agg(latest.alias("_latest"), *times)
    return current.select(
        transaction_id(keys).alias("id"),
        *keys,
        *[F.col(f"_latest.{m}").alias(m) for m in measures],
        correlation_id(*[F.col(k) for k in keys]).alias("correlation_id"),
        *[c for c in ("created_at", "updated_at") if times],
    )


def touch_updated_at(committed_at: Column) -> Column:
    """Time of the last commit that touched the row."""
    return F.max(committed_at)


def upsert_counts(versions: DataFrame, file_key: str, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """Stored rows touched by each file: a key counts once per file."""
    return versions.groupBy(file_key).agg(F.count_distinct(*keys).alias("rows_touched"))


def accept_whole_files(
    rows: DataFrame,
    file_key: str,
    order: list[str],
    keys: list[str],
    stored: DataFrame | None = None,
) -> DataFrame:
    """Files that a plain insert keeps: none of a file's rows may meet a stored key.

    Files are decided in arrival order, and only accepted files store keys. A key that one
    file alone claims blocks nobody, so only contested keys enter the waves, and a file without
    any is accepted at once. Each wave decides every file that is the first remaining claimant
    of all its keys, then refuses the later claimants of those keys. The first remaining file
    is always decided, so the waves end, with the answer of the one-by-one insert. Claims with a
    missing key or file are no claims; a file that has no other is not kept.
    """
    own = list(dict.fromkeys([file_key, *order, *keys]))
    claims = cut_to_files(rows.groupBy(*own).agg(F.count("*").alias("_times")))
    refused = claims.filter(F.col("_times") > 1).select(file_key)
    if stored is not None:
        refused = refused.union(claims.join(stored.select(*keys), keys, "left_semi").select(file_key))
    live = claims.dropna(subset=[file_key, *keys]).drop("_times")
    live = live.join(_told_to_all(refused.distinct()), file_key, "left_anti")
    # Two keys of one hash only send more claims to the waves, which compare the keys themselves.
    hashed = F.xxhash64(*keys).alias("_hash")
    contested = live.groupBy(hashed).agg(F.count("*").alias("_claimants")).filter(F.col("_claimants") > 1)
    picked = live.withColumn("_hash", hashed).join(_told_to_all(contested.select("_hash")), "_hash", "left_semi")
    open_claims = cut_to_files(picked.drop("_hash"))
    accepted = [live.select(file_key).distinct().join(open_claims.select(file_key).distinct(), file_key, "left_anti")]
    arrival = list(dict.fromkeys([*order, file_key]))
    while not open_claims.isEmpty():
        first = open_claims.groupBy(*keys).agg(
            F.min(F.struct(*arrival)).alias("first"), F.count("*").alias("claimants")
        )
        seen = join_heaviest_first(open_claims, first, keys, "claimants", [F.col(file_key)])
        claimed = cut_lineage(
            seen.select(*open_claims.columns, F.col(f"found.first.{file_key}").alias("_holder"))
        )
        late = F.col("_holder") != F.col(file_key)
        state = claimed.groupBy(file_key).agg(F.max(late).alias("_blocked"))
        winners = cut_lineage(state.filter(~F.col("_blocked")).select(file_key))
        accepted.append(winners)
        losers = (
            claimed.filter(late)
            .join(winners.select(F.col(file_key).alias("_holder")), "_holder", "left_semi")
            .select(file_key)
        )
        waiting = state.filter("_blocked").select(file_key).join(losers.distinct(), file_key, "left_anti")
        open_claims = cut_lineage(claimed.drop("_holder").join(waiting, file_key, "left_semi"))
    return reduce(DataFrame.union, accepted)


def _told_to_all(few: DataFrame) -> DataFrame:
    """One column of keys, written once; broadcast if they are few, so that what meets them is not shuffled."""
    written = cut_to_files(few)
    return F.broadcast(written) if written.count() <= MOST_TOLD else written


def insert_only_unique(
    rows: DataFrame,
    file_key: str,
    order: list[str],
    keys: list[str] = KEY_COLUMNS,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Rows that a plain insert stores, whole file by whole file."""
    kept = accept_whole_files(rows, file_key, order, keys, stored)
    return rows.join(kept, file_key, "left_semi").select(*rows.columns)


def first_n_rows(rows: DataFrame, file_key: str, order: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows of each file; every task keeps at most ``n`` of a file to shuffle."""
    rank = F.row_number().over(Window.partitionBy(file_key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def retention_cleanup(files: DataFrame, as_of: Column, days_old: int = 30) -> DataFrame:
    """Files that remain when finished files older than ``days_old`` days go."""
    finished = F.col("status").isin("COMPLETED", "FAILED")
    old = F.col("created_at") < before(as_of, days=days_old)
    return files.filter(~F.coalesce(finished & old, F.lit(False)))


def cascade_delete(rows: DataFrame, surviving: DataFrame, row_key: str, file_key: str) -> DataFrame:
    """Rows whose file survives."""
    return rows.join(
        surviving.select(F.col(file_key).alias(row_key)), row_key, "left_semi"
    ).select(*rows.columns)
