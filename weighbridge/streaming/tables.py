"""Streams over table-shaped input: de-duplication, activity, KPIs, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weighbridge.functions.values import sha256_hex
from weighbridge.operators import reports
from weighbridge.sources.landing import run_once


def stream_file_dedup(files: DataFrame, late: str | None = None) -> DataFrame:
    """First arrival of each content hash.

    Without ``late`` every hash is remembered, as exact de-duplication asks; state is one
    hash per file. With ``late`` (and a watermark on the input) only hashes within that
    delay are.
    """
    hashed = files.withColumn("file_sha256", sha256_hex(F.col("content"))).drop("content")
    if late is None:
        return hashed.dropDuplicates(["file_sha256"])
    return hashed.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["file_sha256"])


def _overwrite(folder: str):
    def run(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(folder)

    return run


def stream_hourly_activity(files: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Keeps the hourly counts; each micro-batch replaces the snapshot in ``folder``."""
    counts = reports.hourly_counts(files)
    writer = counts.writeStream.outputMode("complete").foreachBatch(_overwrite(folder))
    return run_once(writer, checkpoint)


def append_batches(folder: str, then=None):
    """foreachBatch function that keeps each micro-batch under its id, then calls ``then``."""

    def run(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        if then is not None:
            then(df.sparkSession, batch_id)

    return run


def stream_kpis(files: DataFrame, rows_folder: str | None, folder: str, checkpoint: str, as_of: str | None) -> StreamingQuery:
    """Keeps the file table and renews a snapshot of the dashboard after each micro-batch.

    Snapshots land under ``folder``: one parquet table per report.
    """

    def renew(spark, batch_id: int) -> None:
        known = spark.read.parquet(f"{folder}/files")
        snapshots = {
            "file_kpis": reports.file_kpis(known),
            "recent_files": reports.recent_files(known, as_of),
            "daily_performance": reports.daily_performance(known, as_of),
        }
        if rows_folder is not None:
            rows = spark.read.parquet(rows_folder)
            snapshots["transaction_kpis"] = reports.transaction_kpis(rows, as_of)
            snapshots["scale_leaderboard"] = reports.scale_leaderboard(rows)
            snapshots["leaderboard_top10"] = reports.leaderboard_top10(rows)
        for name, snapshot in snapshots.items():
            snapshot.write.mode("overwrite").parquet(f"{folder}/{name}")

    writer = files.writeStream.foreachBatch(append_batches(f"{folder}/files", renew))
    return run_once(writer, checkpoint)


def stream_upsert(versions: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends the versions of each micro-batch; the current view is ``upsert_latest``."""
    return run_once(versions.writeStream.foreachBatch(append_batches(folder)), checkpoint)
