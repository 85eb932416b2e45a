"""Outcome of each file and each message, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.operators.structure import unreadable
from weighbridge.schemas import DUPLICATES, FAILED, INBOX, PROCESSED

# Messages of a failed file.
STRUCTURE_PREFIX = "File validation failed: "
NO_VALID_ROWS = "No valid transactions found in CSV"


def row_counts(rows: DataFrame, file_key: list[str]) -> DataFrame:
    """Per file: good rows, bad rows, and where its rows start."""
    bad = F.col("error_rule").isNotNull()
    starts = [F.min("row_seq").alias("first_seq")] if "row_seq" in rows.columns else []
    return rows.groupBy(*file_key).agg(
        F.count_if(~bad).alias("valid_count"), F.count_if(bad).alias("error_count"), *starts
    )


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def file_outcome_lenient(files: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """Status and error of each file when good rows of a bad file are kept.

    ``files`` has ``structure_errors``; a file without rows is absent from ``counts``.
    """
    broken = F.size("structure_errors") > 0
    empty = _count("valid_count") == 0
    return files.join(counts, key, "left").select(
        *files.columns,
        _count("valid_count").alias("valid_count"),
        _count("error_count").alias("error_count"),
        F.when(broken | empty, "FAILED").otherwise("COMPLETED").alias("status"),
        F.when(broken, F.concat(F.lit(STRUCTURE_PREFIX), F.array_join("structure_errors", "; ")))
        .when(empty, NO_VALID_ROWS)
        .alias("error"),
    )


def file_outcome_strict(files: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """Outcome of each file when one bad row refuses the file.

    COMPLETED files get a file row, also with no rows; REJECTED and UNREADABLE ones none.
    """
    return files.join(counts, key, "left").select(
        *files.columns,
        _count("valid_count").alias("valid_count"),
        _count("error_count").alias("error_count"),
        F.when(unreadable(F.col("structure_errors")), "UNREADABLE")
        .when(_count("error_count") > 0, "REJECTED")
        .otherwise("COMPLETED")
        .alias("outcome"),
    )


def file_outcome_sample(files: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """Outcome of each file when any parsed file counts as done."""
    return files.join(counts, key, "left").select(
        *files.columns,
        _count("valid_count").alias("valid_count"),
        _count("error_count").alias("error_count"),
        F.when(unreadable(F.col("structure_errors")), "UNREADABLE").otherwise("COMPLETED").alias("outcome"),
    )


def status_transitions(files: DataFrame, started: Column, completed: Column) -> DataFrame:
    """File rows with both processing times; NEW and PROCESSING files lack later ones."""
    begun = F.col("status").isin("PROCESSING", "COMPLETED", "FAILED")
    ended = F.col("status").isin("COMPLETED", "FAILED")
    started_at, completed_at = F.when(begun, started), F.when(ended, completed)
    return files.select(
        *files.columns,
        started_at.alias("processing_started_at"),
        completed_at.alias("processing_completed_at"),
        F.coalesce(completed_at, started_at, F.col("created_at")).alias("updated_at"),
    )


def disposition_lenient(messages: DataFrame, attachments: DataFrame) -> DataFrame:
    """Folder of each message: read and with a CSV file means done, whatever became of it.

    ``messages`` has ``path``, ``message_id`` and ``read_error``.
    """
    counts = attachments.groupBy("path").agg(F.count("*").alias("files"))
    broken, none = F.col("read_error").isNotNull(), F.col("files").isNull()
    return messages.join(counts, "path", "left").select(
        "message_id",
        "path",
        F.when(broken | none, FAILED).otherwise(PROCESSED).alias("folder"),
        F.when(broken, F.col("read_error")).when(none, "no CSV attachment").alias("reason"),
    )


def disposition_strict(messages: DataFrame, first_files: DataFrame) -> DataFrame:
    """Folder of each message from the outcome of its first CSV file.

    ``first_files`` has one row per message: ``path``, ``status`` (NEW or DUPLICATE),
    ``outcome`` and ``valid_count``.
    """
    decided = messages.join(
        first_files.select("path", "status", "outcome", "valid_count"), "path", "left"
    )
    outcome = F.col("outcome")
    no_file = F.col("read_error").isNotNull() | outcome.isNull()
    return decided.select(
        "message_id",
        "path",
        F.when(no_file, INBOX)
        .when(F.col("status") == "DUPLICATE", DUPLICATES)
        .when(outcome == "UNREADABLE", INBOX)
        .when(outcome == "REJECTED", FAILED)
        .when(F.col("valid_count") == 0, INBOX)
        .otherwise(PROCESSED)
        .alias("folder"),
        F.when(F.col("read_error").isNotNull(), F.col("read_error"))
        .when(outcome.isNull(), "no CSV attachment")
        .when(F.col("status") == "DUPLICATE", "duplicate file")
        .when(outcome == "UNREADABLE", "structure error")
        .when(outcome == "REJECTED", "row errors")
        .when(F.col("valid_count") == 0, "no rows")
        .alias("reason"),
    )


def disposition_counts(dispositions: DataFrame) -> DataFrame:
    return dispositions.groupBy("folder").agg(F.count("*").alias("messages"))
