"""One ingestion batch: files in, five tables out, under one of three policies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.functions.values import as_of_time, correlation_id, default_source
from weighbridge.operators import outcome
from weighbridge.operators.dedup import HASH, dedup_files_in_batch, dedup_files_in_history, duplicate_verdict
from weighbridge.operators.rows import (
    VALUE_COLUMNS,
    normalize_rows,
    quarantine,
    row_error_message,
    valid_part,
)
from weighbridge.operators.skew import join_heaviest_first
from weighbridge.operators.structure import file_inventory, unreadable
from weighbridge.operators.upsert import file_id, first_n_rows, insert_only_unique, transaction_id
from weighbridge.schemas import INBOX, KEY_COLUMNS, PROCESSED
from weighbridge.sources import landing, mail
from weighbridge.sources.tables import BATCH_JOB, Store

FILE_KEY = ["path", "part_index"]
RowReader = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Policy:
    """``keep_good_rows``: a bad row does not refuse its file. ``plain_insert``: a key that
    is already stored refuses the rows of the file. ``first_rows``: rows taken per file."""

    name: str
    keep_good_rows: bool
    plain_insert: bool
    first_rows: int | None = None


LENIENT = Policy("lenient", keep_good_rows=True, plain_insert=False)
STRICT = Policy("strict", keep_good_rows=False, plain_insert=True)
SAMPLE = Policy("sample", keep_good_rows=True, plain_insert=True, first_rows=10)


def _now(as_of: str | None) -> str:
    return as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def _outcomes(policy: Policy, files: DataFrame, counts: DataFrame) -> DataFrame:
    """Outcome per new file, in the words of the status domain.

    ``kept`` says whether the file gets a file row.
    """
    if policy is LENIENT:
        judged = outcome.file_outcome_lenient(files, counts, FILE_KEY)
        return judged.withColumn("outcome", F.col("status")).withColumn("kept", F.lit(True))
    judge = outcome.file_outcome_strict if policy is STRICT else outcome.file_outcome_sample
    judged = judge(files, counts, FILE_KEY)
    done = F.col("outcome") == "COMPLETED"
    why = F.when(F.col("outcome") == "UNREADABLE", F.array_join("structure_errors", "; ")).when(
        F.col("outcome") == "REJECTED", F.format_string("%d row errors", "error_count")
    )
    return judged.select(
        "*", F.when(done, "COMPLETED").otherwise("FAILED").alias("status"), why.alias("error"), done.alias("kept")
    )


def ingest_files(
    store: Store,
    batch_id: int,
    files: DataFrame,
    read_rows: RowReader,
    policy: Policy = LENIENT,
    as_of: str | None = None,
    messages: DataFrame | None = None,
    retry_failed: bool = False,
    writer: str = BATCH_JOB,
    writer_batch: int | None = None,
) -> None:
    """Ingests one batch of arrivals (``schemas.ARRIVALS``) into the store.

    The inventory and the parsed rows are written once to the shared folder; everything
    after reads those, so neither files nor cells are read twice and a lost executor
    costs one task. Files are joined to rows by path only where a small side is at hand.
    """
    now = as_of_time(_now(as_of))
    inventory = store.stage("inventory", batch_id, file_inventory(files).drop("header", "valid_utf8", "missing"))
    history = store.read_before("ingestion_files", batch_id).select(HASH, "id", "status")

    new_files = store.stage(
        "new_files", batch_id, dedup_files_in_history(dedup_files_in_batch(inventory), history, retry_failed)
    )
    broken = unreadable(F.col("structure_errors"))
    # The scan of the rows also meets the files that are not wanted, so all widths count.
    widest = F.lit(inventory.agg(F.max("widest")).first()[0]).cast("bigint").alias("widest")
    to_read = new_files.filter(~broken).select(*FILE_KEY, "received_at", HASH, "names", widest)
    rows = store.stage("rows", batch_id, normalize_rows(read_rows(to_read)))

    counts = store.stage("counts", batch_id, outcome.row_counts(rows, FILE_KEY))
    outcomes = store.stage("outcomes", batch_id, _outcomes(policy, new_files, counts))

    _write_files(store, batch_id, outcomes, now)
    _write_transactions(store, batch_id, policy, rows, outcomes, now)
    _write_row_errors(store, batch_id, rows, counts)
    judged = _arrivals(policy, inventory, history, outcomes, retry_failed)
    if messages is not None:
        _write_dispositions(store, batch_id, policy, messages, judged)
    store.write("file_arrivals", batch_id, judged.withColumn("created_at", now))
    store.commit(batch_id, writer, writer_batch)


def _write_files(store: Store, batch_id: int, outcomes: DataFrame, now: Column) -> None:
    kept = outcomes.filter("kept").select(
        file_id(F.col(HASH)).alias("id"),
        default_source(F.col("source")).alias("source"),
        "message_id", "from_email", "subject", "received_at", "filename", HASH, "status", "error",
        correlation_id(F.col("path")).alias("correlation_id"),
        now.alias("created_at"),
    )
    store.write("ingestion_files", batch_id, outcome.status_transitions(kept, now, now))


def _write_transactions(
    store: Store, batch_id: int, policy: Policy, rows: DataFrame, outcomes: DataFrame, now: Column
) -> None:
    good = valid_part(rows)
    if policy is STRICT:
        kept = outcomes.filter("kept").select(*FILE_KEY)
        good = good.join(kept, FILE_KEY, "left_semi")
    if policy.first_rows:
        good = first_n_rows(good, HASH, ["row_seq"], policy.first_rows)
    if policy.plain_insert:
        stored = store.read_before("scale_transactions", batch_id).select(*KEY_COLUMNS).distinct()
        good = insert_only_unique(good, HASH, ["received_at", *FILE_KEY], KEY_COLUMNS, stored)
    versions = good.select(
        transaction_id().alias("id"), *VALUE_COLUMNS,
        file_id(F.col(HASH)).alias("ingestion_file_id"), HASH,
        correlation_id(*[F.col(k) for k in KEY_COLUMNS]).alias("correlation_id"),
        "received_at", *FILE_KEY, "row_seq", now.alias("committed_at"),
    )
    store.write("scale_transactions", batch_id, versions)


def _write_row_errors(store: Store, batch_id: int, rows: DataFrame, counts: DataFrame) -> None:
    bad = quarantine(rows).join(counts.select(*FILE_KEY, "first_seq"), FILE_KEY)
    number = F.col("row_seq") - F.col("first_seq") + 1
    errors = bad.select(
        HASH, "path", number.alias("row_number"), "row_error.field", "row_error.code",
        row_error_message(number, F.col("row_error")).alias("message"), "row_error.raw_value",
    )
    store.write("row_errors", batch_id, errors)


def _arrivals(
    policy: Policy, inventory: DataFrame, history: DataFrame, outcomes: DataFrame, retry_failed: bool
) -> DataFrame:
    """Every arrival with its verdict: the file's own outcome, or DUPLICATE and of what.

    Copies of a file that leaves no file row are no duplicates: each gets the outcome
    that it would get alone.
    """
    verdict = duplicate_verdict(inventory, history, retry_failed=retry_failed).drop("names", "structure_errors", "widest")
    results = outcomes.select(
        HASH, F.col("status").alias("_status"), F.col("error").alias("_error"), "outcome", "valid_count", "kept"
    )
    # One row per hash on both sides here; the arrivals of one hash may be very many.
    lookup = inventory.groupBy(HASH).agg(F.count("*").alias("copies")).join(results, HASH)
    joined = join_heaviest_first(verdict, lookup, [HASH], "copies", [F.col(c) for c in FILE_KEY])
    joined = joined.select(*verdict.columns, *[F.col(f"found.{c}") for c in results.columns if c != HASH])
    own = (F.col("status") == "NEW") | ~F.coalesce(F.col("kept"), F.lit(True))
    return joined.select(
        *[c for c in verdict.columns if c not in ("status", "original_id", "original_status")],
        F.when(own, F.col("_status")).otherwise("DUPLICATE").alias("status"),
        F.when(own, F.col("_error")).alias("error"),
        F.when(~own, F.col("original_id")).alias("original_id"),
        F.when(~own, F.coalesce("_status", "original_status")).alias("original_status"),
        "outcome", "valid_count",
    )


def _write_dispositions(
    store: Store, batch_id: int, policy: Policy, messages: DataFrame, judged: DataFrame
) -> None:
    if policy is LENIENT:
        where = outcome.disposition_lenient(messages, judged)
    elif policy is STRICT:
        first = judged.filter(F.col("part_index") == 0).withColumn(
            "outcome", F.coalesce("outcome", F.lit("COMPLETED"))
        )
        where = outcome.disposition_strict(messages, first)
    else:
        read = judged.select("path", "outcome").filter(F.coalesce("outcome", F.lit("")) != "UNREADABLE")
        done = messages.join(read, "path", "left_semi").select("path", F.lit(PROCESSED).alias("_done"))
        where = messages.join(done, "path", "left").select(
            "message_id", "path", F.coalesce("_done", F.lit(INBOX)).alias("folder"),
            F.when(F.col("_done").isNull(), "no readable CSV attachment").alias("reason"),
        )
    store.write("dispositions", batch_id, where)


def ingest_landing(
    store: Store, folder: str, policy: Policy = LENIENT, as_of: str | None = None,
    batch_id: int | None = None, retry_failed: bool = False,
) -> int:
    """Ingests everything that lies in a folder as one batch; returns the batch id."""
    spark = store.spark
    batch_id = store.next_batch_id() if batch_id is None else batch_id
    files = landing.landing_files(spark, folder).union(landing.empty_landing_files(spark, folder))
    ingest_files(
        store, batch_id, files, lambda wanted: landing.rows_by_name(spark, folder, wanted),
        policy, as_of, retry_failed=retry_failed,
    )
    return batch_id


def ingest_mail(
    store: Store, messages: DataFrame, policy: Policy = LENIENT, as_of: str | None = None,
    batch_id: int | None = None, sender: str | None = None, retry_failed: bool = False,
    writer: str = BATCH_JOB, writer_batch: int | None = None,
) -> int:
    """Ingests the CSV attachments of stored messages (path, content) as one batch.

    The sample policy takes the first message of ``sender`` only.
    """
    batch_id = store.next_batch_id() if batch_id is None else batch_id
    parts = store.stage("parts", batch_id, mail.message_parts(messages))
    if sender is not None:
        parts = mail.sender_filter(parts, sender)
    if policy is SAMPLE:
        first = parts.select("path").distinct().orderBy("path").limit(1)
        parts = parts.join(F.broadcast(first), "path", "left_semi")
    attachments = parts.filter(F.col("part_index").isNotNull())
    if policy is not LENIENT:
        attachments = mail.first_attachment(attachments)
    ingest_files(
        store, batch_id, mail.attachment_arrivals(attachments),
        lambda wanted: mail.attachment_rows(attachments, wanted), policy, as_of,
        messages=mail.messages_of(parts), retry_failed=retry_failed, writer=writer, writer_batch=writer_batch,
    )
    return batch_id


