"""Rewrites of a whole store: retention with its cascade, and compaction of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.functions.values import as_of_time
from weighbridge.operators.upsert import retention_cleanup
from weighbridge.schemas import ARRIVAL_COLUMNS, KEY_COLUMNS
from weighbridge.sources.tables import Store


def compact_versions(versions: DataFrame) -> DataFrame:
    """At most two versions per key, with the current view unchanged.

    The last version stays, once with the first commit time of its key and once with the
    last, because those are all that the view takes from the others.
    """
    rest = [c for c in versions.columns if c not in (*KEY_COLUMNS, *ARRIVAL_COLUMNS, "committed_at")]
    latest = versions.groupBy(*KEY_COLUMNS).agg(
        F.max(F.struct(*ARRIVAL_COLUMNS, *rest)).alias("_latest"),
        F.array_distinct(F.array(F.min("committed_at"), F.max("committed_at"))).alias("_times"),
    )
    return latest.select(*KEY_COLUMNS, "_latest.*", F.explode("_times").alias("committed_at")).select(
        *versions.columns
    )


def rewrite_store(
    store: Store, root: str, as_of: Column | str | None = None, days_old: int | None = None
) -> Store:
    """Copy of the committed store under a new root, as one batch; the old one stays.

    With ``days_old``, finished files older than that many days are left out, and with
    them the rows and arrivals of those files. What belongs to no file row, such as a refused
    file's errors, stays. Readers move over when the copy is committed.
    """
    target = Store(store.spark, root)
    batch_id = store.next_batch_id() - 1
    files = store.read("ingestion_files")
    versions = compact_versions(store.read("scale_transactions"))
    errors = store.read("row_errors")
    arrivals = store.read("file_arrivals")
    if days_old is not None:
        kept = target.stage("kept_files", batch_id, retention_cleanup(files, as_of_time(as_of), days_old))
        gone = files.join(kept, "file_sha256", "left_anti").select("file_sha256")
        versions, errors, arrivals = (rows.join(gone, "file_sha256", "left_anti") for rows in (versions, errors, arrivals))
        files = kept
    target.write("ingestion_files", batch_id, files)
    target.write("scale_transactions", batch_id, versions)
    target.write("row_errors", batch_id, errors)
    target.write("dispositions", batch_id, store.read("dispositions"))
    target.write("file_arrivals", batch_id, arrivals)
    target.commit(batch_id)
    return target
