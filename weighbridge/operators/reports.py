"""Operational questions over the two stored tables; every ``now`` is an argument."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weighbridge.functions.values import (
    as_of_time,
    before,
    day_of,
    elapsed_seconds,
    hour_of,
    mean_kg,
    percent_of,
    rank_label,
    recency_bucket,
    rounded_ratio,
    shorten,
    status_label,
)


def _with_status(status: str) -> Column:
    return F.count_if(F.coalesce(F.col("status") == status, F.lit(False)))


def _succeeded() -> Column:
    return F.count_if(F.coalesce(F.col("success"), F.lit(False)))


def _failed() -> Column:
    return F.count_if(F.coalesce(~F.col("success"), F.lit(False)))


def _mean_fill(places: int, only_success: bool = False) -> Column:
    fill = F.when(F.col("success"), F.col("fill_kg")) if only_success else F.col("fill_kg")
    return mean_kg(F.sum(fill), F.count(fill), places)


def last_day(df: DataFrame, as_of: Column | str | None) -> DataFrame:
    return df.filter(F.col("created_at") >= before(as_of_time(as_of), hours=24))


def file_kpis(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("total_files"),
        _with_status("COMPLETED").alias("completed"),
        _with_status("NEW").alias("new_files"),
        _with_status("FAILED").alias("failed"),
        _with_status("DUPLICATE").alias("duplicates"),
        F.max("created_at").alias("last_processed"),
    )


def transaction_kpis(rows: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Means carry six decimals, exact half up."""
    return rows.agg(
        F.count("*").alias("total_transactions"),
        _succeeded().alias("successful"),
        _failed().alias("failed_transactions"),
        F.count_distinct("scale_name").alias("unique_scales"),
        _mean_fill(6).alias("avg_fill_kg"),
        _mean_fill(6, only_success=True).alias("avg_success_fill"),
        F.min("started_at").alias("earliest"),
        F.max("started_at").alias("latest"),
        F.count_if(F.col("started_at") > before(as_of_time(as_of), hours=1)).alias("last_hour"),
    )


def scale_leaderboard(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("scale_name")
        .agg(
            F.count("*").alias("transaction_count"),
            _succeeded().alias("success_count"),
            percent_of(_succeeded(), F.count("*"), 1).alias("success_rate"),
            _mean_fill(2).alias("avg_fill"),
            _mean_fill(2, only_success=True).alias("avg_success_fill"),
            F.max("started_at").alias("last_activity"),
        )
        .orderBy(F.desc("success_rate"), F.desc("transaction_count"), "scale_name")
    )


def leaderboard_top10(rows: DataFrame) -> DataFrame:
    """First ten of the leaderboard; the rank window sees those ten rows only."""
    order = [F.desc("success_rate"), F.desc("transaction_count"), F.col("scale_name")]
    top = scale_leaderboard(rows).limit(10)
    ranked = top.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select(
        rank_label(F.col("_rank")).alias("rank"),
        "scale_name",
        "success_rate",
        "transaction_count",
        "avg_fill",
    )


def recent_files(files: DataFrame, as_of: Column | str | None = None, n: int = 8) -> DataFrame:
    newest = files.orderBy(F.desc("created_at"), "id").limit(n)
    return newest.select(
        "id",
        "filename",
        "status",
        "correlation_id",
        "created_at",
        "from_email",
        recency_bucket(F.col("created_at"), as_of_time(as_of)).alias("time_status"),
    )


def recent_files_display(files: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """The same eight files as the dashboard prints them."""
    return recent_files(files, as_of).select(
        "id",
        status_label(F.col("status")).alias("label"),
        "time_status",
        shorten(F.col("filename"), 25).alias("filename"),
        shorten(F.col("from_email"), 15).alias("from_email"),
    )


def daily_performance(files: DataFrame, as_of: Column | str | None = None, days: int = 7) -> DataFrame:
    return (
        files.filter(F.col("created_at") > before(as_of_time(as_of), days=days))
        .groupBy(day_of(F.col("created_at")).alias("process_date"))
        .agg(F.count("*").alias("files_processed"), _with_status("COMPLETED").alias("successful_files"))
        .orderBy(F.desc("process_date"))
    )


def file_rates(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Share of completed files and of successful rows; NULL without files or rows."""
    done = files.agg(F.count("*").alias("whole"), _with_status("COMPLETED").alias("part"))
    good = rows.agg(F.count("*").alias("whole"), _succeeded().alias("part"))
    named = [done.select(F.lit("files").alias("subject"), "*"), good.select(F.lit("transactions").alias("subject"), "*")]
    return named[0].union(named[1]).select(
        "subject",
        F.col("whole").alias("total"),
        F.col("part").alias("succeeded"),
        percent_of(F.col("part"), F.col("whole"), 1).alias("rate_percent"),
    )


def status_breakdown(files: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    took = elapsed_seconds(F.col("processing_started_at"), F.col("processing_completed_at"))
    return (
        last_day(files, as_of)
        .groupBy("status")
        .agg(F.count("*").alias("count"), F.avg(took).alias("avg_processing_time_seconds"))
    )


def transaction_summary(rows: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    seconds = F.col("fill_time_seconds")
    return last_day(rows, as_of).agg(
        F.count("*").alias("total_transactions"),
        _succeeded().alias("successful_transactions"),
        _failed().alias("failed_transactions"),
        rounded_ratio(F.sum(seconds), F.count(seconds), 6).alias("avg_fill_time_seconds"),
    )


def hourly_counts(files: DataFrame) -> DataFrame:
    """Files per hour; the streaming job keeps this same aggregate."""
    return files.groupBy(hour_of(F.col("created_at")).alias("hour")).agg(
        F.count("*").alias("files_processed"),
        _with_status("COMPLETED").alias("successful_files"),
        _with_status("FAILED").alias("failed_files"),
    )


def hourly_activity(files: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    return hourly_counts(last_day(files, as_of)).orderBy(F.desc("hour")).limit(24)


def failure_rate(files: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    counted = last_day(files, as_of).agg(
        F.count("*").alias("total_files"), _with_status("FAILED").alias("failed_files")
    )
    return counted.withColumn(
        "failure_rate_percent", percent_of(F.col("failed_files"), F.col("total_files"), 2)
    )


def file_statistics(files: DataFrame, rows: DataFrame, file_key: str = "id") -> DataFrame:
    """Row counts of every file; rows are counted per file before they are joined."""
    counts = rows.groupBy(F.col("ingestion_file_id").alias(file_key)).agg(
        F.count("*").alias("transaction_count"),
        _succeeded().alias("success_count"),
        _failed().alias("failure_count"),
    )
    zero = F.lit(0).cast("bigint")
    return files.join(counts, file_key, "left").select(
        *files.columns,
        *[
            F.coalesce(c, zero).alias(c)
            for c in ("transaction_count", "success_count", "failure_count")
        ],
    )


def store_totals(files: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: files, rows, successes. Each table is counted alone, then added up."""
    nothing = F.lit(0).cast("bigint")
    counted = files.agg(F.count("*").alias("files")).select(
        "files", nothing.alias("transactions"), nothing.alias("successful")
    ).union(
        rows.agg(F.count("*").alias("transactions"), _succeeded().alias("successful")).select(
            nothing.alias("files"), "transactions", "successful"
        )
    )
    return counted.agg(*[F.sum(c).alias(c) for c in counted.columns])


def batch_profile(rows: DataFrame, batch_key: str) -> DataFrame:
    """Per batch: success share, scale names, first and last start."""
    return rows.groupBy(batch_key).agg(
        F.count("*").alias("transactions"),
        _succeeded().alias("success_count"),
        percent_of(_succeeded(), F.count("*"), 1).alias("success_rate"),
        F.array_sort(F.collect_set("scale_name")).alias("scale_names"),
        F.min("started_at").alias("first_start"),
        F.max("started_at").alias("last_start"),
    )


def lineage(
    rows: DataFrame, files: DataFrame, row_key: str = "ingestion_file_id", file_key: str = "id"
) -> DataFrame:
    """Each row with its file, its message and both correlation ids.

    Rows of a store are joined on ``file_sha256``: ids are short hashes, and two of many
    files may share one.
    Both sides reach the join straight from a shuffle, so the adaptive planner can split
    a file that owns a large share of the rows.
    """
    origin = files.select(
        F.col(file_key).alias(row_key),
        "filename",
        "message_id",
        F.col("correlation_id").alias("file_correlation_id"),
    )
    return rows.withColumnRenamed("correlation_id", "row_correlation_id").join(
        origin, row_key
    )


def health_report(files: DataFrame, rows: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Four sections in long form: section, key, metric, value.

    Each section is its own branch; one that cannot be planned becomes an error line
    and leaves the others alone.
    """
    sections = {
        "file_processing": (lambda: status_breakdown(files, as_of), "status"),
        "transactions": (lambda: transaction_summary(rows, as_of), None),
        "hourly_activity": (lambda: hourly_activity(files, as_of), "hour"),
        "error_rates": (lambda: failure_rate(files, as_of), None),
    }
    return reduce(
        DataFrame.union,
        [_long_section(files, name, make, key) for name, (make, key) in sections.items()],
    )


def _long_section(files: DataFrame, section: str, make, key: str | None) -> DataFrame:
    try:
        wide = make()
        metrics = [c for c in wide.columns if c != key]
        pairs = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        return wide.select(
            F.lit(section).alias("section"),
            (F.col(key).cast("string") if key else F.lit("all")).alias("key"),
            F.inline(pairs),
        )
    except Exception as error:  # noqa: BLE001 - the other sections must still be reported
        return files.sparkSession.createDataFrame(
            [(section, "error", str(error).splitlines()[0], None)],
            "section string, key string, metric string, value double",
        )
