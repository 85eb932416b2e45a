"""Streams give what batches give, once."""

from pyspark.sql import functions as F

from samples import csv_bytes, row, write
from weighbridge.plans.ingest import ingest_landing
from weighbridge.sources.tables import Store
from weighbridge.streaming import tables as streams
from weighbridge.streaming.ingest import keep_running, stream_ingest


def fill(folder):
    for i in range(6):
        write(folder, f"f[{i}] +x.csv", csv_bytes(row(i * 2), row(i * 2 + 1), row(50 + i % 2, fill=f"{i}kg")))
    write(folder, "copy.csv", csv_bytes(row(0), row(1), row(50, fill="0kg")))


def counts(store):
    names = ("file_arrivals", "ingestion_files", "scale_transactions", "row_errors")
    return {n: store.read(n).count() for n in names}


def test_stream_equals_batch_and_takes_each_file_once(spark, store, tmp_path):
    fill(tmp_path / "in")
    stream_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp"), max_files=3).awaitTermination()
    batch = Store(spark, str(tmp_path / "batch"))
    ingest_landing(batch, str(tmp_path / "in"))
    assert counts(store) == counts(batch)
    keys = lambda s: sorted((r.scale_name, r.transact_no) for r in s.current_transactions().collect())
    assert keys(store) == keys(batch)
    before = counts(store)
    stream_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp")).awaitTermination()
    assert counts(store) == before
    write(tmp_path / "in", "late.csv", csv_bytes(row(99)))
    stream_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp")).awaitTermination()
    assert counts(store)["file_arrivals"] == before["file_arrivals"] + 1
    assert {r.status for r in store.read("file_arrivals").collect()} >= {"DUPLICATE", "COMPLETED"}


def test_replay_of_a_batch_changes_nothing(spark, store, tmp_path):
    fill(tmp_path / "in")
    ingest_landing(store, str(tmp_path / "in"), batch_id=0)
    before = counts(store), sorted(map(str, store.current_transactions().drop("created_at", "updated_at").collect()))
    ingest_landing(store, str(tmp_path / "in"), batch_id=0)
    assert before == (counts(store), sorted(map(str, store.current_transactions().drop("created_at", "updated_at").collect())))


def test_second_pass_over_the_same_files_stores_nothing(spark, store, tmp_path):
    fill(tmp_path / "in")
    ingest_landing(store, str(tmp_path / "in"))
    first = counts(store)
    ingest_landing(store, str(tmp_path / "in"))
    second = counts(store)
    assert second["file_arrivals"] == 2 * first["file_arrivals"]
    assert all(second[n] == first[n] for n in ("ingestion_files", "scale_transactions", "row_errors"))


def test_failed_cycle_does_not_end_the_loop(spark, store, tmp_path):
    fill(tmp_path / "in")
    tries = []

    def start():
        tries.append(1)
        if len(tries) == 1:
            from weighbridge.sources import landing

            def fail(df, batch_id):
                raise ValueError("no store")

            return landing.run_once(landing.landing_stream(spark, str(tmp_path / "in")).writeStream.foreachBatch(fail), str(tmp_path / "cp"))
        return stream_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp"))

    keep_running(start, pause_seconds=0, cycles=2)
    assert counts(store)["file_arrivals"] == 7


def test_bounded_dedup_within_watermark(spark, tmp_path):
    rows = spark.range(6).select(
        (F.col("id") % 2).cast("string").cast("binary").alias("content"),
        F.timestamp_seconds(F.col("id")).alias("received_at"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    writer = streams.stream_file_dedup(stream, late="1 hour").writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_kpi_snapshots(spark, tmp_path):
    from registry import views as v
    from conftest import SMALL
    from weighbridge.operators import reports

    rows = str(tmp_path / "rows")
    v.transactions(spark, SMALL).write.parquet(rows)
    v.activity_files(spark, SMALL).repartition(3).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    streams.stream_kpis(stream, rows, out, str(tmp_path / "cp"), v.AS_OF).awaitTermination()
    files = v.activity_files(spark, SMALL)
    for name, want in {
        "file_kpis": reports.file_kpis(files),
        "daily_performance": reports.daily_performance(files, v.AS_OF),
        "scale_leaderboard": reports.scale_leaderboard(spark.read.parquet(rows)),
    }.items():
        assert sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) == sorted(map(str, want.collect()))


def test_streams_and_batches_share_a_store(spark, store, tmp_path):
    fill(tmp_path / "in")
    ingest_landing(store, str(tmp_path / "in"))
    before = counts(store)["file_arrivals"]
    for n, cp in enumerate(("cp1", "cp2"), 1):
        write(tmp_path / f"new{n}", "a.csv", csv_bytes(row(500 + n)))
        stream_ingest(store, str(tmp_path / f"new{n}"), str(tmp_path / cp)).awaitTermination()
        assert counts(store)["file_arrivals"] == before + n
    assert sorted(r.batch_id for r in store.commits().collect()) == [0, 1, 2]


def test_replayed_micro_batch_keeps_its_number(spark, store, tmp_path):
    assert store.batch_of("stream a", 0) == 0
    store.commit(0, "stream a", 0)
    store.commit(1, "stream b", 0)
    assert (store.batch_of("stream a", 0), store.batch_of("stream b", 0), store.batch_of("stream a", 1)) == (0, 1, 2)


def test_a_table_that_is_a_folder_of_files_streams(spark, tmp_path):
    from registry.files import QUERIES

    rows = spark.range(20).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 5).alias("text"))
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.limit(1).coalesce(1).write.parquet(str(tmp_path / "many" / "documents.parquet.old"))
    one_file = next((tmp_path / "many" / "documents.parquet.old").glob("*.parquet"))
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "documents.parquet").write_bytes(one_file.read_bytes())
    assert QUERIES["stream_file_dedup"](spark, str(tmp_path / "many")).count() == 5
    assert QUERIES["stream_file_dedup"](spark, str(tmp_path / "one")).count() == 1
