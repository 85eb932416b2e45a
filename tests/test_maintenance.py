"""Compaction and retention over a stored history."""

from samples import csv_bytes, row, write
from weighbridge.plans.ingest import STRICT, ingest_landing
from weighbridge.plans.maintenance import rewrite_store

DAYS = ["2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"]


def history(store, tmp_path):
    """Key 1 moves from the first file to the last; key 2 stays with the first."""
    contents = [csv_bytes(row(1), row(2)), csv_bytes(row(3)), csv_bytes(row(1, fill="9kg"), row(4, success="?"))]
    for i, (content, day) in enumerate(zip(contents, DAYS)):
        write(tmp_path / f"in{i}", f"f{i}.csv", content)
        ingest_landing(store, str(tmp_path / f"in{i}"), as_of=day)


def view(store):
    return sorted(map(str, store.current_transactions().collect()))


def test_compaction_keeps_the_view(spark, store, tmp_path):
    history(store, tmp_path)
    copy = rewrite_store(store, str(tmp_path / "copy"))
    assert view(copy) == view(store)
    assert copy.read("scale_transactions").filter("transact_no = 1").count() == 2
    assert copy.next_batch_id() == store.next_batch_id() == 3


def test_retention_takes_the_rows_that_old_files_own(spark, store, tmp_path):
    history(store, tmp_path)
    copy = rewrite_store(store, str(tmp_path / "copy"), as_of="2026-03-02 00:00:00", days_old=30)
    assert {r.filename for r in copy.read("ingestion_files").collect()} == {"f1.csv", "f2.csv"}
    assert sorted(r.transact_no for r in copy.current_transactions().collect()) == [1, 3]
    assert copy.read("row_errors").count() == 1
    ingest_landing(copy, str(tmp_path / "in1"), as_of="2026-03-03 00:00:00")
    assert [r.status for r in copy.read("file_arrivals").filter("batch_id = 3").collect()] == ["DUPLICATE"]


def test_retention_keeps_what_no_deleted_file_owns(spark, store, tmp_path):
    write(tmp_path / "in", "bad.csv", csv_bytes(row(1), row(2, success="?")))
    ingest_landing(store, str(tmp_path / "in"), STRICT, as_of="2026-03-01 00:00:00")
    assert store.read("ingestion_files").count() == 0 and store.read("row_errors").count() == 1
    copy = rewrite_store(store, str(tmp_path / "copy"), as_of="2026-03-02 00:00:00", days_old=30)
    assert copy.read("row_errors").count() == 1 and copy.read("file_arrivals").count() == 1


def test_retention_of_everything_keeps_the_batch_number(spark, store, tmp_path):
    history(store, tmp_path)
    copy = rewrite_store(store, str(tmp_path / "copy"), as_of="2027-01-01 00:00:00", days_old=30)
    assert copy.read("file_arrivals").count() == 0 and copy.next_batch_id() == 3


def test_a_file_tried_again_has_one_row(spark, store, tmp_path):
    write(tmp_path / "in", "bad.csv", b"no header\n")
    for retry in (False, True, False):
        ingest_landing(store, str(tmp_path / "in"), retry_failed=retry)
    assert store.read("ingestion_files").count() == 1
    assert [store.read("file_arrivals").filter(f"batch_id = {n}").count() for n in range(3)] == [1, 1, 1]


def test_commit_removes_what_the_batch_staged(store, tmp_path):
    write(tmp_path / "in", "a.csv", csv_bytes(row(1)))
    ingest_landing(store, str(tmp_path / "in"))
    assert not list((tmp_path / "store" / "_staging").glob("*/batch_id=0"))
