"""File shapes, row errors and the three policies over landing folders."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import HEADER, csv_bytes, row, write
from weighbridge.operators.structure import file_inventory
from weighbridge.plans.ingest import LENIENT, SAMPLE, STRICT, ingest_files, ingest_landing
from weighbridge.sources import landing

SHAPES = {
    "empty.csv": (b"", "File validation failed: CSV has no headers"),
    "blank_first.csv": (b"\n" + csv_bytes(row(1)), "File validation failed: CSV has no headers"),
    "header_only.csv": (csv_bytes(), "File validation failed: CSV has no data rows"),
    "blank_tail.csv": (csv_bytes() + b"\n\r\n", "File validation failed: CSV has no data rows"),
    "missing_and_empty.csv": (
        csv_bytes(header=HEADER.replace(",Residual", "")),
        "File validation failed: Missing required columns: {'Residual'}; CSV has no data rows",
    ),
    "bad_utf8.csv": (csv_bytes(row(2)) + b"\xff", "File validation failed: CSV file is not valid UTF-8"),
    "bom.csv": (b"\xef\xbb\xbf" + csv_bytes(row(3)), "File validation failed: Missing required columns: {'TransactNo'}"),
    "stray_blank.csv": (
        csv_bytes(row(4), header=HEADER.replace(",Scale", ", Scale")),
        "File validation failed: Missing required columns: {'Scale Name'}",
    ),
    "all_bad.csv": (csv_bytes(row(5, success="maybe")), "No valid transactions found in CSV"),
    "blank_line_row.csv": (csv_bytes("   "), "No valid transactions found in CSV"),
    "good.CSV": (csv_bytes(row(10), row(11)), None),
    "crlf.csv": (csv_bytes(row(12), row(13), end="\r\n"), None),
    "some_bad.csv": (csv_bytes(row(14), row(0), "", row(15, success="?"), row(16)), None),
    "long_and_short.csv": (csv_bytes(row(17) + ",extra,cells", "18"), None),
    "deep/quoted name.csv": (csv_bytes(row(19, scale='"Scale\n09"'), row(20, scale='"Scale ""x"", y"')), None),
    "reordered.csv": (
        b"Extra,Scale Name,TransactNo,CylSize,TareWeight,Fill kgs,Residual,Success,Date Time Start,Fill Time\n"
        b"z,Scale-07,21,50,1kg,2kg,3kg,N,2026-02-08 14:15:00,9\n", None,
    ),
    "quoted_header.csv": (csv_bytes(row(22), header=HEADER.replace("Scale Name", '"Scale Name"')), None),
    "repeated_header.csv": (csv_bytes(row(23) + ",99", header=HEADER + ",Fill Time"), None),
}


@pytest.fixture
def shapes(tmp_path):
    folder = tmp_path / "in"
    for name, (content, _) in SHAPES.items():
        write(folder, name, content)
    return folder


def test_lenient_outcome_of_every_shape(spark, store, shapes):
    ingest_landing(store, str(shapes), LENIENT)
    found = {r.filename: r.error for r in store.read("ingestion_files").collect()}
    assert found == {name.split("/")[-1]: error for name, (_, error) in SHAPES.items()}


def test_lenient_rows_and_quarantine(spark, store, shapes):
    ingest_landing(store, str(shapes), LENIENT)
    now = {r.transact_no: r for r in store.current_transactions().collect()}
    assert sorted(now) == [10, 11, 12, 13, 14, 16, 17, 19, 20, 21, 22, 23]
    assert now[19].scale_name == "Scale\n09" and now[20].scale_name == 'Scale "x", y'
    assert now[21].scale_name == "Scale-07" and now[21].success is False and now[21].fill_time_seconds == 9
    assert now[23].fill_time_seconds == 99
    assert now[10].started_at == datetime(2026, 2, 8, 12, 15)
    names = {r.path: r.filename for r in store.read("file_arrivals").collect()}
    errors = {(names[r.path], r.row_number): r.message for r in store.read("row_errors").collect()}
    assert errors[("some_bad.csv", 2)] == "Row 2: Transaction number must be positive"
    assert errors[("some_bad.csv", 3)] == "Row 3: Invalid Success: '?' - expected Y/N or True/False"
    assert errors[("long_and_short.csv", 2)] == "Row 2: Scale Name is required"
    assert errors[("blank_line_row.csv", 1)] == "Row 1: Invalid TransactNo: '   ' - TransactNo is required"
    assert errors[("all_bad.csv", 1)] == "Row 1: Invalid Success: 'maybe' - expected Y/N or True/False"
    assert len(errors) == 5


def test_strict_refuses_files_with_bad_rows(spark, store, shapes):
    ingest_landing(store, str(shapes), STRICT)
    stored = {r.filename for r in store.read("ingestion_files").collect()}
    refused = {"some_bad.csv", "all_bad.csv", "long_and_short.csv", "blank_line_row.csv"}
    unread = {n for n, (_, e) in SHAPES.items() if e and "validation failed" in e} - {"header_only.csv", "blank_tail.csv"}
    assert stored == {n.split("/")[-1] for n in set(SHAPES) - refused - unread}
    assert sorted(r.transact_no for r in store.current_transactions().collect()) == [10, 11, 12, 13, 19, 20, 21, 22, 23]


def test_sample_takes_ten_rows(spark, store, tmp_path):
    write(tmp_path / "in", "a.csv", csv_bytes(row("x"), *[row(i) for i in range(1, 31)]))
    ingest_landing(store, str(tmp_path / "in"), SAMPLE)
    assert sorted(r.transact_no for r in store.current_transactions().collect()) == list(range(1, 11))
    assert [r.status for r in store.read("ingestion_files").collect()] == ["COMPLETED"]


def test_duplicates_in_batch_and_in_history(spark, store, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    bad = csv_bytes(row(1, success="?"))
    for name, content in {"a.csv": csv_bytes(row(7)), "b.csv": csv_bytes(row(7)), "bad.csv": bad}.items():
        write(one, name, content)
    for name, content in {"c.csv": csv_bytes(row(7)), "bad2.csv": bad, "d.csv": csv_bytes(row(7, fill="1kg"))}.items():
        write(two, name, content)
    ingest_landing(store, str(one))
    ingest_landing(store, str(two))
    arrivals = {r.filename: (r.status, r.original_status) for r in store.read("file_arrivals").collect()}
    copies = [arrivals.pop("a.csv"), arrivals.pop("b.csv")]
    assert sorted(copies, key=str) == [("COMPLETED", None), ("DUPLICATE", "COMPLETED")]
    assert arrivals == {
        "bad.csv": ("FAILED", None), "c.csv": ("DUPLICATE", "COMPLETED"),
        "bad2.csv": ("DUPLICATE", "FAILED"), "d.csv": ("COMPLETED", None),
    }
    current = store.current_transactions().collect()
    assert [(r.transact_no, str(r.fill_kg)) for r in current] == [(7, "1.000")]
    assert current[0].updated_at > current[0].created_at
    assert store.read("file_arrivals").count() == store.read("ingestion_files").count() + 3


def test_failed_files_can_be_retried(spark, store, tmp_path):
    write(tmp_path / "in", "bad.csv", csv_bytes(row(1, success="?")))
    ingest_landing(store, str(tmp_path / "in"))
    ingest_landing(store, str(tmp_path / "in"), retry_failed=True)
    assert [r.status for r in store.read("file_arrivals").collect()] == ["FAILED", "FAILED"]


def test_strict_conflict_loses_the_rows_and_keeps_the_file(spark, store, tmp_path):
    write(tmp_path / "one", "a.csv", csv_bytes(row(1), row(2)))
    write(tmp_path / "two", "b.csv", csv_bytes(row(2, fill="9kg"), row(3)))
    for folder in ("one", "two"):
        ingest_landing(store, str(tmp_path / folder), STRICT)
    assert sorted(r.transact_no for r in store.current_transactions().collect()) == [1, 2]
    assert {r.status for r in store.read("ingestion_files").collect()} == {"COMPLETED"}


def test_one_batch_or_three_give_the_same_view(spark, tmp_path):
    from weighbridge.sources.tables import Store

    contents = [csv_bytes(row(1), row(2, fill="1kg")), csv_bytes(row(2, fill="2kg"), row(3)), csv_bytes(row(1, fill="3kg"), row(3, success="N"))]
    for i, content in enumerate(contents):
        write(tmp_path / "all", f"{i}/f{i}.csv", content)

    def view(name, groups):
        store = Store(spark, str(tmp_path / name))
        for batch_id, folder in enumerate(groups):
            files = landing.landing_files(spark, folder).withColumn(
                "received_at", F.make_timestamp_ntz(F.lit(2026), F.lit(1), F.regexp_extract("filename", r"\d", 0).cast("int") + 1, F.lit(0), F.lit(0), F.lit(0.0))
            )
            ingest_files(store, batch_id, files, lambda w, f=folder: landing.rows_by_name(spark, f, w), as_of="2026-02-09 00:00:00")
        return sorted(store.current_transactions().collect(), key=str)

    root = str(tmp_path / "all")
    assert view("once", [root]) == view("thrice", [f"{root}/{i}" for i in range(3)])


def test_uncommitted_batch_is_not_read(spark, store, tmp_path):
    write(tmp_path / "in", "a.csv", csv_bytes(row(1)))
    ingest_landing(store, str(tmp_path / "in"))
    left_over = store.read("scale_transactions").withColumn("transact_no", F.lit(99).cast("bigint"))
    store.write("scale_transactions", 1, left_over)
    assert [r.transact_no for r in store.current_transactions().collect()] == [1]


def test_rows_of_a_file_keep_their_order(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "in", f"f{i}.csv", csv_bytes(*[row(n) for n in range(1, 2001)]))
    rows = landing.csv_landing_source(spark, str(tmp_path / "in"))
    assert rows.count() == 6000
    assert rows.filter(F.col("row_number") != F.col("transact_raw").cast("int")).count() == 0


def test_inventory_hash_and_size(spark, tmp_path):
    content = csv_bytes(row(1))
    write(tmp_path / "in", "a.csv", content)
    found = file_inventory(landing.landing_files(spark, str(tmp_path / "in"))).first()
    assert (found.file_sha256, found.length) == (hashlib.sha256(content).hexdigest(), len(content))


LINES = csv_bytes(*[row(n) for n in range(2, 30)])
LARGE = {
    "line_end.csv": LINES,
    "no_line_end.csv": LINES.rstrip(b"\n") + b" ",
    "bom.csv": b"\xef\xbb\xbf" + LINES,
    "bom_no_line_end.csv": b"\xef\xbb\xbf" + LINES.rstrip(b"\n"),
    "crlf.csv": LINES.replace(b"\n", b"\r\n"),
    "bad_utf8.csv": LINES + b"\xff\n",
    "blank_first.csv": b"\n\n" + LINES,
    "header_only.csv": csv_bytes() + b"\r\n" * 600,
    "quoted.csv": csv_bytes(*[row(n, scale='"a\n\n,b"') for n in range(90, 120)], header=HEADER.replace("Residual", '"Resi\ndual"')),
}


def test_a_file_read_by_lines_is_judged_like_one_value(spark, tmp_path):
    for name, content in LARGE.items():
        write(tmp_path, name, content)
    columns = ["path", "length", "file_sha256", "valid_utf8", "header", "has_rows", "names", "structure_errors"]
    found = [
        {r.path: r for r in file_inventory(landing.landing_files(spark, str(tmp_path), max_bytes=m)).select(columns).collect()}
        for m in (500, 10**9)
    ]
    assert len(found[0]) == len(LARGE)
    assert found[0] == found[1]


def test_large_file_keeps_its_rows(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    write(tmp_path / "in", "small.csv", csv_bytes(row(1)))
    for name in ("large.csv", "copy.csv"):
        write(tmp_path / "in", name, LINES)
    files = landing.landing_files(spark, folder, max_bytes=500)
    ingest_files(store, 0, files, lambda wanted: landing.rows_by_name(spark, folder, wanted))
    assert sorted(r.status for r in store.read("file_arrivals").collect()) == ["COMPLETED", "COMPLETED", "DUPLICATE"]
    stored = store.read("ingestion_files").select("file_sha256").collect()
    assert hashlib.sha256(LINES).hexdigest() in {r.file_sha256 for r in stored}
    assert sorted(r.transact_no for r in store.current_transactions().collect()) == list(range(1, 30))


@pytest.mark.parametrize("wide", [row(2) + "," * 21_000, row(2) + ',"a\nb"' * 21_000, row(2) + ',x"' + ",y" * 21_000])
def test_wide_rows_harm_no_file(spark, store, tmp_path, wide):
    write(tmp_path / "in", "good.csv", csv_bytes(row(1)))
    write(tmp_path / "in", "wide.csv", csv_bytes(wide, row(3)))
    ingest_landing(store, str(tmp_path / "in"))
    assert sorted(r.transact_no for r in store.current_transactions().collect()) == [1, 2, 3]


def test_a_scan_of_many_small_files_takes_few_tasks(spark, tmp_path):
    for i in range(200):
        write(tmp_path / "in", f"f{i}.csv", csv_bytes(row(i)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        assert landing.landing_files(spark, str(tmp_path / "in")).rdd.getNumPartitions() <= 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_that_tasks_write_hold_the_lines_in_order(spark, tmp_path):
    from registry.files import write_files

    lines = spark.range(3000).select(
        F.concat(F.lit("k="), F.col("id") % 7, F.lit("/"), F.col("id") % 2, F.lit(".txt")).alias("file"),
        "id", F.when(F.col("id") != 8, F.concat(F.lit("größe "), "id")).alias("line"),
    )
    write_files(lines.repartition(4, "file").sortWithinPartitions("file", "id").select("file", "line"), str(tmp_path / "out"), "head\n")
    found = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    want = {}
    for i in range(3000):
        name = f"k={i % 7}/{i % 2}.txt"
        want[name] = want.get(name, "head\n") + (f"größe {i}\n" if i != 8 else "\n")
    assert found == want
