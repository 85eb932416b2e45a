"""Upsert, whole-file insert and skewed joins against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from weighbridge.operators import dedup, upsert
from weighbridge.operators.rows import error_summary
from weighbridge.operators.skew import join_heaviest_first


def one_by_one(claims, stored):
    """Files in order; a file is kept if none of its keys is stored or repeated."""
    kept, taken = set(), set(stored)
    for file in sorted({f for f, _ in claims}):
        keys = [k for f, k in claims if f == file]
        if len(set(keys)) == len(keys) and not taken & set(keys):
            kept.add(file)
            taken |= set(keys)
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_whole_file_insert_equals_one_by_one(spark, seed):
    rnd = random.Random(seed)
    claims = [(f, rnd.randrange(30 if f % 3 else 3)) for f in range(25) for _ in range(rnd.randint(1, 3))]
    stored = [rnd.randrange(30) for _ in range(2)]
    rows = spark.createDataFrame(claims, "file int, k int")
    known = spark.createDataFrame([(k,) for k in stored], "k int")
    kept = upsert.insert_only_unique(rows, "file", ["file"], ["k"], known).collect()
    want = one_by_one(claims, stored)
    assert sorted((r.file, r.k) for r in kept) == sorted((f, k) for f, k in claims if f in want)


def test_whole_file_insert_follows_a_chain(spark):
    claims = [(f, k) for f in range(12) for k in (f, f + 1)]
    rows = spark.createDataFrame(claims, "file int, k int")
    kept = {r.file for r in upsert.accept_whole_files(rows, "file", ["file"], ["k"]).collect()}
    assert kept == set(range(0, 12, 2))


def test_upsert_keeps_last_measures_and_first_birth(spark):
    versions = spark.createDataFrame(
        [("a", 1, 0, "x", 1.0), ("a", 1, 2, "z", 3.0), ("a", 1, 1, "y", 2.0), ("b", 1, 0, "w", None)],
        "scale_name string, transact_no bigint, batch_id int, m string, at double",
    )
    now = upsert.upsert_latest(versions, order=["batch_id"], measures=["m"], committed_at="at").collect()
    assert sorted((r.scale_name, r.m, r.created_at, r.updated_at) for r in now if r.scale_name == "a") == [("a", "z", 1.0, 3.0)]
    assert len({r.id for r in now}) == 2


def test_skewed_join_answers_hot_cold_and_unknown_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise((F.col("id") % 1500).cast("string")).alias("k"), "id")
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least")).filter("k <> '7'")
    joined = join_heaviest_first(rows, lookup, ["k"], "n", [F.col("id")])
    plain = rows.join(lookup, "k", "left")
    assert joined.count() == 3000
    assert (
        joined.select("k", "id", "found.n", "found.least").exceptAll(plain.select("k", "id", "n", "least")).count() == 0
    )


def test_answered_rows_are_spread_by_the_salt(spark):
    rows = spark.range(1000).select(F.pmod("id", F.lit(1)).alias("k"), "id")
    joined = join_heaviest_first(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", [F.col("id")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        used = joined.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin [_k_k" in plan and "_salt" in plan.split("SortMergeJoin")[1].split("]")[0]
    assert len(used) > 1 and max(r["count"] for r in used) < 500


def test_verdict_of_many_copies(spark):
    arrivals = spark.range(5000).select(
        F.format_string("p%05d", "id").alias("path"), F.lit(0).alias("part_index"),
        F.lit(None).cast("timestamp_ntz").alias("received_at"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("file_sha256"),
    )
    history = spark.createDataFrame([("1", 11, "FAILED"), ("2", 12, "COMPLETED")], "file_sha256 string, id bigint, status string")
    counts = {
        retry: {r.status: r["count"] for r in dedup.duplicate_verdict(arrivals, history, retry_failed=retry).groupBy("status").count().collect()}
        for retry in (False, True)
    }
    copies = len(range(0, 5000, 3))
    assert counts[False] == {"NEW": 5000 - copies + 1 - 2, "DUPLICATE": copies - 1 + 2}
    assert counts[True] == {"NEW": 5000 - copies + 1 - 1, "DUPLICATE": copies - 1 + 1}


def test_error_summary_keeps_the_first_messages(spark):
    errors = spark.range(100).select(F.lit("f").alias("file"), (100 - F.col("id")).alias("n"), F.format_string("e%d", 100 - F.col("id")).alias("message"))
    assert [tuple(r) for r in error_summary(errors, "file", ["n"]).collect()] == [("f", 100, ["e1", "e2", "e3"])]


def test_claims_without_contest_stay_out_of_the_waves(spark, monkeypatch):
    """4 of 500 files share a key; the waves see the claims of these alone, and a missing key claims nothing."""
    met = []
    joined = upsert.join_heaviest_first

    def counted(rows, *more):
        met.append(rows.count())
        return joined(rows, *more)

    monkeypatch.setattr(upsert, "join_heaviest_first", counted)
    own = [(f, f"k{f}-{i}") for f in range(500) for i in range(3)]
    shared = [(1, "s"), (2, "s"), (3, "t"), (4, "t"), (5, None), (900, None)]
    rows = spark.createDataFrame([*own, *shared], "file int, k string")
    kept = {r.file for r in upsert.accept_whole_files(rows, "file", ["file"], ["k"]).collect()}
    assert kept == set(range(500)) - {2, 4}
    assert met == [4]
    monkeypatch.setattr(upsert, "MOST_TOLD", 0)
    assert {r.file for r in upsert.accept_whole_files(rows, "file", ["file"], ["k"]).collect()} == kept
