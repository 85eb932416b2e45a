"""Every registered query against its oracle, and the shape of the plans."""

import pytest

import __spark_entry__ as contract
from check_oracles import database, difference
from conftest import SMALL
from registry import views as v
from weighbridge.operators import reports

NAMES = list(contract.queries())


@pytest.fixture(scope="module")
def db():
    return database(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, db, name):
    assert difference(spark, db, SMALL, name) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("stream", "landing", "run_once", "replay"))])
def test_no_plan_pairs_all_rows(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_time_filter_reaches_the_scan(spark):
    text = plan(reports.failure_rate(v.activity_files(spark, SMALL), v.AS_OF))
    assert "GreaterThanOrEqual(ts" in text and "props" not in text


def test_top_rows_are_not_sorted_as_a_whole(spark):
    assert "TakeOrderedAndProject" in plan(reports.recent_files(v.activity_files(spark, SMALL), v.AS_OF))


def test_copies_collapse_before_the_shuffle(spark):
    text = plan(v.transactions(spark, SMALL))
    assert "partial_max" in text and "Window" not in text


def test_values_are_parsed_once(spark):
    """The verdict filter stays above the parsed values."""
    text = plan(v.valid_rows(spark, SMALL))
    assert text.count("Generate inline") == 1 and text.index("isnull(error_rule") < text.index("Generate inline")


def test_one_broken_section_leaves_the_report(spark):
    files = v.activity_files(spark, SMALL)
    found = reports.health_report(files, files.limit(0), v.AS_OF).collect()
    assert {r.section for r in found} == {"file_processing", "transactions", "hourly_activity", "error_rates"}
    assert [r.metric[:1] for r in found if r.key == "error"] != []
