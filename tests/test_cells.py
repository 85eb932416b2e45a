"""Cell rules, one Spark job per rule over all its cases."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weighbridge.functions import cells, values

INTS = {
    "12.9": 12, "-0.5": 0, "1e3": 1000, "+7": 7, "1_000": 1000, " 5 ": 5, "\t6\r\n": 6, "-3": -3, "5.": 5,
    "9007199254740993": 9007199254740992, "0.4": 0, " 8　": 8,
    "": None, "  ": None, None: None, "12d": None, "12f": None, "0x10": None, "0x1p3": None, "1,5": None,
    "nan": None, "inf": None, "1__0": None, ".": None, "1e30": None, "1 2": None,
}
WEIGHTS = {
    "12.5kg": "12.500", "12.5 kg": "12.500", " 12.5 ": "12.500", "": None, None: None, "kg": None, "12KG": None,
    "1kg2": "12.000", "-1kg": "-1.000", "2.0005": "2.001", "1e3kg": "1000.000", "1_0.5kg": "10.500",
    "12345678": None, "NaN": None, "infinitykg": None, "0.0004999999999999999999": "0.001", ".5kg": "0.500",
}
FLAGS = {
    "Y": True, "yes": True, "TRUE": True, "1": True, " y\t": True, "n": False, "NO": False, "false": False,
    "0": False, "T": None, "F": None, "maybe": None, "": None, None: None, "on": None,
}
TIMES = {
    "2026-02-08 14:15:00": datetime(2026, 2, 8, 12, 15), "2026-2-8 4:5:6": datetime(2026, 2, 8, 2, 5, 6),
    "2026-02-08   \t14:15:00": datetime(2026, 2, 8, 12, 15), " 2026-02-08 00:30:00 ": datetime(2026, 2, 7, 22, 30),
    "2024-02-29 10:00:00": datetime(2024, 2, 29, 8), "2026-02- 8 14:15:00": datetime(2026, 2, 8, 12, 15),
    "2026-02-30 00:00:00": None, "2026-02-08T14:15:00": None, "2026-02-08 14:15": None,
    "2026-02-08 14:15:00.5": None, "2026-02-08 23:59:60": None, "26-02-08 14:15:00": None, "": None, None: None,
    "0000-01-01 00:00:00": None, "2026-13-01 00:00:00": None,
}
MAIL_DATES = {
    "Mon, 05 Feb 2024 10:00:00 +0200": datetime(2024, 2, 5, 8), "5 Feb 2024 10:00:00 GMT": datetime(2024, 2, 5, 10),
    "Mon, 5 Feb 2024 10:00 -0530 (zone)": datetime(2024, 2, 5, 15, 30), "2024-02-05T10:00:00Z": datetime(2024, 2, 5, 10),
    "Mon, 05 Feb 2024 10:00:00 EST": datetime(2024, 2, 5, 15), "2024-02-05 10:00:00+02:00": datetime(2024, 2, 5, 8),
    "2024-02-05T10:00:00": datetime(2024, 2, 5, 10), "Mon, 05 Feb 2024 10:00:00 -0000": datetime(2024, 2, 5, 10),
    "05 Feb 2024 10:00:00": datetime(2024, 2, 5, 10), "soon": None, "": None, None: None, "31 Feb 2024 10:00:00 +0000": None,
}


def results(spark, cases, rule):
    given = spark.createDataFrame([(i, text) for i, text in enumerate(cases)], "i int, text string")
    return [r[0] for r in given.select("i", rule(F.col("text")).alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    "cases, rule",
    [
        (INTS, cells.parse_required_int),
        ({k: v and Decimal(v) for k, v in WEIGHTS.items()}, lambda c: cells.kg_of(cells.without_unit(cells.strip_text(c)))),
        (FLAGS, cells.parse_flag),
        (TIMES, cells.local_time_to_utc),
        (MAIL_DATES, values.parse_message_date),
    ],
    ids=["int", "kg", "flag", "time", "mail date"],
)
def test_cell_rule(spark, cases, rule):
    got = dict(zip(cases, results(spark, cases, rule)))
    assert got == dict(cases)


def test_time_rules_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert results(spark, TIMES, cells.local_time_to_utc) == list(TIMES.values())
        assert results(spark, MAIL_DATES, values.parse_message_date) == list(MAIL_DATES.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratio_rounds_exact_halves_up(spark):
    cases = [(7525, 1000, 2, "7.53"), (43865, 1000, 2, "43.87"), (1, 3, 1, "0.3"), (2, 3, 1, "0.7"), (-1, 8, 2, "-0.13"), (1, 0, 2, None)]
    for part, whole, places, want in cases:
        got = spark.range(1).select(values.rounded_ratio(F.lit(part), F.lit(whole), places)).first()[0]
        assert got == (want and Decimal(want))


def test_casts_accept_no_more_than_the_rules(spark):
    given = ["\x0112", "12\x00", "\x0112.5", "12", "+7", "1_000", "\u0661\u0662", "12.5", "1e2"]
    rows = spark.createDataFrame([(c,) for c in given], "c string")
    got = rows.select(cells.parse_required_int(F.col("c")).alias("i"), cells.kg_of(F.col("c")).alias("k")).collect()
    assert [r.i for r in got] == [None, None, None, 12, 7, 1000, 12, 12, 100]
    assert [None if r.k is None else float(r.k) for r in got] == [None, None, None, 12.0, 7.0, 1000.0, 12.0, 12.5, 100.0]
    times = spark.createDataFrame([("2024-01-01 10:00:0Z",), ("2024-01-01 10:00:00",)], "c string")
    assert [r[0] is None for r in times.select(cells.local_time_to_utc(F.col("c"))).collect()] == [True, False]
