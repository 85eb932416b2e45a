"""Small value rules: ids, labels, buckets, rates, times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weighbridge.functions.cells import strip_text
from weighbridge.schemas import DEFAULT_SOURCE, STATUS_LABELS, UNKNOWN_STATUS_LABEL

# Recency buckets.
JUST_NOW, RECENT, OLDER = "JUST NOW", "RECENT", "OLDER"


def as_of_time(as_of: Column | str | None = None) -> Column:
    """The report's ``now`` as UTC; the current time unless the caller fixes one."""
    if as_of is None:
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz")
    return as_of


def before(as_of: Column, **units: int) -> Column:
    """``as_of`` minus days, hours or mins."""
    return as_of - F.make_dt_interval(**{k: F.lit(v) for k, v in units.items()})


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def hash_prefix(hex_hash: Column) -> Column:
    return F.left(hex_hash, F.lit(16))


def derived_id(*identity: Column) -> Column:
    """Row id that depends only on what the row is, so a replay gives it again."""
    return F.xxhash64(*identity)


def correlation_id(*identity: Column) -> Column:
    """UUID-shaped id made from the identity's hash; stable over retries."""
    h = F.sha2(F.concat_ws("|", *[i.cast("string") for i in identity]), 256)
    cut = lambda start, n: F.substring(h, start, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


# Spellings of a message date after its weekday and comment are dropped.
_MAIL_TIMES = ["d MMM yyyy H:m:s", "d MMM yyyy H:m", "d MMM yy H:m:s", "d MMM yy H:m"]
_ISO_TIMES = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm"]
# Zone names that mail dates may carry.
_MAIL_ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_ZONE = r"([+-]\d{2}):?(\d{2})$"
_FRACTION = r"(:\d{2})\.\d+"


def parse_message_date(c: Column) -> Column:
    """Mail date, else ISO date, as UTC; NULL for anything else and never an error."""
    text = strip_text(c)
    text = F.regexp_replace(text, r"\s*\([^)]*\)$", "")
    text = F.regexp_replace(text, r"^[A-Za-z]{3,9},?\s*(?=\d)", "")
    text = F.regexp_replace(text, r"(?<=\d)Z$", " Z")
    text = F.regexp_replace(text, _FRACTION, "$1")
    text = F.regexp_replace(text, r"^(\d{1,2})[- ]([A-Za-z]{3})[- ]", "$1 $2 ")
    zone_word = F.regexp_extract(text, r"\s([A-Za-z]{1,5})$", 1)
    named = F.create_map(*[F.lit(x) for pair in _MAIL_ZONES.items() for x in pair])
    digits = F.regexp_extract(text, r"([+-]\d{2}:?\d{2})$", 1)
    # A date such as 2026-02-08 ends in digits that look like a zone but follow no time.
    timed = text.rlike(r":\d{2}\s*[+-]\d{2}:?\d{2}$")
    zone = (
        F.when(timed, F.replace(digits, F.lit(":"), F.lit("")))
        .when(zone_word != "", F.coalesce(F.try_element_at(named, F.upper(zone_word)), F.lit("+0000")))
        .otherwise(F.lit("+0000"))
    )
    clock = (
        F.when(timed, F.rtrim(F.regexp_replace(text, r"\s*[+-]\d{2}:?\d{2}$", "")))
        .when(zone_word != "", F.rtrim(F.regexp_replace(text, r"\s[A-Za-z]{1,5}$", "")))
        .otherwise(text)
    )
    clock = F.regexp_replace(clock, r"\s+", " ")
    instants = [
        F.try_to_timestamp(F.concat(clock, F.lit(" "), zone), F.lit(f"{p} Z"))
        for p in [*_MAIL_TIMES, *_ISO_TIMES]
    ]
    moment = F.coalesce(*instants)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def is_csv_name(c: Column) -> Column:
    return F.lower(c).endswith(".csv")


def default_source(c: Column) -> Column:
    return F.coalesce(c, F.lit(DEFAULT_SOURCE))


def recency_bucket(created_at: Column, as_of: Column) -> Column:
    return (
        F.when(created_at > before(as_of, mins=5), JUST_NOW)
        .when(created_at > before(as_of, hours=1), RECENT)
        .otherwise(OLDER)
    )


def status_label(status: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, status), F.lit(UNKNOWN_STATUS_LABEL))


def shorten(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def rank_label(rank: Column) -> Column:
    return (
        F.when(rank == 1, "1st").when(rank == 2, "2nd").when(rank == 3, "3rd")
        .otherwise(F.when(rank < 10, F.lpad(rank.cast("string"), 2, " ")).otherwise(rank.cast("string")))
    )


def rounded_ratio(part: Column, whole: Column, places: int, factor: int = 1) -> Column:
    """part * factor / whole to ``places`` decimals, exact half up; NULL when whole is 0.

    Both sides are whole numbers, so no binary fraction is ever rounded: half up of a/n
    is (2a + n) div 2n.
    """
    a = F.abs(part).cast("decimal(30,0)") * F.lit(factor * 10**places)
    n = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    units = F.call_function("div", a * F.lit(2) + n, n * F.lit(2))
    signed = F.when(part < 0, -units).otherwise(units)
    return (signed / F.lit(10**places)).cast(f"decimal(18,{places})")


def mean_kg(total: Column, count: Column, places: int) -> Column:
    """Mean of ``count`` three-decimal weights with the given exact total."""
    return rounded_ratio(total * F.lit(1000), count * F.lit(1000), places)


def percent_of(part: Column, whole: Column, places: int = 1) -> Column:
    return rounded_ratio(part, whole, places, factor=100)


def hour_of(c: Column) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def day_of(c: Column) -> Column:
    return c.cast("date")


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)
