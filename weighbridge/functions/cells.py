"""Cell rules: text of one cell to one typed value, as built-in column expressions.

Every ``parse_*`` function gives NULL both for a blank optional cell and for a bad
one; ``weighbridge.operators.rows`` tells the two apart. Common spellings take a
cheap cast, and only the rest reach the regular expressions.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from weighbridge.schemas import LOCAL_ZONE

# Every character that counts as white space around a cell.
ASCII_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
WHITE_SPACE = ASCII_SPACE + "\x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Spellings of a number, of a non-finite number, and of the two flags.
_DIGITS = r"\d+(_?\d+)*"
NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
NON_FINITE = r"(?i)^[+-]?(inf|infinity|nan)$"
TRUE_WORDS = ["Y", "YES", "TRUE", "1"]
FALSE_WORDS = ["N", "NO", "FALSE", "0"]

# Spellings that a cast reads as the number rule does. A cast alone accepts more: control
# characters around a number, or a zone after a time.
_PLAIN_INT = r"^[+-]?\d{1,15}$"
_PLAIN_KG = r"^[+-]?\d{1,9}(\.\d{1,3})?$"
_PLAIN_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Decimal digits of all scripts but the first, and the digits they stand for.
_OTHER_DIGITS = "".join(chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Nd")
_THEIR_VALUES = "".join(str(unicodedata.digit(c)) for c in _OTHER_DIGITS)
_LOOSE_TIME = r"^(\d{4})-(\d{1,2})-(\d{1,2}| [1-9])\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"


def strip_text(c: Column) -> Column:
    """Cell without surrounding white space of any kind; the short list does for ASCII."""
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, F.trim(c, F.lit(ASCII_SPACE))).otherwise(F.trim(c, F.lit(WHITE_SPACE)))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_number_like(text: Column) -> Column:
    """True for anything that reads as a number, infinities and NaN included."""
    return ascii_digits(text).rlike(NUMBER) | text.rlike(NON_FINITE)


def ascii_digits(text: Column) -> Column:
    """The text with the digits of other scripts replaced by the common ones."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, text).otherwise(F.translate(text, _OTHER_DIGITS, _THEIR_VALUES))


def _double_of(text: Column) -> Column:
    digits = ascii_digits(text)
    return F.when(digits.rlike(NUMBER), F.replace(digits, F.lit("_"), F.lit("")).try_cast("double"))


def int_of(text: Column, type_name: str = "bigint") -> Column:
    """Whole part of a stripped number, truncated toward zero; out of range is NULL."""
    plain = F.when(text.rlike(_PLAIN_INT), text.try_cast(type_name))
    return F.coalesce(plain, _double_of(text).try_cast(type_name))


def float_of(text: Column) -> Column:
    return _double_of(text)


def kg_of(text: Column) -> Column:
    """Stripped number as kilograms with three decimals; out of range is NULL."""
    plain = F.when(text.rlike(_PLAIN_KG), text.try_cast("decimal(10,3)"))
    return F.coalesce(plain, quantize_kg(_double_of(text)))


def without_unit(text: Column) -> Column:
    """Stripped cell without any lower-case ``kg``."""
    return F.when(
        F.contains(text, F.lit("kg")), strip_text(F.replace(text, F.lit("kg"), F.lit("")))
    ).otherwise(text)


def flag_of(text: Column) -> Column:
    word = F.upper(text)
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def local_time_of(text: Column) -> Column:
    """Stripped wall-clock text as a time without zone; loose padding is accepted."""
    part = lambda i: F.lpad(F.trim(F.regexp_extract(text, _LOOSE_TIME, i)), 2, "0")
    padded = F.concat(
        F.regexp_extract(text, _LOOSE_TIME, 1), F.lit("-"), part(2), F.lit("-"), part(3),
        F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":"), part(6),
    )
    dated = ~text.startswith("0000")
    plain = F.when(text.rlike(_PLAIN_TIME) & dated, text.try_cast("timestamp_ntz"))
    return F.coalesce(
        plain, F.when(text.rlike(_LOOSE_TIME) & dated, padded.try_cast("timestamp_ntz"))
    )


def to_utc(local: Column) -> Column:
    return F.convert_timezone(F.lit(LOCAL_ZONE), F.lit("UTC"), local)


# The same rules on an unstripped cell.


def parse_required_int(c: Column) -> Column:
    return int_of(strip_text(c))


def parse_optional_float(c: Column) -> Column:
    return float_of(strip_text(c))


def parse_weight_kg(c: Column) -> Column:
    return float_of(without_unit(strip_text(c)))


def parse_required_text(c: Column) -> Column:
    return F.nullif(strip_text(c), F.lit(""))


def parse_flag(c: Column) -> Column:
    return flag_of(strip_text(c))


def local_time_to_utc(c: Column) -> Column:
    return to_utc(local_time_of(strip_text(c)))


def quantize_kg(c: Column) -> Column:
    """Number stored with three decimals, half up; what does not fit is NULL."""
    return c.try_cast("decimal(10,3)")
