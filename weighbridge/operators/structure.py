"""File checks made on the content column alone, before any row is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.functions.values import sha256_hex
from weighbridge.schemas import RAW_COLUMNS, REQUIRED_HEADERS

# Messages of the file checks.
NOT_UTF8 = "CSV file is not valid UTF-8"
NO_HEADERS = "CSV has no headers"
NO_ROWS = "CSV has no data rows"

# One header record and its cells. Possessive quantifiers, so no backtracking.
_RECORD = r'^(?:[^"\r\n]++|"(?:[^"]++|"")*+(?:"|\z))*+'
_CELL = r',("(?:[^"]++|"")*+(?:"|\z)[^,]*+|[^,]*+)'
_NEWLINES = "\r\n"
# Cells of a row that a CSV scan reads in any case; files with wider rows say how wide.
USUAL_WIDTH = 20_480
# What is known of a file that is too large to travel as one value.
FACTS = "struct<length: bigint, file_sha256: string, valid_utf8: boolean, head: string, more_rows: boolean, widest: bigint>"


def file_text(content: Column) -> Column:
    return content.cast("string")


def valid_utf8(content: Column) -> Column:
    return F.is_valid_utf8(file_text(content))


def header_record(text: Column) -> Column:
    """First record of the text: one line, unless a quoted name spans lines."""
    line = F.substring_index(text, "\n", 1)
    return F.when(
        F.contains(line, F.lit('"')), F.regexp_extract(text, _RECORD, 0)
    ).otherwise(F.rtrim(line, F.lit("\r")))


def header_names(record: Column) -> Column:
    """Names of a header record, untrimmed, with quoting removed."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1))
    unquoted = F.transform(
        cells,
        lambda x: F.when(
            x.startswith('"'),
            F.replace(F.regexp_replace(x, r'^"|"$', ""), F.lit('""'), F.lit('"')),
        ).otherwise(x),
    )
    return F.when(F.contains(record, F.lit('"')), unquoted).otherwise(F.split(record, ","))


def has_header(record: Column) -> Column:
    return record != ""


def missing_columns(names: Column) -> Column:
    """Required names that the header lacks, sorted."""
    required = F.array(*[F.lit(h) for h in REQUIRED_HEADERS])
    return F.array_sort(F.array_except(required, names))


def has_rows(text: Column, record: Column) -> Column:
    """True when anything but line ends follows the header record."""
    rest = F.substring(text, F.length(record) + 1, F.length(text))
    return F.trim(rest, F.lit(_NEWLINES)) != ""


def header_positions(names: Column) -> Column:
    """Place of each required column, from 0; the last one wins if a name repeats."""
    backwards = F.reverse(names)
    place = lambda h: F.size(names) - F.array_position(backwards, h).cast("int")
    return F.struct(*[place(h).alias(c) for h, c in REQUIRED_HEADERS.items()])


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def widest_row(text: Column) -> Column:
    """Cells of the widest row or more; 0 if no row can be wider than usual.

    Rows are lines, once as they are and once without their quoted parts, which may hold
    line ends. A stray quote spoils the second reading only.
    """

    def widest_line(t: Column) -> Column:
        long = F.filter(F.split(t, r"[\r\n]+"), lambda line: F.length(line) >= USUAL_WIDTH)
        return F.coalesce(F.array_max(F.transform(long, lambda line: _commas(line) + 1)), F.lit(0))

    unquoted = F.when(F.contains(text, F.lit('"')), widest_line(F.regexp_replace(text, '"[^"]*+"', "")))
    return F.when(_commas(text) >= USUAL_WIDTH, F.greatest(widest_line(text), unquoted)).otherwise(0).cast("bigint")


def file_inventory(files: DataFrame) -> DataFrame:
    """Identity and structure of each file, without its content.

    The structure errors follow one rule each: a bad encoding or an absent header
    stops the check, missing columns and missing rows add up. A file that is too large to
    carry its content has ``facts`` (``FACTS``) instead.
    """
    if "facts" not in files.columns:
        files = files.withColumn("facts", F.lit(None).cast(FACTS))
    fact = lambda name, own: F.coalesce(own, F.col(f"facts.{name}")).alias(name)
    text = F.coalesce(file_text(F.col("content")), "facts.head")
    read = files.select(
        *[c for c in files.columns if c not in ("content", "length", "facts")],
        fact("length", F.length("content").cast("bigint")),
        fact("file_sha256", sha256_hex(F.col("content"))),
        fact("valid_utf8", valid_utf8(F.col("content"))),
        header_record(text).alias("header"),
        (has_rows(text, header_record(text)) | F.coalesce("facts.more_rows", F.lit(False))).alias("has_rows"),
        fact("widest", widest_row(file_text(F.col("content")))),
    ).withColumn("names", header_names(F.col("header")))
    missing = missing_columns(F.col("names"))
    named = F.concat(
        F.lit("Missing required columns: {'"), F.array_join(missing, "', '"), F.lit("'}")
    )
    found = (
        F.when(~F.col("valid_utf8"), F.array(F.lit(NOT_UTF8)))
        .when(~has_header(F.col("header")), F.array(F.lit(NO_HEADERS)))
        .otherwise(
            F.array_compact(
                F.array(
                    F.when(F.size(missing) > 0, named),
                    F.when(~F.col("has_rows"), F.lit(NO_ROWS)),
                )
            )
        )
    )
    return read.withColumn("missing", missing).withColumn("structure_errors", found)


def unreadable(errors: Column) -> Column:
    """True when rows cannot be read by name at all; no rows is not such an error."""
    return F.size(F.array_except(errors, F.array(F.lit(NO_ROWS)))) > 0


def file_structure(files: DataFrame) -> DataFrame:
    """Verdict per file: ok flag and the joined errors."""
    return file_inventory(files).select(
        "path",
        (F.size("structure_errors") == 0).alias("structure_ok"),
        F.array_join("structure_errors", "; ").alias("structure_error"),
    )


def cells_by_name(cells: Column, positions: Column) -> list[Column]:
    """The nine required cells out of a positional row; a short row gives NULL."""
    return [F.get(cells, positions[c]).alias(c) for c in RAW_COLUMNS]
