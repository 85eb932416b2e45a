"""Row checks: typed values, the first error of each row, and the quarantine split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weighbridge.functions import cells
from weighbridge.operators.skew import SALTS
from weighbridge.schemas import MEASURE_COLUMNS, RAW_COLUMNS, STATUSES

# Error codes of a quarantined row.
REQUIRED, INVALID, OUT_OF_RANGE, CONSTRAINT = "REQUIRED", "INVALID", "OUT_OF_RANGE", "CONSTRAINT"

VALUE_COLUMNS = ["transact_no", "scale_name", *MEASURE_COLUMNS]


# Rules in reading order, each with the field it reports and the raw cell behind it. The
# number of the first broken rule travels with the row; the words are only put together
# for the rows in quarantine.
_INT, _TEXT, _KG, _CLOSED, _VALUE = "int", "text", "kg", "closed", "value"
RULES = [
    ("TransactNo", "transact_raw", _INT, None),
    ("Scale Name", "scale_raw", _TEXT, None),
    ("CylSize", "cyl_raw", _KG, ""),
    ("TareWeight", "tare_raw", _KG, " - expected numeric value"),
    ("Fill kgs", "fill_raw", _KG, " - expected numeric value"),
    ("Residual", "residual_raw", _KG, " - expected numeric value"),
    ("Success", "success_raw", _CLOSED, " - expected Y/N or True/False"),
    ("Date Time Start", "started_raw", _CLOSED, " - expected format 'YYYY-MM-DD HH:MM:SS'"),
    ("Fill Time", "fill_time_raw", _INT, None),
    ("transact_no", "transact_raw", _VALUE, "Transaction number must be positive"),
    ("fill_time_seconds", "fill_time_raw", _VALUE, "Fill time cannot be negative"),
]


def _text(raw: str) -> Column:
    return F.col(f"_{raw}")


def row_first_error() -> Column:
    """Number of the first broken rule: cells in reading order, then value rules."""
    unread = lambda value, text: F.col(value).isNull() & ~cells.is_blank(text)
    broken = [
        F.col("transact_no").isNull(),
        F.col("scale_name").isNull(),
        unread("cyl_size_kg", _text("cyl_raw")),
        unread("tare_weight_kg", _text("tare_raw")),
        unread("fill_kg", _text("fill_raw")),
        unread("residual_kg", _text("residual_raw")),
        F.col("success").isNull(),
        F.col("started_at").isNull(),
        F.col("fill_time_seconds").isNull(),
        *row_constraints(),
    ]
    number = F.when(broken[0], 0)
    for i, rule in enumerate(broken[1:], start=1):
        number = number.when(rule, i)
    return number


def row_constraints() -> list[Column]:
    """Rules on the parsed values; asked only when every cell parsed."""
    return [F.col("transact_no") <= 0, F.col("fill_time_seconds") < 0]


def normalize_rows(raw: DataFrame) -> DataFrame:
    """Typed values and the first error of every raw row, in one narrow pass.

    Keeps the other columns and replaces the raw cells by the values, ``error_rule`` (NULL
    on a good row) and ``raw_value``, the cell that broke the rule. The values leave
    through a one-element ``inline``: filters on the verdict stay above it, so no cell is
    parsed once for the filter and again for the result.
    """
    kept = [c for c in raw.columns if c not in RAW_COLUMNS]
    texts = {c: cells.strip_text(F.col(c)) for c in RAW_COLUMNS}
    texts |= {c: cells.without_unit(texts[c]) for c in ("tare_raw", "fill_raw", "residual_raw")}
    stripped = raw.select(*kept, *RAW_COLUMNS, *[text.alias(f"_{c}") for c, text in texts.items()])
    valued = stripped.select(
        "*",
        cells.int_of(_text("transact_raw")).alias("transact_no"),
        F.nullif(_text("scale_raw"), F.lit("")).alias("scale_name"),
        cells.kg_of(_text("cyl_raw")).alias("cyl_size_kg"),
        cells.kg_of(_text("tare_raw")).alias("tare_weight_kg"),
        cells.kg_of(_text("fill_raw")).alias("fill_kg"),
        cells.kg_of(_text("residual_raw")).alias("residual_kg"),
        cells.flag_of(_text("success_raw")).alias("success"),
        cells.to_utc(cells.local_time_of(_text("started_raw"))).alias("started_at"),
        cells.int_of(_text("fill_time_raw"), "int").alias("fill_time_seconds"),
    )
    judged = valued.select("*", row_first_error().alias("error_rule"))
    rule = F.col("error_rule")
    raw_value = reduce(
        lambda case, i: case.when(rule == i, F.col(RULES[i][1])),
        range(1, len(RULES)),
        F.when(rule == 0, F.col(RULES[0][1])),
    )
    verdict = F.struct(*VALUE_COLUMNS, "error_rule", raw_value.alias("raw_value"))
    return judged.select(*kept, F.inline(F.array(verdict)))


def row_error() -> Column:
    """Field, code, words and cell of the broken rule of a quarantined row."""
    raw, text = F.coalesce(F.col("raw_value"), F.lit("")), cells.strip_text(F.col("raw_value"))
    blank = cells.is_blank(text)
    code, detail = None, None
    for i, (field, _, kind, why) in enumerate(RULES):
        invalid = lambda *said, f=field: F.concat(F.lit(f"Invalid {f}: '"), raw, F.lit("'"), *said)
        number = cells.without_unit(text) if field != "CylSize" else text
        ranged = F.when(cells.is_number_like(number), OUT_OF_RANGE).otherwise(INVALID)
        is_required = f"{field} is required"
        if kind == _INT:
            unreadable = F.concat(F.lit(" - could not convert string to float: '"), text, F.lit("'"))
            case = (
                F.when(blank, REQUIRED).when(cells.is_number_like(text), OUT_OF_RANGE).otherwise(INVALID),
                F.when(blank, invalid(F.lit(f" - {is_required}")))
                .when(cells.is_number_like(text), invalid(F.lit(" - number out of range")))
                .otherwise(invalid(unreadable)),
            )
        elif kind == _TEXT:
            case = F.lit(REQUIRED), F.lit(is_required)
        elif kind == _KG:
            case = ranged, invalid(F.lit(why))
        elif kind == _CLOSED:
            case = (
                F.when(blank, REQUIRED).otherwise(INVALID),
                F.when(blank, is_required).otherwise(invalid(F.lit(why))),
            )
        else:
            case = F.lit(CONSTRAINT), F.lit(why)
        mine = F.col("error_rule") == i
        code = F.when(mine, case[0]) if code is None else code.when(mine, case[0])
        detail = F.when(mine, case[1]) if detail is None else detail.when(mine, case[1])
    fields = F.array(*[F.lit(field) for field, *_ in RULES])
    return F.struct(
        F.get(fields, F.col("error_rule")).alias("field"),
        code.alias("code"),
        detail.alias("detail"),
        F.col("raw_value").alias("raw_value"),
    )


def row_error_message(row_number: Column, error: Column) -> Column:
    return F.format_string("Row %d: %s", row_number, error["detail"])


def valid_part(rows: DataFrame) -> DataFrame:
    """Good rows with their values."""
    return rows.filter(F.col("error_rule").isNull()).drop("error_rule", "raw_value")


def quarantine(rows: DataFrame) -> DataFrame:
    """Bad rows, with ``row_error`` in place of the values."""
    bad = rows.filter(F.col("error_rule").isNotNull()).withColumn("row_error", row_error())
    return bad.drop("error_rule", "raw_value", *VALUE_COLUMNS)


def split_valid_invalid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_part(rows), quarantine(rows)


def error_summary(
    errors: DataFrame, file_key: str, order: list[str], first: int = 3, message: Column | None = None
) -> DataFrame:
    """Per file: error count and its first messages, from one pass over the errors.

    The errors of a file are first ranked in SALTS parts, which leave ``first`` rows and a
    count each; so a file that owns most errors is no single sort. ``message`` is only
    put together for the rows that are left (default: the column of that name).
    """
    message = F.col("message") if message is None else message
    part = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    ours, whole = Window.partitionBy(file_key, "_part"), Window.partitionBy(file_key)
    leading = (
        errors.withColumn("_part", part)
        .withColumn("_rank", F.row_number().over(ours.orderBy(*order)))
        .withColumn("_count", F.count("*").over(ours))
        .filter(F.col("_rank") <= first)
        .withColumn("_place", F.row_number().over(whole.orderBy(*order)))
        .withColumn("error_count", F.sum(F.when(F.col("_rank") == 1, F.col("_count"))).over(whole))
        .filter(F.col("_place") <= first)
        .select(file_key, "error_count", "_place", message.alias("_message"))
    )
    ranked = F.array_sort(F.collect_list(F.struct("_place", "_message")))
    return leading.groupBy(file_key, "error_count").agg(ranked.alias("_first")).select(
        file_key, "error_count", F.col("_first._message").alias("first_errors")
    )


def status_domain(files: DataFrame) -> DataFrame:
    """Files per status and whether the status is a known one."""
    return files.groupBy("status").agg(F.count("*").alias("files")).select(
        "status", F.coalesce(F.col("status").isin(STATUSES), F.lit(False)).alias("known"), "files"
    )


def orphan_rows(rows: DataFrame, files: DataFrame, row_key: str, file_key: str) -> DataFrame:
    """Rows whose file does not exist; must be empty."""
    return rows.join(
        files.select(F.col(file_key).alias(row_key)), row_key, "left_anti"
    )
