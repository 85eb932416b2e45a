"""Queries over the driver's tables, each with its oracle: values, rows, files, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import sqltext as q
from registry import views as v
from weighbridge.functions import cells, values
from weighbridge.operators import dedup, outcome, reports, rows, upsert
from weighbridge.operators.skew import cut_lineage
from weighbridge.schemas import KEY_COLUMNS, MEASURE_COLUMNS, RAW_COLUMNS

KEYS = ["file_id", "ln", "pk", "sk", "arrived"]
ROWS_AS_OF = "1995-06-17 00:00:00"

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None):
    def register(make):
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return register


def on_raw(name: str, oracle: str, **outputs):
    """A cell rule over the derived raw rows: one output column per rule."""
    text = q.norm(f"select {q.KEYS}, {oracle} from stripped")

    @query(name, text)
    def _(spark, sf):
        return v.raw_rows(spark, sf).select(*KEYS, *[c().alias(n) for n, c in outputs.items()])


# ---- X: values -------------------------------------------------------------------------

@query(
    "strip_text",
    q.norm(
        f"select {q.KEYS}, {q.strip('chr(9) || chr(31) || scale_raw || chr(13) || chr(10)')} as scale, "
        "ta as tare, su as flag from stripped"
    ),
)
def _(spark, sf):
    return v.raw_rows(spark, sf).select(
        *KEYS,
        cells.strip_text(F.concat(F.lit("\t\x1f"), F.col("scale_raw"), F.lit("\r\n"))).alias("scale"),
        cells.strip_text(F.col("tare_raw")).alias("tare"),
        cells.strip_text(F.col("success_raw")).alias("flag"),
    )


on_raw(
    "parse_required_int",
    f"{q.whole('tn')} as transact_no, {q.whole('ft')} as fill_time",
    transact_no=lambda: cells.parse_required_int(F.col("transact_raw")),
    fill_time=lambda: cells.parse_required_int(F.col("fill_time_raw")),
)
on_raw("parse_optional_float", f"{q.number('cy')} as cyl", cyl=lambda: cells.parse_optional_float(F.col("cyl_raw")))
on_raw(
    "parse_weight_kg",
    f"{q.number(q.unitless('ta'))} as tare, {q.number(q.unitless('fi'))} as fill, {q.number(q.unitless('re'))} as residual",
    tare=lambda: cells.parse_weight_kg(F.col("tare_raw")),
    fill=lambda: cells.parse_weight_kg(F.col("fill_raw")),
    residual=lambda: cells.parse_weight_kg(F.col("residual_raw")),
)
on_raw("parse_required_text", "nullif(sn, '') as scale_name", scale_name=lambda: cells.parse_required_text(F.col("scale_raw")))
on_raw("parse_flag", f"{q.flag('su')} as success", success=lambda: cells.parse_flag(F.col("success_raw")))
on_raw("local_time_to_utc", f"{q.utc('dt')} as started_at", started_at=lambda: cells.local_time_to_utc(F.col("started_raw")))
on_raw(
    "quantize_kg",
    f"{q.kg(q.unitless('fi'))} as fill_kg, {q.kg(q.unitless('ta'))} as tare_kg",
    fill_kg=lambda: cells.quantize_kg(cells.parse_weight_kg(F.col("fill_raw"))),
    tare_kg=lambda: cells.quantize_kg(cells.parse_weight_kg(F.col("tare_raw"))),
)
on_raw(
    "correlation_id",
    q.uuid_of("cast(file_id as varchar) || '|' || cast(ln as varchar)") + " as correlation_id",
    correlation_id=lambda: values.correlation_id(F.col("file_id"), F.col("ln")),
)


@query(
    "sha256_hex",
    "select doc_id, sha256(text) as file_sha256, substr(sha256(text), 1, 16) as prefix from documents",
)
def _(spark, sf):
    h = values.sha256_hex(F.col("text"))
    return v.table(spark, sf, "documents").select(
        "doc_id", h.alias("file_sha256"), values.hash_prefix(h).alias("prefix")
    )


_MONTHS = "'Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec'"
_CLOCK = "lpad(cast(o_orderkey % 24 as string), 2, '0') || ':' || lpad(cast(o_custkey % 60 as string), 2, '0') || ':07'"
_MAIL_DAY = f"cast(day(o_orderdate) as string) || ' ' || split_part({_MONTHS}, ' ', cast(month(o_orderdate) as int)) || ' ' || cast(year(o_orderdate) as string)"
MAIL_DATES = f"""select o_orderkey, cast(cast(o_orderdate as date) as string) as day_text, case o_orderkey % 7
  when 0 then 'Mon, ' || {_MAIL_DAY} || ' ' || {_CLOCK} || ' +0200'
  when 1 then {_MAIL_DAY} || ' ' || {_CLOCK} || ' GMT'
  when 2 then cast(cast(o_orderdate as date) as string) || 'T' || {_CLOCK} || 'Z'
  when 3 then 'Tue, ' || {_MAIL_DAY} || ' ' || {_CLOCK} || ' -0530 (local time)'
  when 4 then 'yesterday, ' || o_orderpriority
  when 5 then cast(cast(o_orderdate as date) as string) || ' ' || {_CLOCK} || '+02:00'
  end as date_text, {_CLOCK} as clock from orders"""


@query(
    "parse_message_date",
    f"""with dated as ({MAIL_DATES}), local as (select *, cast(day_text || ' ' || clock as timestamp) as t from dated)
    select o_orderkey, case o_orderkey % 7 when 0 then t - interval 2 hour when 1 then t when 2 then t
      when 3 then t + interval 330 minute when 5 then t - interval 2 hour end as received_at from local""",
)
def _(spark, sf):
    dated = v._select(v.table(spark, sf, "orders"), "orders", MAIL_DATES)
    return dated.select("o_orderkey", values.parse_message_date(F.col("date_text")).alias("received_at"))


_NAMES = "case o_orderkey % 4 when 0 then 'a' || o_orderkey || '.csv' when 1 then 'B' || o_orderkey || '.CSV' when 2 then 'c.csv.txt' else 'report.pdf' end"


@query("is_csv_name", f"select o_orderkey, lower({_NAMES}) like '%.csv' as is_csv from orders")
def _(spark, sf):
    named = v._select(v.table(spark, sf, "orders"), "orders", f"select o_orderkey, {_NAMES} as name from orders")
    return named.select("o_orderkey", values.is_csv_name(F.col("name")).alias("is_csv"))


@query(
    "default_source",
    "select o_orderkey, coalesce(nullif(o_orderpriority, '1-URGENT'), 'imap') as source from orders",
)
def _(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey", values.default_source(F.nullif("o_orderpriority", F.lit("1-URGENT"))).alias("source")
    )


@query(
    "recency_bucket",
    q.files(
        f"select id, case when created_at > {q.NOW} - interval 5 minute then 'JUST NOW' "
        f"when created_at > {q.NOW} - interval 1 hour then 'RECENT' else 'OLDER' end as time_status from files"
    ),
)
def _(spark, sf):
    bucket = values.recency_bucket(F.col("created_at"), values.as_of_time(v.AS_OF))
    return v.activity_files(spark, sf).select("id", bucket.alias("time_status"))


@query(
    "status_label",
    q.files(
        "select id, case status when 'COMPLETED' then '[OK]' when 'FAILED' then '[FAIL]' when 'NEW' then '[NEW]' "
        "when 'DUPLICATE' then '[DUP]' else '[?]' end as label from files"
    ),
)
def _(spark, sf):
    return v.activity_files(spark, sf).select("id", values.status_label(F.col("status")).alias("label"))


@query(
    "shorten",
    "select doc_id, case when length(text) > 25 then substr(text, 1, 25) || '...' else text end as short_text, "
    "case when length(source) > 15 then substr(source, 1, 15) || '...' else source end as short_source from documents",
)
def _(spark, sf):
    return v.table(spark, sf, "documents").select(
        "doc_id",
        values.shorten(F.col("text"), 25).alias("short_text"),
        values.shorten(F.col("source"), 15).alias("short_source"),
    )


_RANK = "case place when 1 then '1st' when 2 then '2nd' when 3 then '3rd' else case when place < 10 then ' ' else '' end || place end"


@query(
    "rank_label",
    q.current(
        f"select scale_name, rows_of_scale, {_RANK} as rank from (select *, row_number() over (order by rows_of_scale desc, scale_name) as place "
        "from (select scale_name, count(*) as rows_of_scale from current group by 1)) where place <= 10"
    ),
)
def _(spark, sf):
    from pyspark.sql import Window

    counted = v.transactions(spark, sf).groupBy("scale_name").agg(F.count("*").alias("rows_of_scale"))
    top = counted.orderBy(F.desc("rows_of_scale"), "scale_name").limit(10)
    place = F.row_number().over(Window.orderBy(F.desc("rows_of_scale"), "scale_name"))
    return top.select("scale_name", "rows_of_scale", values.rank_label(place).alias("rank"))


@query(
    "percent_of",
    q.files(
        f"select from_email, {q.percent(q.count_if(chr(39).join(['status = ', 'COMPLETED', ''])), 'count(*)', 1)} as rate, "
        f"{q.percent('0', '(count(*) - count(*))', 2)} as rate_of_nothing from files group by 1"
    ),
)
def _(spark, sf):
    done = F.count_if(F.col("status") == "COMPLETED")
    n = F.count("*")
    return v.activity_files(spark, sf).groupBy("from_email").agg(
        values.percent_of(done, n, 1).alias("rate"),
        values.percent_of(F.lit(0), n - n, 2).alias("rate_of_nothing"),
    )


@query(
    "hour_and_day_of",
    q.files("select id, date_trunc('hour', created_at) as hour, cast(created_at as date) as day from files"),
)
def _(spark, sf):
    at = F.col("created_at")
    return v.activity_files(spark, sf).select("id", values.hour_of(at).alias("hour"), values.day_of(at).alias("day"))


@query(
    "elapsed_seconds",
    q.files("select id, epoch_us(processing_completed_at) / 1e6 - epoch_us(processing_started_at) / 1e6 as seconds from files"),
)
def _(spark, sf):
    took = values.elapsed_seconds(F.col("processing_started_at"), F.col("processing_completed_at"))
    return v.activity_files(spark, sf).select("id", took.alias("seconds"))


# ---- V: rows ---------------------------------------------------------------------------


@query("row_first_error", q.norm(f"select {q.KEYS}, rule as error_rule from judged"))
def _(spark, sf):
    return v.normalized(spark, sf).select(*KEYS, "error_rule")


@query(
    "row_constraints",
    q.norm(
        "select field, cast(count(*) as bigint) as refused from bad where code = 'CONSTRAINT' group by 1"
    ),
)
def _(spark, sf):
    bad = rows.quarantine(v.normalized(spark, sf))
    return (
        bad.select("row_error.*").filter(F.col("code") == rows.CONSTRAINT)
        .groupBy("field").agg(F.count("*").alias("refused"))
    )


def _messages(spark, sf):
    bad = rows.quarantine(v.normalized(spark, sf))
    return bad.withColumn("message", rows.row_error_message(F.col("ln"), F.col("row_error")))


@query(
    "row_error_message",
    q.norm(f"select {q.KEYS}, field, code, raw_value, 'Row ' || ln || ': ' || detail as message from bad"),
)
def _(spark, sf):
    return _messages(spark, sf).select(
        *KEYS, "row_error.field", "row_error.code", "row_error.raw_value", "message"
    )


@query(
    "split_valid_invalid",
    q.norm(
        "select 'valid' as part, cast(count(*) as bigint) as n from valid union all select 'quarantine', count(*) from bad"
    ),
)
def _(spark, sf):
    good, bad = rows.split_valid_invalid(v.normalized(spark, sf))
    counted = [
        part.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        for name, part in (("valid", good), ("quarantine", bad))
    ]
    return counted[0].union(counted[1])


_SUMMARY_ORDER = ["ln", "arrived", "pk", "file_id"]


@query(
    "error_summary",
    q.norm(
        """select sk, cast(count(*) as bigint) as error_count,
        string_agg(message, '; ' order by place) filter (where place <= 3) as first_errors from (select sk,
        'Row ' || ln || ': ' || detail as message,
        row_number() over (partition by sk order by ln, arrived, pk, file_id) as place from bad) group by sk"""
    ),
)
def _(spark, sf):
    bad = v.normalized(spark, sf).filter(F.col("error_rule").isNotNull())
    narrow = bad.select("sk", *_SUMMARY_ORDER, "error_rule", "raw_value")
    message = rows.row_error_message(F.col("ln"), rows.row_error())
    return rows.error_summary(narrow, "sk", _SUMMARY_ORDER, message=message).withColumn(
        "first_errors", F.array_join("first_errors", "; ")
    )


@query("normalize_rows", q.norm(f"select {q.KEYS}, {q.VALUES}, rule as error_rule from judged"))
def _(spark, sf):
    return v.normalized(spark, sf).select(*KEYS, *rows.VALUE_COLUMNS, "error_rule")


@query(
    "status_domain",
    f"with {q.PARENTS}, seen as (select case when id % 11 = 0 then 'LOST' else status end as status from parents) "
    "select status, status in ('NEW','PROCESSING','COMPLETED','FAILED','DUPLICATE') as known, "
    "cast(count(*) as bigint) as files from seen group by 1",
)
def _(spark, sf):
    seen = v.parent_files(spark, sf).withColumn(
        "status", F.when(F.col("id") % 11 == 0, "LOST").otherwise(F.col("status"))
    )
    return rows.status_domain(seen)


@query(
    "orphan_rows",
    f"with {q.PARENTS} select l_orderkey, l_linenumber, l_partkey from lineitem "
    "where not exists (select 1 from parents where id = l_orderkey and status <> 'FAILED')",
)
def _(spark, sf):
    kept = v.parent_files(spark, sf).filter(F.col("status") != "FAILED")
    found = rows.orphan_rows(v.table(spark, sf, "lineitem"), kept, "l_orderkey", "id")
    return found.select("l_orderkey", "l_linenumber", "l_partkey")


# ---- D: file de-duplication --------------------------------------------------------------

_ARRIVALS = """arrivals as (select 'doc/' || lpad(cast(doc_id as varchar), 12, '0') as path, 0 as part_index, source,
  make_timestamp(2024, 1, cast(doc_id % 28 + 1 as bigint), 0, 0, 0.0) as received_at, sha256(text) as file_sha256 from documents),
  placed as (select *, row_number() over (partition by file_sha256 order by received_at, path) as place,
  first_value(source) over (partition by file_sha256 order by received_at, path) as first_source,
  count(*) over (partition by file_sha256) as copies from arrivals)"""


def _hashed(spark, sf):
    return v.document_arrivals(spark, sf).select(
        "path", "part_index", "source", "received_at", values.sha256_hex(F.col("content")).alias("file_sha256")
    )


# The history of the D2 and D4 checks: what one of the sources delivered.
_HISTORY = "history as (select distinct file_sha256 from arrivals where source = (select min(source) from arrivals))"


def _history(hashed):
    least = hashed.agg(F.min("source").alias("source"))
    known = hashed.join(F.broadcast(least), "source", "left_semi").select("file_sha256").distinct()
    status = F.when(F.col("file_sha256") < "8", "FAILED").otherwise("COMPLETED")
    return known.select("file_sha256", upsert.file_id(F.col("file_sha256")).alias("id"), status.alias("status"))


@query(
    "dedup_files_in_batch",
    f"with {_ARRIVALS} select path, source, received_at, file_sha256 from placed where place = 1",
)
def _(spark, sf):
    return dedup.dedup_files_in_batch(_hashed(spark, sf)).drop("part_index")


@query(
    "dedup_files_in_history",
    f"with {_ARRIVALS}, {_HISTORY} select path, file_sha256 from arrivals "
    "where file_sha256 not in (select file_sha256 from history)",
)
def _(spark, sf):
    hashed = cut_lineage(_hashed(spark, sf))
    return dedup.dedup_files_in_history(hashed, _history(hashed)).select("path", "file_sha256")


@query(
    "duplicate_files",
    f"with {_ARRIVALS} select path, file_sha256, received_at, cast(copies as bigint) as copies from placed where copies > 1",
)
def _(spark, sf):
    found = dedup.duplicate_files(_hashed(spark, sf), newest="received_at", row_id="path")
    return found.select("path", "file_sha256", "received_at", "copies")


@query(
    "duplicate_verdict",
    f"""with {_ARRIVALS}, {_HISTORY} select path, p.file_sha256,
    case when h.file_sha256 is null and place = 1 then 'NEW' else 'DUPLICATE' end as status,
    case when h.file_sha256 is not null then case when h.file_sha256 < '8' then 'FAILED' else 'COMPLETED' end
      when place > 1 then 'NEW' end as original_status
    from placed p left join history h using (file_sha256)""",
)
def _(spark, sf):
    hashed = cut_lineage(_hashed(spark, sf))
    judged = dedup.duplicate_verdict(hashed, _history(hashed))
    return judged.select("path", "file_sha256", "status", "original_status")


# ---- J: insert, upsert, retention ----------------------------------------------------------


@query(
    "insert_file_lookup_id",
    f"with {_ARRIVALS} select file_sha256, cast(count(*) as bigint) as arrivals, cast(1 as bigint) as ids from arrivals group by 1",
)
def _(spark, sf):
    stored = upsert.insert_file_lookup_id(_hashed(spark, sf))
    return stored.groupBy("file_sha256").agg(
        F.count("*").alias("arrivals"), F.count_distinct("id").alias("ids")
    )


@query(
    "rows_with_file_id",
    q.norm(
        "select file_id, ln, pk, sk, filename, id as ingestion_file_id from valid join parents on id = file_id "
        "where status = 'COMPLETED'",
        q.PARENTS,
    ),
)
def _(spark, sf):
    done = v.parent_files(spark, sf).filter(F.col("status") == "COMPLETED").withColumnRenamed("filename", "name")
    named = done.withColumn("filename", F.col("name"))
    lines = v.valid_rows(spark, sf).withColumn("filename", F.concat(F.lit("order_"), "file_id", F.lit(".csv")))
    return upsert.rows_with_file_id(lines, named, "filename").select(
        "file_id", "ln", "pk", "sk", "filename", "ingestion_file_id"
    )


_CURRENT_COLUMNS = [*KEY_COLUMNS, *MEASURE_COLUMNS, "ingestion_file_id", "created_at", "updated_at", "correlation_id"]
_UUID = q.uuid_of("scale_name || '|' || transact_no")


@query(
    "upsert_latest",
    q.current(f"select {', '.join(_CURRENT_COLUMNS[:-1])}, {_UUID} as correlation_id from current"),
)
def _(spark, sf):
    return v.transactions(spark, sf).select(*_CURRENT_COLUMNS)


def _clean_files(spark, sf):
    """Rows of the files that have no bad row, as the strict policy sees them."""
    seen = v.normalized(spark, sf)
    bad = seen.filter(F.col("error_rule").isNotNull()).select("file_id").distinct()
    return seen.join(bad, "file_id", "left_anti").drop("error_rule", "raw_value")


@query(
    "insert_only_unique",
    q.norm(
        """select file_id, scale_name, transact_no, fill_kg, success from valid
        where file_id not in (select file_id from bad) and file_id not in
        (select file_id from valid group by file_id, scale_name, transact_no having count(*) > 1)"""
    ),
)
def _(spark, sf):
    kept = upsert.insert_only_unique(_clean_files(spark, sf), "file_id", ["file_id"])
    return kept.select("file_id", *KEY_COLUMNS, "fill_kg", "success")


@query("insert_only_unique_contended", None)
def _(spark, sf):
    """Keys that several files claim: only waves of decisions give the answer."""
    claims = v.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file_id"),
        (F.col("l_suppkey") % 10).alias("scale_name"),
        F.col("l_partkey").alias("transact_no"),
    )
    return upsert.insert_only_unique(claims, "file_id", ["file_id"])


@query(
    "upsert_counts",
    q.norm(
        "select sk, cast(count(*) as bigint) as rows_touched from (select distinct sk, scale_name, transact_no from valid) group by 1"
    ),
)
def _(spark, sf):
    return upsert.upsert_counts(v.valid_rows(spark, sf), "sk")


_RETAIN_AS_OF = "1996-07-01 00:00:00"
_KEPT = f"""kept as (select * from parents where not (status in ('COMPLETED','FAILED')
  and created_at < timestamp '{_RETAIN_AS_OF}' - interval 30 day))"""


def _kept(spark, sf):
    return upsert.retention_cleanup(v.parent_files(spark, sf), values.as_of_time(_RETAIN_AS_OF))


@query("retention_cleanup", f"with {q.PARENTS}, {_KEPT} select id, status, created_at from kept")
def _(spark, sf):
    return _kept(spark, sf).select("id", "status", "created_at")


@query(
    "cascade_delete",
    f"with {q.PARENTS}, {_KEPT} select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select id from kept)",
)
def _(spark, sf):
    left = upsert.cascade_delete(v.table(spark, sf, "lineitem"), _kept(spark, sf), "l_orderkey", "id")
    return left.select("l_orderkey", "l_linenumber", "l_partkey")


@query("touch_updated_at", q.current("select scale_name, transact_no, created_at, updated_at from current"))
def _(spark, sf):
    return v.transactions(spark, sf).select(*KEY_COLUMNS, "created_at", "updated_at")


@query(
    "first_n_rows",
    q.norm(
        f"select {q.KEYS}, scale_name, transact_no from (select *, row_number() over (partition by sk order by arrived, pk, ln, file_id) as place from valid) where place <= 10"
    ),
)
def _(spark, sf):
    return upsert.first_n_rows(v.valid_rows(spark, sf), "sk", ["arrived", "pk", "ln", "file_id"]).select(
        *KEYS, *KEY_COLUMNS
    )


# ---- O: file outcome -------------------------------------------------------------------------


def _outcome_inputs(spark, sf):
    """Orders as files; an order without lines is a file without data rows."""
    seen = v.normalized(spark, sf)
    counts = outcome.row_counts(seen.withColumnRenamed("file_id", "id"), ["id"])
    read = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit(True).alias("has_rows")).distinct()
    none = F.array().cast("array<string>")
    files = v.parent_files(spark, sf).select("id").join(read, "id", "left").select(
        "id",
        F.when(F.col("has_rows"), none).otherwise(F.array(F.lit("CSV has no data rows"))).alias("structure_errors"),
    )
    return files, counts


_OUTCOME = """counted as (select file_id as id, count(*) filter (where rule is null) as good,
  count(*) filter (where rule is not null) as wrong from judged group by 1),
  outcomes as (select o_orderkey as id, c.id is null as empty, cast(coalesce(good, 0) as bigint) as valid_count,
  cast(coalesce(wrong, 0) as bigint) as error_count from orders left join counted c on c.id = o_orderkey)"""


@query(
    "file_outcome_lenient",
    q.norm(
        """select id, valid_count, error_count, case when valid_count = 0 then 'FAILED' else 'COMPLETED' end as status,
        case when empty then 'File validation failed: CSV has no data rows'
        when valid_count = 0 then 'No valid transactions found in CSV' end as error from outcomes""",
        _OUTCOME,
    ),
)
def _(spark, sf):
    return outcome.file_outcome_lenient(*_outcome_inputs(spark, sf), ["id"]).drop("structure_errors")


@query(
    "file_outcome_strict",
    q.norm(
        "select id, valid_count, error_count, case when error_count > 0 then 'REJECTED' else 'COMPLETED' end as outcome from outcomes",
        _OUTCOME,
    ),
)
def _(spark, sf):
    return outcome.file_outcome_strict(*_outcome_inputs(spark, sf), ["id"]).drop("structure_errors")


@query(
    "file_outcome_sample",
    q.norm("select id, valid_count, error_count, 'COMPLETED' as outcome from outcomes", _OUTCOME),
)
def _(spark, sf):
    return outcome.file_outcome_sample(*_outcome_inputs(spark, sf), ["id"]).drop("structure_errors")


@query(
    "status_transitions",
    f"""with {q.PARENTS} select id, status, created_at as processing_started_at,
    case when status <> 'PROCESSING' then created_at + to_seconds(id % 90) end as processing_completed_at,
    case when status <> 'PROCESSING' then created_at + to_seconds(id % 90) else created_at end as updated_at from parents""",
)
def _(spark, sf):
    done = F.col("created_at") + F.make_dt_interval(secs=(F.col("id") % 90).cast("decimal(18,6)"))
    stamped = outcome.status_transitions(v.parent_files(spark, sf), F.col("created_at"), done)
    return stamped.select("id", "status", "processing_started_at", "processing_completed_at", "updated_at")


# ---- A: reports --------------------------------------------------------------------------------

_OK, _NOT = "success", "not success"
_STATUS = lambda s: q.count_if(f"status = '{s}'")


@query(
    "file_kpis",
    q.files(
        f"select cast(count(*) as bigint) as total_files, {_STATUS('COMPLETED')} as completed, {_STATUS('NEW')} as new_files, "
        f"{_STATUS('FAILED')} as failed, {_STATUS('DUPLICATE')} as duplicates, max(created_at) as last_processed from files"
    ),
)
def _(spark, sf):
    return reports.file_kpis(v.activity_files(spark, sf))


_ROWS_NOW = f"timestamp '{ROWS_AS_OF}'"
_SUCCESS_FILL = "(case when success then fill_kg end)"


@query(
    "transaction_kpis",
    q.current(
        f"""select cast(count(*) as bigint) as total_transactions, {q.count_if(_OK)} as successful,
        {q.count_if(_NOT)} as failed_transactions, cast(count(distinct scale_name) as bigint) as unique_scales,
        {q.mean_kg('fill_kg', 6)} as avg_fill_kg, {q.mean_kg(_SUCCESS_FILL, 6)} as avg_success_fill,
        min(started_at) as earliest, max(started_at) as latest,
        {q.count_if(f"started_at > {_ROWS_NOW} - interval 1 hour")} as last_hour from current"""
    ),
)
def _(spark, sf):
    return reports.transaction_kpis(v.transactions(spark, sf), ROWS_AS_OF)


_BOARD = f"""board as (select scale_name, cast(count(*) as bigint) as transaction_count, {q.count_if(_OK)} as success_count,
  {q.percent(q.count_if(_OK), 'count(*)', 1)} as success_rate, {q.mean_kg('fill_kg', 2)} as avg_fill,
  {q.mean_kg(_SUCCESS_FILL, 2)} as avg_success_fill, max(started_at) as last_activity from current group by 1)"""


@query("scale_leaderboard", q.current("select * from board", _BOARD))
def _(spark, sf):
    return reports.scale_leaderboard(v.transactions(spark, sf))


@query(
    "leaderboard_top10",
    q.current(
        f"select {_RANK} as rank, scale_name, success_rate, transaction_count, avg_fill from (select *, "
        "row_number() over (order by success_rate desc, transaction_count desc, scale_name) as place from board) where place <= 10",
        _BOARD,
    ),
)
def _(spark, sf):
    return reports.leaderboard_top10(v.transactions(spark, sf))


@query(
    "recent_files",
    q.files(
        f"""select id, filename, status, correlation_id, created_at, from_email,
        case when created_at > {q.NOW} - interval 5 minute then 'JUST NOW'
        when created_at > {q.NOW} - interval 1 hour then 'RECENT' else 'OLDER' end as time_status
        from files order by created_at desc, id limit 8"""
    ),
)
def _(spark, sf):
    return reports.recent_files(v.activity_files(spark, sf), v.AS_OF)


@query(
    "daily_performance",
    q.files(
        f"""select cast(created_at as date) as process_date, cast(count(*) as bigint) as files_processed,
        {_STATUS('COMPLETED')} as successful_files from files where created_at > {q.NOW} - interval 7 day group by 1"""
    ),
)
def _(spark, sf):
    return reports.daily_performance(v.activity_files(spark, sf), v.AS_OF)


@query(
    "file_rates",
    q.current(
        f"""select 'files' as subject, cast(count(*) as bigint) as total, {_STATUS('COMPLETED')} as succeeded,
        {q.percent(_STATUS('COMPLETED'), 'count(*)', 1)} as rate_percent from files union all
        select 'transactions', count(*), {q.count_if(_OK)}, {q.percent(q.count_if(_OK), 'count(*)', 1)} from current""",
        q.FILES,
    ),
)
def _(spark, sf):
    return reports.file_rates(v.activity_files(spark, sf), v.transactions(spark, sf))


_LAST_DAY = f"created_at >= {q.NOW} - interval 24 hour"
_TOOK = "(epoch_us(processing_completed_at) - epoch_us(processing_started_at)) / 1e6"


@query(
    "status_breakdown",
    q.files(
        f"select status, cast(count(*) as bigint) as count, avg({_TOOK}) as avg_processing_time_seconds "
        f"from files where {_LAST_DAY} group by 1"
    ),
)
def _(spark, sf):
    return reports.status_breakdown(v.activity_files(spark, sf), v.AS_OF)


_MEAN_SECONDS = q.decimal(q.ratio("sum(fill_time_seconds)", "count(fill_time_seconds)", 6), 6)


@query(
    "transaction_summary",
    q.current(
        f"""select cast(count(*) as bigint) as total_transactions, {q.count_if(_OK)} as successful_transactions,
        {q.count_if(_NOT)} as failed_transactions, {_MEAN_SECONDS} as avg_fill_time_seconds
        from current where created_at >= {_ROWS_NOW} - interval 24 hour"""
    ),
)
def _(spark, sf):
    return reports.transaction_summary(v.transactions(spark, sf), ROWS_AS_OF)


_HOURS = f"""select date_trunc('hour', created_at) as hour, cast(count(*) as bigint) as files_processed,
  {_STATUS('COMPLETED')} as successful_files, {_STATUS('FAILED')} as failed_files from files"""


@query("hourly_activity", q.files(f"{_HOURS} where {_LAST_DAY} group by 1 order by 1 desc limit 24"))
def _(spark, sf):
    return reports.hourly_activity(v.activity_files(spark, sf), v.AS_OF)


@query(
    "failure_rate",
    q.files(
        f"select cast(count(*) as bigint) as total_files, {_STATUS('FAILED')} as failed_files, "
        f"{q.percent(_STATUS('FAILED'), 'count(*)', 2)} as failure_rate_percent from files where {_LAST_DAY}"
    ),
)
def _(spark, sf):
    return reports.failure_rate(v.activity_files(spark, sf), v.AS_OF)


@query(
    "file_statistics",
    q.norm(
        f"""select p.id, p.filename, p.status, p.created_at, cast(count(x.file_id) as bigint) as transaction_count,
        {q.count_if('x.success')} as success_count, {q.count_if('not x.success')} as failure_count
        from parents p left join valid x on x.file_id = p.id group by 1, 2, 3, 4""",
        q.PARENTS,
    ),
)
def _(spark, sf):
    files = v.parent_files(spark, sf).select("id", "filename", "status", "created_at")
    return reports.file_statistics(files, v.file_rows(spark, sf))


@query(
    "store_totals",
    q.norm(
        f"""select (select cast(count(*) as bigint) from orders) as files, cast(count(*) as bigint) as transactions,
        {q.count_if(_OK)} as successful from valid"""
    ),
)
def _(spark, sf):
    return reports.store_totals(v.parent_files(spark, sf), v.file_rows(spark, sf))


@query(
    "batch_profile",
    q.norm(
        f"""select file_id, cast(count(*) as bigint) as transactions, {q.count_if(_OK)} as success_count,
        {q.percent(q.count_if(_OK), 'count(*)', 1)} as success_rate,
        array_to_string(list_sort(list(distinct scale_name)), ',') as scale_names,
        min(started_at) as first_start, max(started_at) as last_start from valid group by 1"""
    ),
)
def _(spark, sf):
    profile = reports.batch_profile(v.valid_rows(spark, sf), "file_id")
    return profile.withColumn("scale_names", F.array_join("scale_names", ","))


@query(
    "lineage",
    q.norm(
        f"""select file_id as ingestion_file_id, ln, pk, sk, scale_name, transact_no, filename, message_id,
        p.correlation_id as file_correlation_id, {_UUID} as row_correlation_id
        from valid join parents p on p.id = file_id""",
        q.PARENTS,
    ),
)
def _(spark, sf):
    stored = v.file_rows(spark, sf).withColumn(
        "correlation_id", values.correlation_id(*[F.col(k) for k in KEY_COLUMNS])
    )
    return reports.lineage(stored, v.parent_files(spark, sf)).select(
        "ingestion_file_id", "ln", "pk", "sk", *KEY_COLUMNS, "filename", "message_id",
        "file_correlation_id", "row_correlation_id",
    )


def _long(section: str, key: str, metrics: list[str], source: str) -> str:
    return " union all ".join(
        f"select '{section}' as section, {key} as key, '{m}' as metric, cast({m} as double) as value from {source}"
        for m in metrics
    )


@query(
    "health_report",
    q.current(
        " union all ".join(
            [
                _long("file_processing", "status", ["count", "avg_processing_time_seconds"], "by_status"),
                _long(
                    "transactions", "'all'",
                    ["total_transactions", "successful_transactions", "failed_transactions", "avg_fill_time_seconds"], "summed",
                ),
                _long("hourly_activity", "cast(hour as varchar)", ["files_processed", "successful_files", "failed_files"], "hours"),
                _long("error_rates", "'all'", ["total_files", "failed_files", "failure_rate_percent"], "rates"),
            ]
        ),
        q.FILES,
        f"""by_status as (select status, count(*) as count, avg({_TOOK}) as avg_processing_time_seconds
          from files where {_LAST_DAY} group by 1),
        summed as (select count(*) as total_transactions, {q.count_if(_OK)} as successful_transactions,
          {q.count_if(_NOT)} as failed_transactions, {_MEAN_SECONDS} as avg_fill_time_seconds from current where {_LAST_DAY}),
        hours as ({_HOURS} where {_LAST_DAY} group by 1 order by 1 desc limit 24),
        rates as (select count(*) as total_files, {_STATUS('FAILED')} as failed_files,
          {q.percent(_STATUS('FAILED'), 'count(*)', 2)} as failure_rate_percent from files where {_LAST_DAY})""",
    ),
)
def _(spark, sf):
    return reports.health_report(v.activity_files(spark, sf), v.transactions(spark, sf), v.AS_OF)
