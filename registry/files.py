"""Queries over files, messages and streams that Spark derives from the driver's tables."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry import sqltext as q
from registry import views as v
from registry.tables import ORACLES, QUERIES, query
from weighbridge.functions.values import sha256_hex
from weighbridge.operators import outcome, reports, structure, upsert
from weighbridge.operators.rows import normalize_rows, valid_part
from weighbridge.operators.skew import ensure_checkpoint_dir
from weighbridge.plans import ingest
from weighbridge.schemas import KEY_COLUMNS, MEASURE_COLUMNS, RAW_COLUMNS, REQUIRED_HEADERS
from weighbridge.sources import landing, mail
from weighbridge.sources.tables import Store
from weighbridge.streaming import ingest as streaming_ingest
from weighbridge.streaming import tables as streams

__all__ = ["ORACLES", "QUERIES"]

_made: dict = {}


def new_folder(spark, name: str) -> str:
    """A fresh folder next to the checkpoints, where every executor can write."""
    return f"{ensure_checkpoint_dir(spark)}/weighbridge/{name}-{uuid.uuid4().hex}"


def _once(spark, sf: str, name: str, make):
    """Result of ``make`` for this session and input, made on first use."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


# ---- folders of very many small files ----------------------------------------------------------


def is_local(spark, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def write_files(lines: DataFrame, folder: str, head: str = "") -> None:
    """A file of a local, shared folder per value of ``file``: ``head`` and its lines in the order given.

    Rows of a file lie together. Hadoop's local file system starts a process for each folder and
    each file that it makes, some 10 ms each; the tasks open the files themselves. A file gets its
    name when it is complete, so a task that is repeated replaces what it left.
    """
    root = lines.sparkSession._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath()

    def run(batches):
        now, out = None, None

        def close():
            if out is not None:
                out.close()
                os.replace(out.name, f"{root}/{now}")

        for batch in batches:
            text = batch.column("line")
            ends = np.frombuffer(text.buffers()[1], "int32")[text.offset : text.offset + len(text) + 1]
            data, runs = memoryview(text.buffers()[2] or b""), pc.run_end_encode(batch.column("file"))
            at = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if name != now:
                    close()
                    now, folder_of = name, os.path.dirname(f"{root}/{name}")
                    os.makedirs(folder_of, exist_ok=True)
                    out = open(f"{folder_of}/.{os.path.basename(name)}.{uuid.uuid4().hex}", "wb")  # noqa: SIM115
                    out.write(head.encode())
                out.write(data[ends[at] : ends[end]])
                at = end
        close()
        yield from ()

    ended = lines.select("file", F.concat(F.coalesce("line", F.lit("")), F.lit("\n")).alias("line"))
    ended.mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()


# ---- a landing folder of CSV files: one file per supplier and year of lineitem ----------------

_AS_WRITTEN = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# What Spark's writer puts in a folder's name for a missing value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def landing_folder(spark, sf: str) -> str:
    def make():
        folder = new_folder(spark, "landing")
        named = v.raw_rows(spark, sf).select(
            "sk", F.year("arrived").alias("yr"), *[F.col(c).alias(h) for h, c in REQUIRED_HEADERS.items()],
            "arrived", "pk", "ln", "file_id",
        )
        ordered = named.repartition("sk", "yr").sortWithinPartitions("sk", "yr", "arrived", "pk", "ln", "file_id").drop(
            "arrived", "pk", "ln", "file_id"
        )
        if is_local(spark, folder):
            part = lambda k: F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(_NO_VALUE)))
            file = F.concat(part("sk"), F.lit("/"), part("yr"), F.lit(".csv"))
            line = F.to_csv(F.struct(*REQUIRED_HEADERS), _AS_WRITTEN)
            write_files(ordered.select(file.alias("file"), line.alias("line")), folder, ",".join(REQUIRED_HEADERS) + "\n")
        else:
            ordered.write.partitionBy("sk", "yr").option("header", True).options(**_AS_WRITTEN).csv(folder)
        return folder

    return _once(spark, sf, "landing", make)


def _origin(path: str = "path"):
    part = lambda k: F.regexp_extract(path, rf"{k}=(\d+)", 1)
    return [part("sk").cast("bigint").alias("sk"), part("yr").cast("bigint").alias("yr")]


_LANDED = """landed as (select *, year(arrived) as yr, cast(row_number() over (partition by sk, year(arrived)
  order by arrived, pk, ln, file_id) as bigint) as row_number from {source})"""
_LANDED_RAW = f"{q.RAW}, {_LANDED.format(source='raw')}"
_CELLS = ", ".join(f"nullif({c}, '') as {c}" for c in RAW_COLUMNS)


@query("csv_landing_source", f"with {_LANDED_RAW} select sk, yr, row_number, {_CELLS} from landed")
def _(spark, sf):
    rows = landing.csv_landing_source(spark, landing_folder(spark, sf))
    return rows.select(*_origin(), F.col("row_number").cast("bigint").alias("row_number"), *RAW_COLUMNS)


_FILE_COUNT = "cast(count(distinct (sk, year(arrived))) as bigint)"


@query("landing_stream", f"with {_LANDED_RAW} select distinct sk, yr from landed")
def _(spark, sf):
    out = new_folder(spark, "landing-stream")
    seen = landing.landing_stream(spark, landing_folder(spark, sf)).select(
        "path", sha256_hex(F.col("content")).alias("file_sha256")
    )
    writer = seen.writeStream.format("parquet").option("path", f"{out}/seen")
    landing.run_once(writer, f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/seen").select(*_origin())


@query(
    "run_once",
    f"with {q.RAW} select 1 as pass, {_FILE_COUNT} as files from raw union all select 2, 0",
)
def _(spark, sf):
    out, folder = new_folder(spark, "run-once"), landing_folder(spark, sf)
    passes = []
    for number in (1, 2):
        seen = landing.landing_stream(spark, folder).select("path")
        writer = seen.writeStream.foreachBatch(streams.append_batches(f"{out}/pass-{number}"))
        landing.run_once(writer, f"{out}/checkpoint").awaitTermination()
        read = spark.read.schema("path string, batch_id bigint").option("pathGlobFilter", "*.parquet")
        found = read.parquet(f"{out}/pass-{number}") if number == 1 else _or_none(spark, f"{out}/pass-{number}")
        passes.append(found.agg(F.count("*").alias("files")).select(F.lit(number).alias("pass"), "files"))
    return passes[0].union(passes[1])


def _or_none(spark, folder: str):
    """Paths a pass wrote; a pass that found nothing wrote no folder."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema("path string, batch_id bigint").parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], "path string, batch_id bigint")


# ---- ingestion of that folder -------------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"


def _ordered_files(spark, folder: str):
    """The landing files, arriving by year and supplier; named after both."""
    files = landing.landing_files(spark, folder)
    sk, yr = _origin()
    at = F.make_timestamp_ntz(yr.cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("double"))
    return files.withColumn("filename", F.concat(F.lit("s"), sk.cast("string"), F.lit("_"), yr.cast("string"), F.lit(".csv"))).withColumn(
        "received_at", at + F.make_dt_interval(secs=sk.cast("decimal(18,6)"))
    )


def lenient_store(spark, sf: str) -> Store:
    def make():
        folder, store = landing_folder(spark, sf), Store(spark, new_folder(spark, "store"))
        ingest.ingest_files(
            store, 0, _ordered_files(spark, folder),
            lambda wanted: landing.rows_by_name(spark, folder, wanted), as_of=AS_OF,
        )
        return store

    return _once(spark, sf, "lenient", make)


_JUDGED = f"{q.NORM}, {_LANDED.format(source='judged')}"
_NAME = "'s' || sk || '_' || yr || '.csv'"


@query(
    "write_ingestion_files",
    f"""with {_JUDGED} select {_NAME} as filename, 'landing' as source,
    case when count(*) filter (where rule is null) > 0 then 'COMPLETED' else 'FAILED' end as status,
    case when count(*) filter (where rule is null) = 0 then 'No valid transactions found in CSV' end as error,
    timestamp '{AS_OF}' as processing_completed_at from landed group by sk, yr""",
)
def _(spark, sf):
    return lenient_store(spark, sf).read("ingestion_files").select(
        "filename", "source", "status", "error", "processing_completed_at"
    )


@query(
    "write_scale_transactions",
    f"""with {_JUDGED} select {', '.join([*KEY_COLUMNS, *MEASURE_COLUMNS])}, filename from (select *, {_NAME} as filename,
    row_number() over (partition by scale_name, transact_no order by yr desc, sk desc, row_number desc) as place
    from landed where rule is null) where place = 1""",
)
def _(spark, sf):
    store = lenient_store(spark, sf)
    return upsert_view(store).select(*KEY_COLUMNS, *MEASURE_COLUMNS, "filename")


def upsert_view(store: Store):
    files = store.read("ingestion_files").select("file_sha256", "filename", "message_id", "correlation_id")
    return reports.lineage(store.current_transactions(), files, "file_sha256", "file_sha256")


@query(
    "write_row_errors",
    f"""with {_LANDED_RAW}, numbered as (select file_id as of, ln as oln, pk as opk, sk as osk, arrived as oa, yr, row_number from landed),
    {', '.join([q.STRIPPED, q.VALUED, q.JUDGED, q.BAD])}
    select {_NAME} as filename, row_number, field, code, nullif(raw_value, '') as raw_value,
    'Row ' || row_number || ': ' || detail as message
    from bad join numbered on of = file_id and oln = ln and opk = pk and osk = sk and oa = arrived""",
)
def _(spark, sf):
    store = lenient_store(spark, sf)
    names = store.read("file_arrivals").select("path", "filename")
    return store.read("row_errors").join(names, "path").select(
        "filename", "row_number", "field", "code", "raw_value", "message"
    )


# ---- file contents of every shape, one per document -----------------------------------------------

_HEADER = ",".join([*REQUIRED_HEADERS, "Note"])
# Every file carries its document's whole text: as a quoted cell, or, where a file must have no
# rows, as the line ends of the text.
_NOTE = """',"' || replace(text, '"', '""') || '"'"""
_LINE_ENDS = r"regexp_replace(text, '[^\r\n]', '', 'g')"
_ROW = (
    "(n_chars % 97 + 1) || ',Scale-0' || (doc_id % 5) || ',50,11.2kg,' || (doc_id % 7) || "
    f"'.25kg,0.5kg,Y,2024-01-' || lpad(cast(doc_id % 28 + 1 as string), 2, '0') || ' 10:00:00,60' || {_NOTE} || chr(10)"
)
_BAD_ROW = "case when doc_id % 3 = 0 then '7,Scale-01,50,1kg,1kg,1kg,maybe,2024-01-01 10:00:00,60' || chr(10) else '' end"
_H = f"'{_HEADER}' || chr(10)"
_SWAPPED = "'Extra,Scale Name,TransactNo,CylSize,TareWeight,Fill kgs,Residual,Success,Date Time Start,Fill Time,Note' || chr(13) || chr(10)"
_SWAPPED_ROW = (
    "'x,Scale-0' || (doc_id % 5) || ',' || (n_chars % 97 + 1) || ',50,11.2kg,' || (doc_id % 7) || "
    f"'.25kg,0.5kg,\"Y\",2024-01-' || lpad(cast(doc_id % 28 + 1 as string), 2, '0') || ' 10:00:00,60' || {_NOTE} || chr(13) || chr(10)"
)
CONTENTS_SQL = f"""select doc_id, 'doc/' || lpad(cast(doc_id as string), 12, '0') as path, source, lang,
  case doc_id % 10 when 0 then {_H} || {_ROW} || {_BAD_ROW} when 1 then {_H} || {_LINE_ENDS} when 2 then {_LINE_ENDS}
    when 3 then chr(10) || {_H} || {_ROW} when 4 then replace({_H}, ',Residual', '') || {_ROW}
    when 5 then replace({_H}, ',Fill Time', '') || {_LINE_ENDS} when 6 then {_SWAPPED} || {_SWAPPED_ROW}
    when 7 then chr(65279) || {_H} || {_ROW} when 8 then {_H} || {_ROW} else text end as body from documents"""
_CONTENTS = f"contents as ({CONTENTS_SQL})"
_REQUIRED = "[" + ", ".join(f"'{h}'" for h in REQUIRED_HEADERS) + "]"
_CHECKED = f"""checked as (select *, doc_id % 10 <> 8 as valid_utf8, rtrim(split_part(body, chr(10), 1), chr(13)) as header,
  list_sort(list_filter({_REQUIRED}, lambda h: not list_contains(string_split(rtrim(split_part(body, chr(10), 1), chr(13)), ','), h))) as missing,
  regexp_matches(substr(body, length(split_part(body, chr(10), 1)) + 1), '[^\\r\\n]') as has_rows from contents)"""
_STRUCTURED = f"""structured as (select *, case when not valid_utf8 then 'CSV file is not valid UTF-8'
  when header = '' then 'CSV has no headers' else array_to_string(list_filter([
    case when len(missing) > 0 then 'Missing required columns: {{''' || array_to_string(missing, ''', ''') || '''}}' end,
    case when not has_rows then 'CSV has no data rows' end], lambda e: e is not null), '; ') end as structure_error from checked)"""
_STRUCTURE = f"with {_CONTENTS}, {_CHECKED}, {_STRUCTURED}"


def contents(spark, sf: str):
    """Arriving files of every shape, with one byte that is not UTF-8 where the shape asks."""
    made = v._select(
        v.table(spark, sf, "documents"), "documents",
        CONTENTS_SQL.replace("chr(65279)", "decode(unhex('EFBBBF'), 'utf-8')").replace(", '', 'g')", ", '')"),
    )
    spoiled = F.concat(F.col("body").cast("binary"), F.unhex(F.lit("FF")))
    return made.withColumn(
        "content", F.when(F.col("doc_id") % 10 == 8, spoiled).otherwise(F.col("body").cast("binary"))
    ).drop("body")


@query(
    "file_inventory",
    """select doc_id, cast(octet_length(encode(text)) as bigint) as length, sha256(text) as file_sha256,
    case when contains(split_part(text, chr(10), 1), '"') then '' else rtrim(split_part(text, chr(10), 1), chr(13)) end as first_line
    from documents""",
)
def _(spark, sf):
    files = v.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    line = F.when(F.contains("header", F.lit('"')), "").otherwise(F.col("header"))
    return structure.file_inventory(files).select("doc_id", "length", "file_sha256", line.alias("first_line"))


@query("required_columns", f"{_STRUCTURE} select doc_id, array_to_string(missing, ',') as missing from checked")
def _(spark, sf):
    return structure.file_inventory(contents(spark, sf)).select("doc_id", F.array_join("missing", ",").alias("missing"))


@query("has_header", f"{_STRUCTURE} select doc_id, header <> '' as has_header from checked")
def _(spark, sf):
    record = structure.header_record(structure.file_text(F.col("content")))
    return contents(spark, sf).select("doc_id", structure.has_header(record).alias("has_header"))


@query("has_rows", f"{_STRUCTURE} select doc_id, has_rows from checked")
def _(spark, sf):
    return structure.file_inventory(contents(spark, sf)).select("doc_id", "has_rows")


@query("valid_utf8", f"{_STRUCTURE} select doc_id, valid_utf8 from checked")
def _(spark, sf):
    return contents(spark, sf).select("doc_id", structure.valid_utf8(F.col("content")).alias("valid_utf8"))


@query(
    "file_structure",
    f"{_STRUCTURE} select path, structure_error = '' as structure_ok, structure_error from structured",
)
def _(spark, sf):
    return structure.file_structure(contents(spark, sf))


# ---- stored mail: one message per document --------------------------------------------------------

_B = "--sep"


def _attachment(name: str, body: str, kind: str = "attachment", mime: str = "text/csv") -> str:
    return (
        f"'{_B}\\r\\nContent-Type: {mime}\\r\\nContent-Transfer-Encoding: base64\\r\\n"
        f"Content-Disposition: {kind}; filename=\"' || {name} || '\"\\r\\n\\r\\n' || base64({body}) || '\\r\\n'"
    )


def messages(spark, sf: str):
    """Raw messages: one or two CSV files, a PDF, an inline CSV, encoded names, plain text."""
    head = (
        "'From: Sensor <' || source || '@example.org>\\r\\nTo: desk@example.org\\r\\nMessage-ID: <m' || doc_id || '@example.org>\\r\\n"
        "Date: Mon, 05 Feb 2024 10:00:00 +0200\\r\\nSubject: ' || case doc_id % 6 when 4 then '=?utf-8?B?R3LDtsOfZQ==?=' else 'batch ' || doc_id end || '\\r\\n'"
    )
    open_parts = "'MIME-Version: 1.0\\r\\nContent-Type: multipart/mixed; boundary=\"sep\"\\r\\n\\r\\n'"
    note = f"'{_B}\\r\\nContent-Type: text/plain\\r\\n\\r\\nsee attached\\r\\n'"
    close = f"'{_B}--\\r\\n'"
    csv_name, second = "'doc-' || doc_id || '.csv'", "'extra-' || doc_id || '.CSV'"
    parts = f"""case doc_id % 6 when 0 then {_attachment(csv_name, 'content')}
      when 1 then {_attachment(csv_name, 'content')} || {_attachment(second, "lang || ',' || source")}
      when 2 then {_attachment("'report.pdf'", 'content', mime='application/pdf')}
      when 3 then {_attachment(csv_name, 'content', kind='inline')}
      when 4 then {_attachment("'=?utf-8?B?Z3LDtsOfZQ==?=-' || doc_id || '.csv'", 'content')} else '' end"""
    sql = f"""select path, cast({head} || case when doc_id % 6 = 5 then 'Content-Type: text/plain\\r\\n\\r\\nno file\\r\\n'
      else {open_parts} || {note} || {parts} || {close} end as binary) as content from {{source}}"""
    return spark.sql(sql, source=contents(spark, sf))


_BYTES = r"case when doc_id % 10 = 8 then encode(body) || '\xFF'::blob else encode(body) end"
_PARTS = f"""parts as (
  select doc_id, path, 0 as part_index, case when doc_id % 6 = 4 then 'größe-' || doc_id || '.csv' else 'doc-' || doc_id || '.csv' end as filename,
    case when doc_id % 6 = 4 then 'Größe' else 'batch ' || doc_id end as subject,
    'Sensor <' || source || '@example.org>' as from_email, '<m' || doc_id || '@example.org>' as message_id,
    {_BYTES} as bytes, source from contents where doc_id % 6 in (0, 1, 4)
  union all select doc_id, path, 1, 'extra-' || doc_id || '.CSV', 'batch ' || doc_id, 'Sensor <' || source || '@example.org>',
    '<m' || doc_id || '@example.org>', encode(lang || ',' || source), source from contents where doc_id % 6 = 1)"""
_MAIL = f"with {_CONTENTS}, {_PARTS}"
_MAIL_AT = "timestamp '2024-02-05 08:00:00'"


@query(
    "eml_attachments",
    f"{_MAIL} select path, part_index, filename, subject, from_email, message_id, {_MAIL_AT} as received_at, sha256(bytes) as file_sha256 from parts",
)
def _(spark, sf):
    return mail.eml_attachments(messages(spark, sf)).select(
        "path", "part_index", "filename", "subject", "from_email", "message_id", "received_at",
        sha256_hex(F.col("content")).alias("file_sha256"),
    )


@query("messages_with_csv", f"{_MAIL} select path, message_id, subject from parts where part_index = 0")
def _(spark, sf):
    return mail.messages_with_csv(mail.message_parts(messages(spark, sf))).select("path", "message_id", "subject")


@query(
    "sender_filter",
    f"{_MAIL} select path, message_id from contents join (select doc_id, '<m' || doc_id || '@example.org>' as message_id from documents) using (doc_id) where contains(lower(source), 'src1')",
)
def _(spark, sf):
    parts = mail.messages_of(mail.message_parts(messages(spark, sf)))
    return mail.sender_filter(parts, "SRC1").select("path", "message_id")


@query("first_attachment", f"{_MAIL} select path, filename from parts where part_index = 0")
def _(spark, sf):
    return mail.first_attachment(mail.message_parts(messages(spark, sf))).select("path", "filename")


def mail_store(spark, sf: str, policy: ingest.Policy) -> Store:
    def make():
        store = Store(spark, new_folder(spark, f"mail-{policy.name}"))
        ingest.ingest_mail(store, messages(spark, sf), policy, as_of=AS_OF)
        return store

    return _once(spark, sf, f"mail-{policy.name}", make)


_EVERY = f"{_MAIL}, every as (select path, doc_id, '<m' || doc_id || '@example.org>' as message_id from contents)"
_LENIENT_FOLDER = """select message_id, path, case when doc_id % 6 in (0, 1, 4) then 'Processed' else 'Failed' end as folder,
  case when doc_id % 6 not in (0, 1, 4) then 'no CSV attachment' end as reason from every"""


@query("disposition_lenient", f"{_EVERY} {_LENIENT_FOLDER}")
def _(spark, sf):
    parts = mail.message_parts(messages(spark, sf))
    files = parts.filter(F.col("part_index").isNotNull())
    return outcome.disposition_lenient(mail.messages_of(parts), files)


@query("write_dispositions", f"{_EVERY} {_LENIENT_FOLDER}")
def _(spark, sf):
    store = mail_store(spark, sf, ingest.LENIENT)
    return store.read("dispositions").select("message_id", "path", "folder", "reason")


_STRICT = f"""{_EVERY}, firsts as (select p.*, row_number() over (partition by bytes order by path) as place,
  case when doc_id % 10 in (0, 1, 6) then case when doc_id % 10 = 0 and doc_id % 3 = 0 then 'REJECTED' else 'COMPLETED' end
  else 'UNREADABLE' end as outcome from parts p where part_index = 0),
  strict as (select e.message_id, e.path, case when outcome is null or outcome = 'UNREADABLE' then 'Inbox'
    when outcome = 'REJECTED' then 'Failed' when place > 1 then 'Duplicates' when e.doc_id % 10 = 1 then 'Inbox' else 'Processed' end as folder,
    case when outcome is null then 'no CSV attachment' when outcome = 'UNREADABLE' then 'structure error'
    when outcome = 'REJECTED' then 'row errors' when place > 1 then 'duplicate file' when e.doc_id % 10 = 1 then 'no rows' end as reason
  from every e left join firsts f on f.path = e.path)"""


@query("disposition_strict", f"{_STRICT} select * from strict")
def _(spark, sf):
    store = mail_store(spark, sf, ingest.STRICT)
    return store.read("dispositions").select("message_id", "path", "folder", "reason")


@query(
    "disposition_counts",
    f"{_STRICT} select folder, cast(count(*) as bigint) as messages from strict group by 1",
)
def _(spark, sf):
    return outcome.disposition_counts(mail_store(spark, sf, ingest.STRICT).read("dispositions"))


@query(
    "isolate_errors",
    f"""{_STRUCTURE}, {_PARTS}, taken as (select distinct bytes, first_value(p.doc_id) over (partition by bytes order by p.path, part_index) as doc_id,
      first_value(part_index) over (partition by bytes order by p.path, part_index) as part_index from parts p),
    judged as (select case when t.part_index = 1 then 'File validation failed: Missing required columns: {{''' || array_to_string(list_sort({_REQUIRED}), ''', ''') || '''}}; CSV has no data rows'
      when structure_error <> '' then 'File validation failed: ' || structure_error end as error
      from taken t join structured s on s.doc_id = t.doc_id)
    select case when error is null then 'COMPLETED' else 'FAILED' end as status, error, cast(count(*) as bigint) as files from judged group by 1, 2""",
)
def _(spark, sf):
    """Bad files and good files of one batch, each with its own outcome."""
    stored = mail_store(spark, sf, ingest.LENIENT).read("ingestion_files")
    return stored.groupBy("status", "error").agg(F.count("*").alias("files"))


# ---- streams ------------------------------------------------------------------------------------------


def _table_stream(spark, sf: str, name: str):
    """A table as a stream, whether it is one file or a folder of files."""
    schema = v.table(spark, sf, name).schema
    # A stream's path is a folder, unless it is a pattern: this one meets the table's own name only.
    return spark.readStream.schema(schema).parquet(f"{landing.literal_path(sf)}/{name}.parque[t]")


_INGESTED = f"""with {_JUDGED} select sk, yr, {', '.join([*KEY_COLUMNS, *MEASURE_COLUMNS])}, 'COMPLETED' as status
  from landed where rule is null union all select sk, yr, {', '.join(['null'] * len([*KEY_COLUMNS, *MEASURE_COLUMNS]))}, 'quarantine'
  from landed where rule is not null union all
  select sk, yr, {', '.join(['null'] * len([*KEY_COLUMNS, *MEASURE_COLUMNS]))}, case when count(*) filter (where rule is null) > 0
  then 'file COMPLETED' else 'file FAILED' end from landed group by sk, yr"""


def _stored(store: Store):
    """Every stored version, every refused row and every arrival, by origin."""
    versions, errors = store.read("scale_transactions"), store.read("row_errors")
    blank = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in (*KEY_COLUMNS, *MEASURE_COLUMNS)]
    return (
        versions.select(*_origin(), *KEY_COLUMNS, *MEASURE_COLUMNS, F.lit("COMPLETED").alias("status"))
        .unionByName(errors.select(*_origin(), *blank, F.lit("quarantine").alias("status")))
        .unionByName(
            store.read("file_arrivals").select(*_origin(), *blank, F.concat(F.lit("file "), "status").alias("status"))
        )
    )


@query("stream_ingest", _INGESTED)
def _(spark, sf):
    store, folder = Store(spark, new_folder(spark, "stream-store")), landing_folder(spark, sf)
    streaming_ingest.stream_ingest(store, folder, f"{store.root}/_checkpoint", as_of=AS_OF).awaitTermination()
    return _stored(store)


def mail_folder(spark, sf: str) -> str:
    """The messages as files, one each."""

    def make():
        folder = new_folder(spark, "mail")
        stored = messages(spark, sf).select(
            F.regexp_extract("path", r"(\d+)$", 1).alias("doc"), F.col("content").cast("string").alias("value")
        )
        ordered = stored.repartition("doc").sortWithinPartitions("doc")
        if is_local(spark, folder):
            doc = F.coalesce("doc", F.lit(_NO_VALUE))
            file = F.concat(F.lit("doc="), F.substring(doc, 1, 9), F.lit("/"), F.substring(doc, 10, 100), F.lit(".txt"))
            write_files(ordered.select(file.alias("file"), F.col("value").alias("line")), folder)
        else:
            ordered.write.partitionBy("doc").option("lineSep", "\n").text(folder)
        return folder

    return _once(spark, sf, "mail-folder", make)


def _streamed_dispositions(spark, sf: str, policy: ingest.Policy):
    store = Store(spark, new_folder(spark, f"mail-stream-{policy.name}"))
    streaming_ingest.stream_mail(
        store, mail_folder(spark, sf), f"{store.root}/_checkpoint", policy, as_of=AS_OF, names="*.txt"
    ).awaitTermination()
    return store.read("dispositions").select("message_id", "folder", "reason")


@query("mail_stream_lenient", f"select message_id, folder, reason from ({_EVERY} {_LENIENT_FOLDER})")
def _(spark, sf):
    return _streamed_dispositions(spark, sf, ingest.LENIENT)


@query("mail_stream_strict", f"select message_id, folder, reason from ({_STRICT} select * from strict)")
def _(spark, sf):
    return _streamed_dispositions(spark, sf, ingest.STRICT)


@query("replay_safe", _INGESTED)
def _(spark, sf):
    """A micro-batch of the stream a second time, as after a crash before its offset was stored."""
    folder, store = landing_folder(spark, sf), Store(spark, new_folder(spark, "replay-store"))
    checkpoint = f"{store.root}/_checkpoint"
    streaming_ingest.stream_ingest(store, folder, checkpoint, as_of=AS_OF).awaitTermination()
    again = streaming_ingest.ingest_micro_batch(store, checkpoint, streaming_ingest.landing_ingest(as_of=AS_OF))
    again(landing.landing_files(spark, folder).select("path"), 0)
    return _stored(store)


@query("stream_file_dedup", "select distinct sha256(text) as file_sha256 from documents")
def _(spark, sf):
    out = new_folder(spark, "dedup-stream")
    files = _table_stream(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    writer = streams.stream_file_dedup(files).writeStream.format("parquet").option("path", f"{out}/first")
    landing.run_once(writer, f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/first").select("file_sha256")


_HOURS = f"""select date_trunc('hour', created_at) as hour, cast(count(*) as bigint) as files_processed,
  {q.count_if("status = 'COMPLETED'")} as successful_files, {q.count_if("status = 'FAILED'")} as failed_files from files group by 1"""


def _activity_stream(spark, sf: str):
    sql = v.FILES_SQL.replace("make_interval_seconds(event_id % 300)", "make_dt_interval(0, 0, 0, event_id % 300)")
    return v._select(_table_stream(spark, sf, "events"), "events", sql)


@query("stream_hourly_activity", q.files(_HOURS))
def _(spark, sf):
    out = new_folder(spark, "hourly-stream")
    streams.stream_hourly_activity(_activity_stream(spark, sf), f"{out}/hours", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/hours")


@query("stream_kpis", ORACLES["file_kpis"])
def _(spark, sf):
    out = new_folder(spark, "kpi-stream")
    streams.stream_kpis(_activity_stream(spark, sf), None, out, f"{out}/_checkpoint", v.AS_OF).awaitTermination()
    return spark.read.parquet(f"{out}/file_kpis")


@query("stream_upsert", ORACLES["touch_updated_at"])
def _(spark, sf):
    """Raw rows in three slices; the view equals that of one batch."""
    out = new_folder(spark, "upsert-stream")
    v.raw_rows(spark, sf).repartitionByRange(3, "arrived").write.parquet(f"{out}/slices")
    schema = spark.read.parquet(f"{out}/slices").schema
    slices = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/slices")
    versions = valid_part(normalize_rows(slices)).withColumn(
        "committed_at", F.col("arrived").cast("timestamp_ntz")
    )
    streams.stream_upsert(versions, f"{out}/versions", f"{out}/checkpoint").awaitTermination()
    current = upsert.upsert_latest(
        spark.read.parquet(f"{out}/versions"), order=v.ROW_ORDER, measures=[*MEASURE_COLUMNS, "file_id"]
    )
    return current.select(*KEY_COLUMNS, "created_at", "updated_at")
