"""The driver's tables seen as the domain's tables.

``SQL`` texts run unchanged in Spark and in DuckDB, so that a query and its oracle start
from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weighbridge.operators.rows import normalize_rows, valid_part
from weighbridge.operators.upsert import upsert_latest
from weighbridge.schemas import MEASURE_COLUMNS

AS_OF = "2024-01-31 00:00:00"

# Total order of arrival of the derived raw rows.
ROW_ORDER = ["arrived", "pk", "sk", "ln", "file_id"]

RAW_SQL = """
select l_orderkey as file_id, l_linenumber as ln, l_partkey as pk, l_suppkey as sk,
  cast(l_shipdate as date) as arrived,
  case l_partkey % 50 when 7 then '' when 11 then '-' || cast(l_orderkey*10+l_linenumber as string)
    when 13 then cast(l_orderkey*10+l_linenumber as string) || 'd'
    else cast(l_orderkey*10+l_linenumber as string) end as transact_raw,
  case l_partkey % 50 when 17 then '   ' when 18 then ' Scale-0' || cast(l_suppkey % 10 as string) || ' '
    else 'Scale-0' || cast(l_suppkey % 10 as string) end as scale_raw,
  case when l_partkey % 50 = 19 then '50kg' when l_partkey % 50 = 20 then ''
    else case l_partkey % 6 when 0 then '6' when 1 then '9' when 2 then '15' when 3 then '19'
      when 4 then '48' else '50' end end as cyl_raw,
  case l_partkey % 50 when 23 then '12KG' when 29 then 'kg' when 31 then null when 32 then ' 7.5 kg '
    else cast(5 + l_partkey % 15 as string) || '.' || lpad(cast(l_suppkey % 100 as string),2,'0') || 'kg' end as tare_raw,
  cast(cast(l_quantity as int) as string) || '.' || lpad(cast(l_partkey % 100 as string),2,'0') || 'kg' as fill_raw,
  '0.' || lpad(cast(l_orderkey % 100 as string),2,'0') || 'kg' as residual_raw,
  case when l_partkey % 50 = 37 then 'maybe' when l_returnflag='A' then 'Y'
    when l_returnflag='N' then ' yes ' else 'n' end as success_raw,
  case l_partkey % 50 when 41 then '2026-02-30 00:00:00' when 43 then '2026-2-8   4:5:6'
    else cast(cast(l_shipdate as date) as string) || ' ' || lpad(cast(l_partkey % 24 as string),2,'0')
      || ':' || lpad(cast(l_suppkey % 60 as string),2,'0') || ':00' end as started_raw,
  case l_partkey % 50 when 47 then '-5' when 3 then '12.9'
    else cast(30 + l_partkey % 270 as string) end as fill_time_raw
from lineitem
"""

# Files by activity: one row per event.
FILES_SQL = """
select event_id as id, ts as created_at,
  case event_type when 'error' then 'FAILED' when 'purchase' then 'COMPLETED'
    when 'click' then 'COMPLETED' when 'view' then 'NEW' else 'PROCESSING' end as status,
  'measurements_batch_' || cast(event_id as string) || '_' || event_type || '.csv' as filename,
  'sender-' || cast(user_id as string) || '@example.org' as from_email,
  'c-' || cast(event_id as string) as correlation_id,
  case when event_type <> 'view' then ts end as processing_started_at,
  case when event_type in ('error', 'purchase', 'click')
    then ts + make_interval_seconds(event_id % 300) end as processing_completed_at
from events
"""

# Files as parents of rows: one row per order.
PARENTS_SQL = """
select o_orderkey as id, o_orderdate as created_at,
  case o_orderstatus when 'O' then 'COMPLETED' when 'F' then 'FAILED' else 'PROCESSING' end as status,
  'order_' || cast(o_orderkey as string) || '.csv' as filename,
  '<' || cast(o_custkey as string) || '@example.org>' as message_id,
  'c-' || cast(o_orderkey as string) as correlation_id
from orders
"""


_RAW_INPUT = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, name: str, sql: str) -> DataFrame:
    return df.sparkSession.sql(sql.replace(f"from {name}", "from {source}"), source=df)


def spread_few_splits(df: DataFrame, *keys: str) -> DataFrame:
    """Test tables of one row group are one split, whatever the split size; spread over the cores.

    Tables with as many splits as cores are left as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread_few_splits(table(spark, sf_dir, "lineitem").select(*_RAW_INPUT), "l_orderkey", "l_partkey", "l_suppkey")
    return _select(lines, "lineitem", RAW_SQL)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_rows(raw_rows(spark, sf_dir))


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_part(normalized(spark, sf_dir))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows: valid rows after the upsert, created when they first arrived."""
    versions = valid_rows(spark, sf_dir).withColumn("committed_at", F.col("arrived").cast("timestamp_ntz"))
    return upsert_latest(versions, order=ROW_ORDER, measures=[*MEASURE_COLUMNS, "file_id"]).withColumnRenamed(
        "file_id", "ingestion_file_id"
    )


def activity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = FILES_SQL.replace("make_interval_seconds(event_id % 300)", "make_dt_interval(0, 0, 0, event_id % 300)")
    return _select(table(spark, sf_dir, "events"), "events", sql)


def parent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "orders"), "orders", PARENTS_SQL)


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows with their file's id, not upserted: versions of every file."""
    return valid_rows(spark, sf_dir).withColumnRenamed("file_id", "ingestion_file_id")


def document_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as arriving files; the text is the content."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("path"),
        F.lit(0).alias("part_index"),
        F.col("source"),
        F.col("lang").alias("filename"),
        F.make_timestamp_ntz(
            F.lit(2024), F.lit(1), (F.col("doc_id") % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("double")
        ).alias("received_at"),
        F.col("text").cast("binary").alias("content"),
    )
