"""What the operators share: staged tables, Arrow batches, ranks that no single task computes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# White space as the operators' contracts define it.
SPACE = r"[\x20\x09-\x0D]+"

# Bytes of one Arrow batch on its way to Python. Texts can be long; rows are no measure.
BATCH_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="weighbridge-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back.

    Cuts the lineage, so that a lost executor costs the tasks it ran and nothing before, and
    fixes rows that later steps read more than once. ``discard`` deletes the table; what is not
    discarded stays until the folder is cleared.
    """
    path = f"{shared_folder(df.sparkSession)}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._staged_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to so many rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ranked(df: DataFrame, key: str, order: list[Column], spread: Column, cells: int, out: str) -> DataFrame:
    """Adds ``out``: a gapless rank from 0 of each row among the rows with its key.

    Rows of a key are dealt to ``cells`` cells by ``spread``, a hash. The order is by cell,
    then by ``order``. A key that holds most of the rows is so ranked by many tasks.
    """
    celled = df.withColumn("_cell", F.pmod(spread, F.lit(cells)))
    counts = celled.groupBy(key, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, "_cell").orderBy(*order)
    return (
        celled.withColumn("_row", F.row_number().over(within))
        .join(starts, [key, "_cell"])
        .withColumn(out, F.col("_start") + F.col("_row") - 1)
        .drop("_cell", "_row", "_start")
    )


def one_row_each(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, ``key``) is in ``kept`` (doc_id, _key), one for each.

    Ids may be null. Of rows with the same pair the first by text stays.
    """
    keyed = docs.select(
        F.struct(*docs.columns).alias("whole"), F.col("doc_id").alias("id"), F.col("text").alias("by"), key.alias("key")
    )
    wanted = kept.distinct()
    same = keyed["id"].eqNullSafe(wanted["doc_id"]) & (keyed["key"] == wanted["_key"])
    first = Window.partitionBy("id", "key").orderBy("by")
    met = keyed.join(wanted, same, "left_semi").withColumn("n", F.row_number().over(first))
    return met.where("n = 1").select("whole.*")
