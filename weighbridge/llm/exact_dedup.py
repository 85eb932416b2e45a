"""Exact de-duplication by sorting contents.

Sampled splitters deal the normalised texts to ranges, each range is sorted externally, and
each row is compared in full with its neighbour. The splitters are bounded in size: texts are
ordered by their first bytes, then by digest, then by all bytes, so a splitter never carries a
long text. The identifier ends the sort key, so copies of one text spread over as many ranges
as they need.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from weighbridge.llm.common import SPACE, batch_of, bounded_batches, one_row_each, staged, text_of

# Bytes of a text that a splitter carries.
HEAD_BYTES = 64

_EMIT_ROWS = 8192


def _neighbours(id_type: pa.DataType):
    """Runs of equal neighbours in one sorted range.

    A run is known to be whole when another run stands on both sides. The first and the last
    run of a range may go on in the next one; the first row of such a run carries the text.
    """
    schema = pa.schema(
        [
            ("id", id_type), ("run_id", id_type), ("size", pa.int64()), ("first", pa.bool_()),
            ("sha", pa.string()), ("range", pa.int32()), ("run", pa.int64()), ("edge_text", pa.binary()),
        ]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        out: list[tuple] = []
        ids: list = []
        text, sha, run = None, None, 0

        def close(edge: bool) -> None:
            n = len(ids)
            out.append((ids[0], ids[0], n, True, sha, here, run, text if edge else None))
            out.extend((i, ids[0], n, False, sha, here, run, None) for i in ids[1:])

        def drain() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(out), _EMIT_ROWS):
                yield batch_of(schema, list(zip(*out[at : at + _EMIT_ROWS])))
            out.clear()

        for batch in batches:
            for row_id, row_text, row_sha in zip(*(c.to_pylist() for c in batch.columns)):
                if row_text == text:
                    ids.append(row_id)
                    continue
                if ids:
                    close(edge=run == 0)
                    run += 1
                ids, text, sha = [row_id], row_text, row_sha
            if len(out) >= _EMIT_ROWS:
                yield from drain()
        if ids:
            close(edge=True)
        yield from drain()

    return compare


def normalised(text_col: str) -> Column:
    """The bytes by which texts are compared."""
    return F.regexp_replace(text_of(text_col), SPACE, " ").cast("binary")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space became one space.
    The row with the smallest id of a group is kept. A null text counts as empty; a null id
    comes after all others; of rows with the same id and text one is kept. Other columns of
    ``docs`` are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"))
    rows = rows.withColumn("sha", F.sha2("text", 256))
    head = F.substring("text", 1, HEAD_BYTES)
    last = F.col("id").asc_nulls_last()
    ranges = rows.repartitionByRange(head, "sha", last).sortWithinPartitions(head, "sha", "text", last)
    kind = docs.schema[id_col].dataType
    schema = (
        f"id {kind.simpleString()}, run_id {kind.simpleString()}, size long, first boolean, sha string, "
        "range int, run long, edge_text binary"
    )
    runs = staged(ranges.select("id", "text", "sha").mapInArrow(_neighbours(to_arrow_type(kind)), schema))

    # Two runs per range at most, so their table is small whatever the number of rows.
    same = Window.partitionBy("edge_text")
    first = F.min(F.struct("range", "run", "run_id")).over(same)
    edges = runs.where(F.col("edge_text").isNotNull()).select(
        "range", "run", first.alias("head"), F.sum("size").over(same).alias("whole")
    )
    leads = (F.col("head.range") == F.col("range")) & (F.col("head.run") == F.col("run"))
    joined = edges.select("range", "run", F.col("head.run_id").alias("whole_id"), "whole", leads.alias("leads"))
    found = F.col("whole").isNotNull()
    return runs.join(F.broadcast(joined), ["range", "run"], "left").select(
        F.col("id").alias(id_col),
        F.when(found, F.col("whole_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.coalesce("whole", "size").alias("group_size"),
        (F.col("first") & F.coalesce("leads", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) that ``exact_groups`` keeps."""
    keys = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias("_key"))
    return one_row_each(docs, F.sha2(normalised("text"), 256), keys)
