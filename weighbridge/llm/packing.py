"""Packing of token sequences by shortest-pack-first over the histogram of lengths.

Documents are cut at the sequence length, so only lengths up to it remain. Their histogram has
a row per length, whatever the corpus, and is packed on the driver: lengths longest first, each
onto the packs with the most room. Packs with the same pattern are one count. The patterns go
back to the pieces by rank: the r-th piece of a length takes the r-th place for that length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.bpe import codec
from weighbridge.llm.common import batch_of, bounded_batches, in_slices, ranked, staged, texts

SEQUENCE_TOKENS = 1024
END_ID = 0

# Pieces of a length that one task numbers, about.
CELL_ROWS = 50_000

_BATCH_ROWS = 256

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
)


@dataclass(frozen=True)
class Place:
    """``count`` x ``copies`` pieces of a length: ``copies`` in each of ``count`` packs."""

    length: int
    rank: int
    count: int
    copies: int
    first_pack: int
    offset: int


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Packs as (count, pattern); a pattern lists (length, copies), longest first."""
    open_: dict[int, dict[tuple, int]] = defaultdict(dict)

    def put(room: int, pattern: tuple, count: int) -> None:
        if count:
            open_[room][pattern] = open_[room].get(pattern, 0) + count

    def grown(pattern: tuple, length: int, copies: int) -> tuple:
        if pattern and pattern[-1][0] == length:
            return (*pattern[:-1], (length, pattern[-1][1] + copies))
        return (*pattern, (length, copies))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_ if r >= length), default=None)
            if room is None:
                each = size // length
                put(size - each * length, ((length, each),), left // each)
                if left % each:
                    put(size - left % each * length, ((length, left % each),), 1)
                break
            group = open_.pop(room)
            for pattern, count in group.items():
                used = min(count, left)
                left -= used
                put(room - length, grown(pattern, length, 1), used)
                put(room, pattern, count - used)
    return [(n, pattern) for room in sorted(open_) for pattern, n in open_[room].items()]


def places(packs: list[tuple[int, tuple[tuple[int, int], ...]]]) -> list[Place]:
    """Where the pieces of each length go, by rank among the pieces of that length."""
    ranks: dict[int, int] = defaultdict(int)
    first, out = 0, []
    for count, pattern in packs:
        offset = 0
        for length, copies in pattern:
            out.append(Place(length, ranks[length], count, copies, first, offset))
            ranks[length] += count * copies
            offset += length * copies
        first += count
    return out


def _cutter(path: str, size: int):
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in in_slices(batches, _BATCH_ROWS):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tool.encode(texts(batch.column(1)))):
                raw = ids.astype("<u4").tobytes() + end
                n = len(raw) // 4
                for s in range(0, n, size):
                    part = raw[4 * s : 4 * (s + size)]
                    rows.append((doc_id, s, len(part) // 4, zlib.crc32(part), n))
            if rows:
                yield batch_of(schema, list(zip(*rows)))

    return run


def pieces_of(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens.

    A document's ids are followed by id 0. A null text counts as empty: one piece of one id.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_cutter(path, size), PIECES)


def packed(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` with sequence_id and offset (long); sequences are numbered from 0 without gaps.

    Each row is one piece of ``length`` tokens, 1 to ``size``; doc_id and start order the pieces
    of a length. Ids may be null or repeat: every row is packed. No rows give no rows.
    """
    spark = pieces.sparkSession
    rows = staged(pieces)
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(pack_histogram(histogram, size))
    # Patterns are bounded by the sequence length, not by the corpus, and so is their table.
    steps = spark.createDataFrame(
        [(p.length, p.rank, p.rank + p.count * p.copies, p.count, p.first_pack, p.offset) for p in table],
        "length long, low long, high long, count long, first_pack long, at long",
    )
    cells = max(1, -(-max(histogram.values(), default=0) // CELL_ROWS))
    spread = F.xxhash64("doc_id", "start")
    numbered = ranked(rows, "length", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], spread, cells, "rank")
    lists = steps.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("low", "high", "count", "first_pack", "at"))).alias("steps")
    )
    step = F.expr("filter(steps, s -> s.low <= rank and rank < s.high)[0]")
    found = numbered.join(F.broadcast(lists), "length").withColumn("step", step)
    within = F.col("rank") - F.col("step.low")
    return found.select(
        *pieces.columns,
        (F.col("step.first_pack") + within % F.col("step.count")).alias("sequence_id"),
        (F.col("step.at") + F.floor(within / F.col("step.count")) * F.col("length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    return packed(pieces_of(docs, path, size), size)
