"""Resampling towards a target distribution by hashed word-run features.

Every run of words is a feature, hashed to a bucket. A bucket's gain is the log ratio of its
smoothed share in the target texts to that in the documents; the gains are one array, by which
each task scores whole texts. Gumbel noise from the document's id turns the highest scores into
a draw without replacement.

The cutoff is found by weighted median-of-medians selection: each partition tells the median of
the keys it has left and how many these are, the median of the medians weighted by those sizes is
the pivot, and the side that cannot hold the cutoff is discarded, at least a quarter of what was
left. One job per round; what is left is written anew when it has shrunk enough, so the rounds
read less and less. Only the rows before the cutoff are sorted, by ranges.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weighbridge.llm.common import batch_of, bounded_batches, discard, staged, texts

LONGEST_RUN = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# Gains and noise are whole numbers of this part of a natural logarithm's unit.
SCALE = 1000

# Keys are written anew when so small a part of those written before is left.
RESTAGE = 16

# ASCII letters in lower case, digits as they are, other ASCII characters as spaces.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, in UTF-8."""
    return text.encode().translate(_FOLDED).split()


def features(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of each run of 1 to ``longest`` consecutive words."""
    parts = []
    for n in range(1, longest + 1):
        runs = words if n == 1 else list(map(b" ".join, zip(*(words[i:] for i in range(n)))))
        parts.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
    return np.concatenate(parts) % buckets


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise of a document, from its id alone."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def bucket_counts(docs: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket; a null text has none. One array per task is summed."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts(batch.column(0)):
                here += np.bincount(features(words_of(text), longest, buckets), minlength=buckets)
        met = np.flatnonzero(here)
        yield batch_of(schema, [met, here[met]])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    told = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[told["bucket"].to_numpy()] = told["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in whole numbers."""
    S, T, n = float(source.sum()), float(target.sum()), len(source)
    shares = zip(source.tolist(), target.tolist())
    return np.array([math.floor(SCALE * math.log((t + 1) * (S + n) / ((s + 1) * (T + n)))) for s, t in shares], np.int64)


_SCORED = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "n_features", "weight", "score"))])
_SCORED_SQL = "doc_id long, n_words long, n_features long, weight long, score long"


def _scores(gain: np.ndarray, longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                words = words_of(text)
                found = features(words, longest, len(gain))
                weight = int(gain[found].sum())
                rows.append((doc_id, len(words), len(found), weight, weight + noise(seed, doc_id)))
            if rows:
                yield batch_of(_SCORED, list(zip(*rows)))

    return run


# -- selection ---------------------------------------------------------------------------

# A row's key: what comes first is drawn first. ``row`` makes all keys different.
KEY = ("drop", "unknown", "id", "row")


def _before(pivot: tuple, including: bool = False) -> Column:
    """Whether a row's key comes before the pivot."""
    met = F.lit(including)
    for name, value in reversed(list(zip(KEY, pivot))):
        met = (F.col(name) < value) | ((F.col(name) == value) & met)
    return met


_SIDE = pa.schema([("side", pa.int32()), ("n", pa.int64()), *((k, pa.int64()) for k in KEY)])
_SIDE_SQL = "side int, n long, drop long, unknown long, id long, row long"


def _sides(pivot: tuple | None):
    """For the keys before the pivot (0) and after it (1): how many a partition has, and their median."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.array([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
        if not parts:
            return
        keys = np.concatenate(parts, axis=1)
        keys = keys[:, np.lexsort(keys[::-1])]
        low = high = keys.shape[1]
        if pivot is not None:
            low, high = 0, keys.shape[1]
            for row, value in zip(keys, pivot):
                part = row[low:high]
                low, high = low + np.searchsorted(part, value), low + np.searchsorted(part, value, "right")
        out = []
        for side, (first, last) in enumerate([(0, low), (high, keys.shape[1])]):
            if last > first:
                out.append((side, last - first, *keys[:, (first + last - 1) // 2].tolist()))
        if out:
            yield batch_of(_SIDE, list(zip(*out)))

    return run


def _weighted_median(medians: list[tuple]) -> tuple:
    """The first key at which half of the weight is reached; ``medians`` holds (key, weight)."""
    ordered, half, met = sorted(medians), sum(n for _, n in medians) / 2, 0
    for key, n in ordered:
        met += n
        if met >= half:
            return key
    raise ValueError("nothing to choose from")


def cutoff(keys: DataFrame, place: int) -> tuple:
    """The key at ``place`` (from 0) in the order of ``keys``, whose rows have the columns ``KEY`` and all differ."""
    now, written, own, pivot = keys.select(*KEY), None, False, None
    low, high = None, None
    while True:
        left = now
        if low is not None:
            left = left.where(~_before(low, including=True))
        if high is not None:
            left = left.where(_before(high))
        told: list[list[tuple]] = [[], []]
        for r in left.mapInArrow(_sides(pivot), _SIDE_SQL).collect():
            told[r["side"]].append((tuple(r[k] for k in KEY), r["n"]))
        counts = [sum(n for _, n in side) for side in told]
        if pivot is None:
            written = counts[0]
            side = 0
        elif place == counts[0]:
            break
        elif place < counts[0]:
            side, high = 0, pivot
        else:
            side, low, place = 1, pivot, place - counts[0] - 1
        pivot = _weighted_median(told[side])
        if counts[side] * RESTAGE < written:
            left = left.where(_before(high)) if side == 0 else left.where(~_before(low, including=True))
            after = staged(left)
            if own:
                discard(now)
            now, written, own = after, counts[side], True
    if own:
        discard(now)
    return pivot


def _ranked(rows: DataFrame) -> DataFrame:
    """The rows with ``rank``, from 1 in the order of their keys: sorted by ranges, counted by range."""
    order = [F.col(k) for k in KEY]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The high bits of the id are the range, the rest counts its rows.
    placed = staged(ranges.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row per range
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + within + 1)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    ``docs`` has doc_id and text, ``target`` a column text. Of the N documents with at least
    ``min_words`` words the floor(percent * N / 100) highest scores are drawn, equal scores by
    the smaller doc_id, null ids last; rank counts them from 1 and is null for all others. A
    null or empty text has no features and weight 0. Null ids share one noise; ids may repeat,
    each row is a document of its own. Other columns are ignored. No rows give no rows; without
    target texts the rare buckets of the documents have the highest gains.
    """
    bounded_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = staged(
        rows.mapInArrow(_scores(gain, longest, seed), _SCORED_SQL).select(
            "*",
            (-F.col("score")).alias("drop"),
            F.col("doc_id").isNull().cast("long").alias("unknown"),
            F.coalesce("doc_id", F.lit(0)).alias("id"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    able = F.col("n_words") >= min_words
    wanted = percent * scored.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*columns, unranked)
    drawn = able & _before(cutoff(scored.where(able), wanted - 1), including=True)
    return _ranked(scored.where(drawn)).select(*columns, "rank").unionAll(scored.where(~drawn).select(*columns, unranked))


def drawn_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn documents with their texts: doc_id, text, rank. Ids must be unique and not null."""
    ranks = resampled(docs, target, **settings).where(F.col("rank").isNotNull()).select("doc_id", "rank")
    return docs.select("doc_id", "text").join(ranks, "doc_id")
