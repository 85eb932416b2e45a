"""Quality scores from supervised subword embeddings.

A document is the mean of learned vectors: one per word, one per character n-gram of each word,
all hashed, and one that marks a word which repeats the word before it. A softmax layer over
the two labels follows. Vectors and layer are trained together by stochastic gradient descent
in numpy, on a bounded sample of labelled documents. Documents are then scored in parallel;
since everything after the vectors is linear, a word adds one number, which a worker remembers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weighbridge.llm.common import batch_of, bounded_batches, texts

# Labelled documents of each label that the model is fitted to, at most.
SAMPLE_DOCS = 1000

BUCKETS = 1 << 18
DIMENSION = 8
NGRAMS = (3,)
EPOCHS = 5
RATE = 0.5
FOLDS = 5
THRESHOLD = 0.3
REPEAT = 0

# Words that a worker remembers.
MEMO_WORDS = 200_000


def features(word: str) -> list[int]:
    """Hashed slots of a word: itself and its n-grams, marked at both ends. Slot 0 marks repeats."""
    raw = f"<{word}>"
    grams = [raw[i : i + n] for n in NGRAMS for i in range(len(raw) - n + 1)]
    return [1 + xxhash.xxh32_intdigest(g) % (BUCKETS - 1) for g in (word + " ", *grams)]


def words_of(text: str) -> tuple[Counter, int]:
    """The words' counts, and how many words repeat the one before."""
    words = text.split()
    return Counter(words), sum(map(str.__eq__, words, words[1:]))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their shares of the document's mean."""
    counts, repeats = words_of(text)
    slots: Counter = Counter()
    for word, n in counts.items():
        for slot in features(word):
            slots[slot] += n
    if repeats:
        # A repeat weighs as much as a whole word.
        slots[REPEAT] += repeats * max(1, sum(slots.values()) // max(1, sum(counts.values())))
    total = sum(slots.values())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.fromiter(slots, np.int64, len(slots)), np.fromiter(slots.values(), float, len(slots)) / total


@dataclass
class Model:
    """What scoring needs: each slot's part in the log odds, and their constant term."""

    weights: np.ndarray
    bias: float

    def scorer(self):
        memo: dict[str, tuple[float, int]] = {}
        part, bias, repeat = self.weights.tolist().__getitem__, self.bias, float(self.weights[REPEAT])

        def score(text: str) -> float:
            if len(memo) > MEMO_WORDS:
                memo.clear()
            counts, repeats = words_of(text)
            value, size = 0.0, 0
            for word, n in counts.items():
                known = memo.get(word)
                if known is None:
                    slots = features(word)
                    known = memo[word] = (sum(map(part, slots)), len(slots))
                value += known[0] * n
                size += known[1] * n
            if repeats:
                more = repeats * max(1, size // max(1, sum(counts.values())))
                value += repeat * more
                size += more
            odds = bias + (value / size if size else 0.0)
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))

        return score


def train(rows: list[tuple[str, int]], prior: float, seed: int = 7) -> Model:
    """Fits vectors and softmax layer; ``prior`` is the share of label 1 where the model is used."""
    random = np.random.default_rng(seed)
    data = [(*document_features(t), int(y)) for t, y in rows]
    table = random.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    layer, bias = np.zeros((2, DIMENSION)), np.zeros(2)
    weight = {y: len(data) / (2 * max(1, sum(d[2] == y for d in data))) for y in (0, 1)}
    steps, at = EPOCHS * max(1, len(data)), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(data)):
            slots, shares, y = data[i]
            rate = RATE * (1 - at / steps) * weight[y]
            at += 1
            mean = shares @ table[slots] if len(slots) else np.zeros(DIMENSION)
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if len(slots):
                # Shares are small, so the vectors take a step for the whole document.
                table[slots] -= rate * len(slots) ** 0.5 * np.outer(shares, p @ layer)
            layer -= rate * np.outer(p, mean)
            bias -= rate * p
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    weights = (table @ (layer[1] - layer[0])).astype(np.float32)
    return Model(weights, float(bias[1] - bias[0]) + math.log(prior / (1 - prior)))


def fold(id_column: Column) -> Column:
    """The held-out rule: crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_column.cast("string").cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> tuple[list[tuple[str, int]], float]:
    """At most ``size`` training texts of each label, by hash order, and the share of label 1."""
    known = labels.where((fold(F.col("doc_id")) != 0) & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).cast("int").alias("y")
    )
    share = known.agg(F.avg("y")).first()[0]
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for y in (0, 1)]
    picked = chosen[0].unionAll(chosen[1])
    rows = (
        docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(picked), "doc_id")  # 2 x size rows
        .orderBy("doc_id", "text")
        .select("text", "y")
        .collect()
    )
    return [(r["text"], r["y"]) for r in rows], 0.5 if share is None else share


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from the training fold. Without any labelled row all texts score one half."""
    rows, prior = labelled_sample(docs, labels, label, sample_docs)
    return train(rows, prior) if rows else Model(np.zeros(BUCKETS, np.float32), 0.0)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is read. A null text counts as empty; an empty text gets the prior. A null id
    is in no fold, so it is not held out. Rows may repeat; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shipped.value.scorer()
        for batch in batches:
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), [score(t) for t in texts(batch.column(1))]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_rows(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shipped.value.scorer()
        for part in parts:
            yield part.map(lambda t: of(t or "")).astype(float)

    return docs.where(score("text") >= threshold)
