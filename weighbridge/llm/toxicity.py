"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one of toxic words, one of ordinary
words. Each window of a document, a word with a space on either side, is compressed with both;
how many bytes the toxic dictionary saves over the ordinary one is the window's distance, and a
document is judged by its largest distance and by how many of its words pass each of a few
distances. A logistic curve over these, fitted to labelled documents that the dictionaries have
not seen, calibrates the thresholds.

A label names a document, not the words that made it toxic. Words count as toxic if they hold a
letter sequence that stands in far more toxic than ordinary documents. Ordinary words that the
toxic dictionary would save bytes on are added to the ordinary one. Characters are widened to
three bytes before compression, so that a match of a few characters outweighs its own cost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import batch_of, bounded_batches, texts
from weighbridge.llm.quality import fold, labelled_sample

# Labelled documents of each label used, at most; the last third of them calibrates.
SAMPLE_DOCS = 1200
CALIBRATION_SHARE = 1 / 3

WIDTH = 3
LEVEL = 19
GRAMS = (5, 6)
MIN_DOCS = 4
CONTRAST = 15
ORDINARY_WORDS = 8000
ROUNDS = 2
NEGATIVES = 2000
# Bytes that an ordinary word may save on the toxic dictionary before it is added to the other.
NEGATIVE_BYTES = 4
# Distances whose passing is counted.
STEPS = (2, 3, 4, 5, 6, 8)
RIDGE = 0.02
THRESHOLD = 0.5

MEMO_WORDS = 250_000

_TABLES = [
    bytes(np.random.default_rng(k).permutation(256).astype(np.uint8).tolist()) if k else bytes(range(256))
    for k in range(WIDTH)
]


def window(word: str) -> bytes:
    """The bytes that are compressed for a word."""
    raw = f" {word} ".encode("utf-8", "replace")
    out = bytearray(WIDTH * len(raw))
    for k, table in enumerate(_TABLES):
        out[k::WIDTH] = raw.translate(table)
    return bytes(out)


def words_of(text: str) -> set[str]:
    return set(text.lower().split())


@dataclass
class Model:
    """Contents of the two dictionaries, the most telling words last, and the curve's parameters."""

    toxic: bytes
    ordinary: bytes
    curve: np.ndarray | None = None

    def distance(self):
        """A function from a word to the bytes that the toxic dictionary saves."""
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False,
            write_dict_id=False,
        )
        sizes = []
        for content in (self.ordinary, self.toxic):
            if len(content) < 8:
                sizes.append(lambda raw: len(raw))
                continue
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=settings)
            tool = zstandard.ZstdCompressor(dict_data=made, compression_params=settings)
            sizes.append(lambda raw, tool=tool: len(tool.compress(raw)))
        ordinary, toxic = sizes
        memo: dict[str, int] = {}

        def saved(word: str) -> int:
            known = memo.get(word)
            if known is None:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                raw = window(word)
                known = memo[word] = ordinary(raw) - toxic(raw)
            return known

        return saved

    def scorer(self):
        saved = self.distance()

        def score(text: str) -> float:
            words = words_of(text)
            if not words or self.curve is None:
                return 0.0
            odds = float(self.curve @ signs(map(saved, words), len(words)))
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))

        return score


def signs(distances: Iterable[int], words: int) -> np.ndarray:
    """What a document's distances say: the largest, how many pass each step, and which share."""
    found = np.fromiter(distances, np.int64, words)
    passed = [(found >= step).sum() for step in STEPS]
    return np.array([1.0, max(found.max(), 0), *np.log1p(passed), *(10 * np.sqrt(np.array(passed) / words))])


def fitted_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a ridge on all but the constant term."""
    centre, scale = x.mean(axis=0), x.std(axis=0)
    centre[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    z = (x - centre) / scale
    ridge = RIDGE * weight.sum() * np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ w
        w -= np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + ridge, slope)
    out = w / scale
    out[0] -= (w[1:] * centre[1:] / scale[1:]).sum()
    return out


def _grams(text: str) -> set[str]:
    found = set()
    for word in words_of(text):
        raw = f" {word} "
        found.update(raw[i : i + n] for n in GRAMS for i in range(len(raw) - n + 1))
    return found


def toxic_words(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Words of the toxic texts with a letter sequence that sets these apart, most frequent first."""
    here: Counter = Counter()
    for text in toxic:
        here.update(_grams(text))
    here = Counter({g: n for g, n in here.items() if n >= MIN_DOCS})
    there: Counter = Counter()
    for text in ordinary:
        there.update(g for g in _grams(text) if g in here)
    marks = {g for g, n in here.items() if n * len(ordinary) > CONTRAST * (there[g] + 1) * len(toxic)}
    counts: Counter = Counter()
    for text in toxic:
        counts.update(w for w in words_of(text) if not marks.isdisjoint(_grams(w)))
    return sorted(counts, key=lambda w: (-counts[w], w))


def train(rows: list[tuple[str, int]], prior: float) -> Model:
    """Dictionaries from the first part of each label's texts, the curve from the rest.

    ``prior`` is the share of toxic documents where the model is used.
    """
    parts = []
    for y in (1, 0):
        own = [t for t, label in rows if label == y]
        cut = len(own) - int(len(own) * CALIBRATION_SHARE)
        parts.append((own[:cut], own[cut:]))
    (toxic, toxic_rest), (ordinary, ordinary_rest) = parts
    marked = toxic_words(toxic, ordinary)
    common = Counter(w for t in ordinary for w in words_of(t))
    base = sorted(common, key=lambda w: (-common[w], w))
    content = b"".join(map(window, reversed(marked)))
    kept = base[:ORDINARY_WORDS]
    model = Model(content, b"".join(map(window, reversed(kept))))
    for _ in range(ROUNDS):
        saved = model.distance()
        known = set(kept[:-ORDINARY_WORDS] if len(kept) > ORDINARY_WORDS else [])
        close = sorted((w for w in base if w not in known and saved(w) >= NEGATIVE_BYTES), key=lambda w: (-saved(w), w))
        kept = close[:NEGATIVES] + kept
        model = Model(content, b"".join(map(window, reversed(kept))))
    saved = model.distance()
    rest = [(words_of(t), y) for y, own in ((1, toxic_rest or toxic), (0, ordinary_rest or ordinary)) for t in own]
    rest = [(words, y) for words, y in rest if words]
    y = np.array([y for _, y in rest], float)
    if not 0 < y.sum() < len(y):
        return model
    x = np.array([signs(map(saved, words), len(words)) for words, _ in rest])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    model.curve = fitted_curve(x, y, weight)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from the training fold. Without labelled toxic rows nothing is toxic."""
    rows, prior = labelled_sample(docs, labels, label, sample_docs)
    if not any(y for _, y in rows):
        return Model(b"", b"")
    return train(rows, min(max(prior, 1e-3), 1 - 1e-3))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is read. A null or empty text scores 0. A null id is not held out. Rows may
    repeat; other columns are ignored.
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
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
