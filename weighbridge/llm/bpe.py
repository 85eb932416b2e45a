"""Byte-pair encoding of texts of any length, by tree concatenation, and decoding.

A long text is halved until the pieces are short. The pieces of a whole batch are encoded
together, and the halves are joined again, bottom up: a window around each join is encoded anew
and grows until it meets both sides at places where they must agree.

A window may end at two kinds of places. Before a single space between two characters that are
no white space a new pre-token always begins, whatever stands around it. Inside a run of
letters or of digits the window must repeat the side's own token there: a sequence of tokens is
the encoding of a run exactly if each two neighbours are the encoding of their bytes, so sharing
a token on both sides is agreement. A window without such places grows to the whole halves.

The vocabulary is that of a ``tokenizers`` file. Short strings are encoded by tiktoken from the
same vocabulary, several times as fast. That is the same function if merges are in the order of
their ids, which is checked when the file is read, and if each token encodes to itself, which a
test checks.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import batch_of, bounded_batches, in_slices, texts

# Characters of a piece that is encoded at once, and of a window's first size on each side.
LEAF_CHARS = 4096
WINDOW_CHARS = 48

# Threads that encode the leaves of a batch.
THREADS = 2

_BATCH_ROWS = 256
_EDGE = re.compile(r"(?<=\S) (?=\S)")

# Fixed value: the public pattern of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, Codec] = {}


def _byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabularies, and back."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """One byte-level tokenizer file."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, window_chars: int = WINDOW_CHARS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        symbols = _byte_symbols()
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        if spec["model"]["type"] != "BPE" or any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
            raise ValueError("a BPE model whose merges are in the order of their ids is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(symbols[c] for c in token) if token not in self.special else b""
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        ranks = {self.bytes[i]: i for token, i in vocab.items() if token not in self.special}
        self.engine = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.leaf_chars, self.window_chars = leaf_chars, window_chars

    # -- pieces ------------------------------------------------------------------------

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.engine.encode_ordinary(text), np.uint32)

    # -- joins -------------------------------------------------------------------------

    def _tokens_in(self, ids: np.ndarray, size: int) -> int | None:
        """How many of the first tokens make up exactly ``size`` bytes."""
        if not size:
            return 0
        sums = np.cumsum(self.lengths[ids[:size]])
        at = int(np.searchsorted(sums, size))
        return at + 1 if at < len(sums) and sums[at] == size else None

    @staticmethod
    def _in_run(text: str, at: int) -> bool:
        """Whether letters, or digits, stand on both sides, and no apostrophe just before."""
        kinds = unicodedata.category(text[at - 1])[0] + unicodedata.category(text[at])[0]
        return kinds in ("LL", "NN") and "'" not in text[max(0, at - 4) : at + 1]

    def _left_cut(self, text: str, ids: np.ndarray, start: int, middle: int, width: int):
        """(place, tokens from there to the middle, token to be met) in the left half."""
        low = max(start, middle - width)
        if low == start:
            return start, len(ids), None
        hard = _EDGE.search(text, low, middle)
        if hard and hard.start() > start:
            at = hard.start()
            return at, self._tokens_in(ids[::-1], len(text[at:middle].encode())), None
        raw = text[low:middle].encode()
        ends = np.cumsum(self.lengths[ids[::-1][: len(raw)]])
        for k in range(len(ends) - 1, -1, -1):
            offset = len(raw) - int(ends[k])
            if offset <= 0 or raw[offset] & 0xC0 == 0x80:
                continue
            at = low + len(raw[:offset].decode())
            if self._in_run(text, at):
                return at, k + 1, int(ids[len(ids) - k - 1])
        return None

    def _right_cut(self, text: str, ids: np.ndarray, middle: int, end: int, width: int):
        """(place, tokens from the middle to there, token to be met) in the right half."""
        high = min(end, middle + width)
        if high == end:
            return end, len(ids), None
        hard = _EDGE.search(text, middle, high)
        if hard and hard.start() > middle:
            at = hard.start()
            return at, self._tokens_in(ids, len(text[middle:at].encode())), None
        raw = text[middle:high].encode()
        ends = np.cumsum(self.lengths[ids[: len(raw)]])
        for k in range(int(np.searchsorted(ends, len(raw), side="right")) - 1, 0, -1):
            offset, before = int(ends[k]), int(ends[k - 1])
            if offset >= len(raw) or raw[offset] & 0xC0 == 0x80 or raw[before] & 0xC0 == 0x80:
                continue
            at, met = middle + len(raw[:offset].decode()), middle + len(raw[:before].decode())
            if self._in_run(text, at) and self._in_run(text, met):
                return at, k + 1, int(ids[k])
        return None

    def join(self, text: str, start: int, middle: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of text[start:end] from those of its halves."""
        width = self.window_chars
        while True:
            a = self._left_cut(text, left, start, middle, width)
            b = self._right_cut(text, right, middle, end, width)
            if a and b:
                window = self._whole(text[a[0] : b[0]])
                agreed = (a[2] is None or window[0] == a[2]) and (b[2] is None or window[-1] == b[2])
                if agreed and a[1] is not None and b[1] is not None:
                    return np.concatenate([left[: len(left) - a[1]], window, right[b[1] :]])
            width *= 4

    # -- texts -------------------------------------------------------------------------

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text as the library gives them, special strings included."""
        plain: list[tuple[str, list[tuple[int, int]]]] = []
        layout: list[list[int]] = []
        for text in batch:
            row = []
            for part in self.split.split(text) if self.split else [text]:
                if part in self.special:
                    row.append(-1 - self.special[part])
                elif part:
                    row.append(len(plain))
                    plain.append((part, self._leaves(len(part))))
            layout.append(row)
        leaves = [text[s:e] for text, spans in plain for s, e in spans]
        encoded = iter(self.engine.encode_ordinary_batch(leaves, num_threads=THREADS))
        done = []
        for text, spans in plain:
            level = [(s, e, np.array(next(encoded), np.uint32)) for s, e in spans]
            while len(level) > 1:
                pairs = zip(level[::2], level[1::2])
                level = [(x[0], y[1], self.join(text, x[0], x[1], y[1], x[2], y[2])) for x, y in pairs]
            done.append(level[0][2])
        special = {-1 - i: np.array([i], np.uint32) for i in self.special.values()}
        empty = np.zeros(0, np.uint32)
        return [
            np.concatenate([special[k] if k < 0 else done[k] for k in row]) if row else empty for row in layout
        ]

    def _leaves(self, n: int) -> list[tuple[int, int]]:
        """Ends of the leaves of a full binary tree of halves."""
        count = 1
        while count * self.leaf_chars < n:
            count *= 2
        ends = [n * i // count for i in range(count + 1)]
        return list(zip(ends, ends[1:]))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """The worker's codec for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ids (array of int), decoded (text).

    A null text counts as empty and has no ids. Ids may be null or repeat. Other columns are
    ignored. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in in_slices(batches, _BATCH_ROWS):
            ids = tool.encode(texts(batch.column(1)))
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), lists, [tool.decode(i) for i in ids]])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document, without shipping the ids."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in in_slices(batches, _BATCH_ROWS):
            ids = tool.encode(texts(batch.column(1)))
            yield batch_of(schema, [
                batch.column(0).cast(pa.int64()),
                [len(i) for i in ids],
                [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                [hashlib.sha256(tool.decode(i).encode()).hexdigest() for i in ids],
            ])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
