"""Secrets in texts and in what the texts encode.

Each text is the first layer of a worklist. A layer is scanned, then every decoder is tried on
it: percent escapes, character escapes, base64, and compressed data inside base64 or escaped bytes. What they
give are new layers, until none is new. A layer carries, for each of its characters, the span of
the original text it comes from, so a secret in any layer is a span of the original. A layer
that was seen with the same origin ends its branch, so decoding that runs in a circle ends.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weighbridge.llm.common import batch_of, bounded_batches, in_slices, texts

KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_MIN_VALUE = 6
# A run is matched whole, so a run of the least length or more is the only one that counts.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
)
# Escaped bytes among which those that need no escape stand as they are.
_PERCENT_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()/+-])++")
_X_BYTES = re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0\\'\"]|[\x20-\x5B\x5D-\x7E])++")
_ONE_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|\\x([0-9A-Fa-f]{2})|\\(.)|.", re.DOTALL)
_SHORT = dict(zip("abfnrtv0", b"\a\b\f\n\r\t\v\0"))
# Sixteen characters of base64 hold twelve bytes, less than which no secret fits.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# The same over several lines; the breaks may be escaped as in JSON.
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{16,}}+{_BREAK.pattern})+[A-Za-z0-9+/_-]++={{0,2}}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|\x28\xb5\x2f\xfd|BZh[1-9]|\xfd7zXZ\x00")
_URL_SAFE = str.maketrans("-_", "+/")
# ASCII text of at least that size in UTF-16, of either byte order.
_UTF16 = (re.compile(rb"(?:[\x09-\x0D\x20-\x7E]\x00){12,}"), re.compile(rb"(?:\x00[\x09-\x0D\x20-\x7E]){12,}"))

_BATCH_ROWS = 512
MASK = "[secret]"


@dataclass(frozen=True)
class Layer:
    """A text, and for each character the span of the original it comes from."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def origins(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            at = np.arange(start, end)
            return at, at + 1
        return self.starts[start:end], self.ends[start:end]


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the secrets that stand in a text as they are."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _MIN_VALUE]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    return found + [(2, *m.span()) for m in _HEX.finditer(text)]


def _rewritten(layer: Layer, pattern: re.Pattern, read) -> Iterator[Layer]:
    """The layer with all matches decoded; ``read`` gives (characters, offsets in the match)."""
    texts_, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        decoded = read(m[0])
        if decoded is None:
            continue
        s, e = layer.origins(at, m.start())
        texts_.append(layer.text[at : m.start()])
        starts.append(s)
        ends.append(e)
        chars, cuts = decoded
        s, e = layer.origins(*m.span())
        texts_.append(chars)
        starts.append(s[cuts[:-1]])
        ends.append(e[np.asarray(cuts[1:]) - 1])
        at = m.end()
    if texts_:
        s, e = layer.origins(at, len(layer.text))
        yield Layer("".join([*texts_, layer.text[at:]]), np.concatenate([*starts, s]), np.concatenate([*ends, e]))


def _percent(run: str):
    raw = binascii.unhexlify(run.replace("%", ""))
    text = raw.decode("utf-8", "replace")
    if "�" in text:
        text = raw.decode("latin-1")
        return text, [3 * i for i in range(len(raw) + 1)]
    return text, 3 * np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]).astype(np.int64)


def _escape(run: str):
    if run[1] == "u":
        units = [int(u, 16) for u in run.split("\\u")[1:]]
        chars, cuts, i = [], [0], 0
        while i < len(units):
            pair = 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000
            code = 0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00 if pair else units[i]
            chars.append(chr(code) if pair or not 0xD800 <= code < 0xE000 else "�")
            i += 2 if pair else 1
            cuts.append(6 * i)
        return "".join(chars), np.array(cuts)
    if run[1] == "x":
        text, cuts = _percent(run.replace("\\x", "%"))
        return text, np.asarray(cuts) // 3 * 4
    code = int(run[2:], 16) if run[1] == "U" else int(run[3:-1], 16) if run[2] == "x" else int(run[2:-1])
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), np.array([0, len(run)])


def _decompressor(raw: bytes):
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 1 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _unpacked(raw: bytes) -> tuple[bytes, int]:
    """The bytes inside compressed data, of all members in a row, and how many bytes these take."""
    out, size, used = [], len(raw), 0
    while (member := _decompressor(raw)) is not None:
        try:
            out.append(member.decompress(raw))
        except (zlib.error, zstandard.ZstdError, lzma.LZMAError, OSError, EOFError, ValueError):
            break
        used = size - len(member.unused_data)
        # Archives may be padded with zeros between their members.
        raw = member.unused_data.lstrip(b"\0") if member.eof else b""
    return b"".join(out), used


def _readings(raw: bytes) -> Iterator[tuple[str, np.ndarray]]:
    """(characters, offsets in the bytes) of each way to read bytes as text; none is dropped.

    What is not UTF-8 is read as Latin-1, which keeps every secret, as secrets are ASCII.
    """
    try:
        text = raw.decode()
        sizes = [1] * len(text) if text.isascii() else [len(c.encode()) for c in text]
        yield text, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    except UnicodeDecodeError:
        yield raw.decode("latin-1"), np.arange(len(raw) + 1)
    if b"\x00" in raw:
        for order, pattern in enumerate(_UTF16):
            for m in pattern.finditer(raw):
                yield m[0][order::2].decode(), m.start() + 2 * np.arange(len(m[0]) // 2 + 1)


def _contents(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, bytes inside) of compressed data, wherever in the bytes it starts."""
    for m in _MAGIC.finditer(raw):
        inner, used = _unpacked(raw[m.start() :])
        while inner and (deeper := _unpacked(inner)[0]) and deeper != inner:
            inner = deeper
        if inner:
            yield m.start(), m.start() + used, inner


def _runs(layer: Layer) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Runs of base64 characters with their origins, line by line and over line breaks."""
    for m in _BASE64.finditer(layer.text):
        yield m[0], *layer.origins(*m.span())
    for m in _WRAPPED.finditer(layer.text):
        s, e = layer.origins(*m.span())
        kept = np.ones(len(m[0]), bool)
        for gap in _BREAK.finditer(m[0]):
            kept[slice(*gap.span())] = False
        yield _BREAK.sub("", m[0]), s[kept], e[kept]


def _base64(layer: Layer) -> Iterator[Layer]:
    for run, starts, ends in _runs(layer):
        whole = run.rstrip("=").translate(_URL_SAFE)
        # What encodes a text may start anywhere in a run, as in a path; one of four offsets meets it.
        for at in range(min(4, len(whole) - 15)):
            body = whole[at : len(whole) - ((len(whole) - at) % 4 == 1)]
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
            s, e = starts[at:], ends[at:]
            for text, cuts in _readings(raw):
                # A byte lies in two of the four characters of its group.
                yield Layer(text, s[cuts[:-1] * 4 // 3], e[np.minimum((cuts[1:] * 4 + 2) // 3, len(e)) - 1])
            for first, last, inner in _contents(raw):
                start, end = int(s[first * 4 // 3]), int(e[min((last * 4 + 2) // 3, len(e)) - 1])
                for text, _ in _readings(inner):
                    yield Layer(text, np.full(len(text), start), np.full(len(text), end))


def _escaped_bytes(layer: Layer, pattern: re.Pattern) -> Iterator[Layer]:
    """What is inside compressed data that is written as percent or \\x escapes."""
    for m in pattern.finditer(layer.text):
        if ("%" if pattern is _PERCENT_BYTES else "\\x") not in m[0]:
            continue
        raw, at = bytearray(), []
        for c in _ONE_BYTE.finditer(m[0]):
            escaped = c[1] if pattern is _PERCENT_BYTES else c[2]
            short = c[3] if pattern is _X_BYTES else None
            if escaped:
                raw.append(int(escaped, 16))
            elif short:
                raw.append(_SHORT.get(short, ord(short)))
            else:
                raw += c[0].encode()
            at += [c.start()] * (len(raw) - len(at))
        at.append(len(m[0]))
        variants = [bytes(raw)]
        if pattern is _PERCENT_BYTES and "+" in m[0]:
            # In form encoding a plus is a space.
            variants.append(bytes(32 if m[0][i] == "+" else b for i, b in zip(at, raw)))
        for data in variants:
            for first, last, inner in _contents(data):
                start, end = layer.span(m.start() + at[first], m.start() + at[last])
                for text, _ in _readings(inner):
                    yield Layer(text, np.full(len(text), start), np.full(len(text), end))


def layers(text: str) -> Iterator[Layer]:
    """The text and all that can be decoded from it, each once."""
    work = [Layer(text)]
    seen = set()
    while work:
        layer = work.pop()
        if layer.starts is not None:
            digest = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass"))
            digest.update(layer.starts.astype(np.int64).tobytes())
            if digest.digest() in seen:
                continue
            seen.add(digest.digest())
        yield layer
        if "%" in layer.text:
            work.extend(_rewritten(layer, _PERCENT, _percent))
            work.extend(_escaped_bytes(layer, _PERCENT_BYTES))
        if "\\" in layer.text or "&#" in layer.text:
            work.extend(_rewritten(layer, _ESCAPE, _escape))
        if "\\x" in layer.text:
            work.extend(_escaped_bytes(layer, _X_BYTES))
        work.extend(_base64(layer))


def secrets_in(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, all) spans as (start, kind, end), sorted: in the text itself, and in any layer."""
    base: list[tuple[int, int, int]] = []
    found = set()
    for layer in layers(text):
        spans = []
        for kind, s, e in scan(layer.text):
            start, end = layer.span(s, e)
            spans.append((start, kind, end))
        if layer.starts is None:
            base = sorted(spans)
        found.update(spans)
    return base, sorted(found)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch that spans cover replaced by ``MASK``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_assign, n_access, n_hex, base_sha256, spans.

    The counts and the digest cover the text as it is, ``spans`` what decoding adds as well.
    Spans count characters, the end exclusive. A null text counts as empty. Ids may be null or
    repeat; other columns are ignored. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
              ("base_sha256", pa.string()), ("spans", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, _BATCH_ROWS):
            rows = []
            for text in texts(batch.column(1)):
                base, every = secrets_in(text)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*counts, hashlib.sha256(shown(base).encode()).hexdigest(), shown(every)))
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), *zip(*rows)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _SCANNED).withColumnRenamed("doc_id", id_col)


@F.pandas_udf(StringType())
def mask_secrets(text):
    """The text with all its secrets masked; null stays null."""
    return text.map(lambda t: t if t is None else masked(t, secrets_in(t)[1]))
