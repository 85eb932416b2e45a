"""Removal of long byte strings that repeat anywhere, by blockwise suffix sorting.

Whether a byte goes depends on the suffixes that begin up to 400 bytes before it: those whose
first 400 bytes occur twice. Sorting all suffixes of a corpus at once is what this avoids.

1. Suffixes are dealt to buckets by content. The bucket of a suffix is the least hash among the
   grams of its first 400 bytes, so equal strings meet, and neighbouring suffixes of a text share
   buckets: a text falls into short runs of them.
2. Runs with the same bytes are one class. A class that occurs twice repeats as a whole, so
   copies of documents and passages need no sorting. A bucket with one class needs none either.
3. Of the other buckets, each run is cut into blocks of suffixes that share most of their bytes.
   Blocks with equal shared bytes form one suffix bucket, and one bucket after another is
   sorted: by the first bytes, and ties by the ranks of a sample at a difference cover. For any
   two suffixes the cover has a shift of less than its period at which both meet the sample, so
   the sample's ranks decide ties of any length without comparing them byte by byte.
4. A bucket with very many different blocks is cut into smaller blocks, down to single suffixes,
   whose classes are the answer themselves. So no task holds a bucket without bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import BATCH_BYTES, batch_of, bounded_batches, discard, staged, text_of, texts

REPEAT_BYTES = 400
GRAM_BYTES = 128
GRAMS = REPEAT_BYTES - GRAM_BYTES + 1

# Bytes of a text that are hashed at once.
SPAN_BYTES = 4 << 20

# Suffixes per block, by round, and different blocks of a bucket that one task sorts.
BLOCKS = (64, 8, 1)
BUCKET_BLOCKS = 4096
# Bytes of blocks that are sorted at once.
SORT_BYTES = 4 << 20

# Fixed value: a difference cover modulo 16. Each residue is a difference of two of its members.
COVER = (0, 1, 2, 5, 8)
PERIOD = 16
# Bytes that a sample's rank covers; the period more is the string's length.
RANK_BYTES = REPEAT_BYTES - PERIOD

_POSITION = np.uint64((1 << 24) - 1)
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, 300, dtype=np.uint64) | np.uint64(1)


def _join(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    mixed = left * _SEEDS[256 + step] + right
    return mixed ^ (mixed >> np.uint64(29))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the gram at each position; grams are built from halves."""
    level, size, step, kept = _SEEDS[raw.astype(np.int64)], 1, 0, {}
    while size * 2 <= GRAM_BYTES:
        level = _join(level[:-size], level[size:], step)
        size, step = size * 2, step + 1
        if size & GRAM_BYTES:
            kept[size] = level
    hashes, done = level, size
    for size in sorted(kept, reverse=True)[1:]:
        n = len(raw) - done - size + 1
        hashes, done, step = _join(hashes[:n], kept[size][done : done + n], step), done + size, step + 1
    return hashes


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    more = width - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def runs_of(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first suffix, suffixes, anchor, gram hash) of each run of a text's suffixes."""
    out = []
    for at in range(0, max(0, len(raw) - REPEAT_BYTES + 1), SPAN_BYTES):
        part = np.frombuffer(raw, np.uint8, min(SPAN_BYTES + REPEAT_BYTES - 1, len(raw) - at), at)
        grams = gram_hashes(part)
        # The least hash, the leftmost of equal ones: places are counted inside the span.
        least = _sliding_least((grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64), GRAMS)
        anchor = (least & _POSITION).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        sizes = np.diff(np.append(first, len(anchor)))
        out.append((at + first, sizes, at + anchor[first], grams[anchor[first]].view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


# A run's place in one number: first suffix, number of suffixes, distance to the anchor.
_SIZE_BITS = 10


def _hash(raw: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(raw), "little", signed=True)


_RUN = pa.schema([("doc_id", pa.int64()), ("mark", pa.int32()), *((n, pa.int64()) for n in ("gram", "same", "at"))])
_RUN_SQL = "doc_id long, mark int, gram long, same long, at long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text: bucket, digest of all bytes, and place."""
    for batch in batches:
        counts, grams, same, at = [], [], [], []
        for text in texts(batch.column(2)):
            raw = text.encode()
            first, sizes, anchor, gram = runs_of(raw)
            counts.append(len(first))
            grams.append(gram)
            ends = first + sizes + REPEAT_BYTES - 1
            same += [_hash(raw[s:e]) for s, e in zip(first.tolist(), ends.tolist())]
            at.append((((first << _SIZE_BITS) | sizes) << _SIZE_BITS) | (anchor - first))
        rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
        if len(rows):
            keys = [batch.column(0).take(rows), batch.column(1).take(rows)]
            yield batch_of(_RUN, [*keys, np.concatenate(grams), same, np.concatenate(at)])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they travel to the rows that are joined with them."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int32()), ("packed", pa.binary())])
    tool = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield batch_of(schema, [batch.column(0), batch.column(1), [tool.compress(t.encode()) for t in texts(batch.column(2))]])


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def cut_blocks(size: int, content: bytes, start: int, lead: int) -> Iterator[tuple[int, bytes, int, int]]:
    """(bucket, content, first suffix, lead) of the blocks of ``size`` suffixes of a run.

    Blocks are laid out from the anchor, ``lead`` bytes after the run's first suffix, so that
    runs with the same anchor are cut alike. The bucket is the digest of the bytes that all
    suffixes of a block share, whether or not the run has all of them.
    """
    suffixes = len(content) - REPEAT_BYTES + 1
    low, high = lead - suffixes + 1, lead
    for block in range(low // size, high // size + 1):
        first = lead - min(high, block * size + size - 1)
        last = lead - max(low, block * size)
        shared = lead - block * size
        core = content[shared : shared + REPEAT_BYTES - size + 1]
        yield _hash(core), content[first : last + REPEAT_BYTES], start + first, lead - first


_BLOCK = pa.schema(
    [("doc_id", pa.int64()), ("mark", pa.int32()), ("known", pa.bool_()), ("core", pa.int64()), ("content", pa.binary()),
     ("start", pa.int64()), ("lead", pa.int32())]
)
_BLOCK_SQL = "doc_id long, mark int, known boolean, core long, content binary, start long, lead int"


def _first_blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << _SIZE_BITS) - 1
        for batch in batches:
            rows = []
            for doc_id, mark, packed, runs in zip(*(c.to_pylist() for c in batch.columns)):
                raw = _unpacked(packed)
                for one in runs:
                    at = one["at"]
                    start, suffixes, lead = at >> (2 * _SIZE_BITS), (at >> _SIZE_BITS) & mask, at & mask
                    content = raw[start : start + suffixes + REPEAT_BYTES - 1]
                    rows += [(doc_id, mark, one["known"], *b) for b in cut_blocks(size, content, start, lead)]
            if rows:
                yield batch_of(_BLOCK, list(zip(*rows)))

    return run


def _smaller_blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, mark, known, _, content, start, lead in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(doc_id, mark, known, *b) for b in cut_blocks(size, content, start, lead)]
            if rows:
                yield batch_of(_BLOCK, list(zip(*rows)))

    return run


# -- one suffix bucket at a time ---------------------------------------------------------

_SHIFT = np.array(
    [[min(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)]
     for a in range(PERIOD)]
)


def _pair_ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]) if len(order) else []
    return ranks


def cover_ranks(words: np.ndarray, size: int) -> np.ndarray:
    """Rank of the ``RANK_BYTES`` bytes from each cover position; place q * |cover| + k is 16 q + cover[k].

    ``words`` has the eight bytes from each position as a number. Ranks of twice the length
    come from pairs of ranks: a multiple of the period after a cover position is one too.
    """
    whole = size // PERIOD
    at = (np.arange(whole)[:, None] * PERIOD + np.array(COVER)).ravel()
    level, length, levels = _pair_ranks(words[at], words[at + 8]), PERIOD, {}
    levels[length] = level
    step = len(COVER)

    def later(ranks: np.ndarray, by: int) -> np.ndarray:
        moved = np.full(len(ranks), -1, np.int64)
        skip = by // PERIOD * step
        if skip < len(ranks):
            moved[: len(ranks) - skip] = ranks[skip:]
        return moved

    while length * 2 <= RANK_BYTES:
        level = _pair_ranks(level, later(level, length))
        length *= 2
        levels[length] = level
    for part in sorted(levels, reverse=True):
        while length + part <= RANK_BYTES:
            level, length = _pair_ranks(level, later(levels[part], length)), length + part
    return level


def repeated_suffixes(contents: list[bytes]) -> list[np.ndarray]:
    """For each block, which of its suffixes' first 400 bytes are those of another suffix."""
    text = b"".join(contents) + bytes(REPEAT_BYTES + 2 * PERIOD)
    raw = np.frombuffer(text, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(raw, 8).copy().view(">u8").ravel().astype(np.uint64)
    counts = np.array([len(c) - REPEAT_BYTES + 1 for c in contents])
    starts = np.concatenate([[0], np.cumsum([len(c) for c in contents])[:-1]])
    firsts = np.cumsum(counts) - counts
    at = np.repeat(starts - firsts, counts) + np.arange(counts.sum())
    ranks = cover_ranks(words, len(raw) - PERIOD)
    places = np.full(PERIOD, -1)
    places[list(COVER)] = np.arange(len(COVER))
    flagged = np.zeros(len(at), bool)

    group = _pair_ranks(words[at], words[at + 8])
    rows = np.argsort(group, kind="stable")
    group = group[rows]
    while len(rows):
        # Ties of the first bytes: all are compared with the first of their group.
        edges = np.concatenate([[True], group[1:] != group[:-1]])
        heads = np.flatnonzero(edges)
        sizes = np.diff(np.append(heads, len(rows)))
        many = np.repeat(sizes > 1, sizes)
        rows, group = rows[many], group[many]
        if not len(rows):
            break
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        pivot = np.repeat(rows[heads], np.diff(np.append(heads, len(rows))))
        a, b = at[rows], at[pivot]
        shift = _SHIFT[a % PERIOD, b % PERIOD]
        place = lambda p: p // PERIOD * len(COVER) + places[p % PERIOD]
        side = np.sign(ranks[place(a + shift)] - ranks[place(b + shift)])
        for more in (RANK_BYTES, RANK_BYTES + 8):
            x, y = words[a + more], words[b + more]
            side = np.where(side == 0, (x > y).astype(np.int64) - (x < y), side)
        equal = side == 0
        other = rows[equal & (rows != pivot)]
        flagged[other] = True
        flagged[pivot[equal & (rows != pivot)]] = True
        rows, key = rows[~equal], group[~equal] * 2 + (side[~equal] > 0)
        order = np.argsort(key, kind="stable")
        rows, group = rows[order], key[order]
        group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if len(group) else group
    return np.split(flagged, np.cumsum(counts)[:-1])


_SPAN = pa.schema([("doc_id", pa.int64()), ("mark", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])
_SPAN_SQL = "doc_id long, mark int, low long, high long"


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of bytes that repeat. Rows come sorted by bucket; a bucket may span batches."""
    held: list[tuple] = []
    bucket: list[tuple] = []
    size = 0

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for row, flags in zip(rows, repeated_suffixes([r[4] for r in rows])):
            if row[2] or not flags.any():
                continue
            steps = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
            for low, high in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)):
                out.append((row[0], row[1], row[5] + int(low), row[5] + int(high) - 1 + REPEAT_BYTES))
        if out:
            yield batch_of(_SPAN, list(zip(*out)))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket and bucket[0][3] != row[3]:
                if len(bucket) > 1:
                    held += bucket
                    size += sum(len(r[4]) for r in bucket)
                bucket = []
                if size >= SORT_BYTES:
                    yield from solve(held)
                    held, size = [], 0
            bucket.append(row)
    if len(bucket) > 1:
        held += bucket
    if held:
        yield from solve(held)


# -- the corpus --------------------------------------------------------------------------

# Buckets that are told to all tasks at most; beyond, they are joined.
TOLD_BUCKETS = 100_000


def _told(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= TOLD_BUCKETS else table


def _block_spans(blocks: DataFrame) -> DataFrame:
    """Spans from blocks, bucket by bucket; crowded buckets go on with smaller blocks."""
    spans = None
    for smaller in (*BLOCKS[1:], None):
        table = staged(blocks)
        crowded = staged(table.groupBy("core").count().where(F.col("count") > BUCKET_BLOCKS).select("core"))
        n = crowded.count() if smaller else 0
        rest = table.join(_told(crowded, n), "core", "left_anti") if n else table
        solved = staged(_solved(rest, last=smaller is None))
        spans = solved if spans is None else spans.unionAll(solved)
        if not n:
            discard(table)
            break
        blocks = table.join(_told(crowded, n), "core", "left_semi").select(*table.columns).mapInArrow(
            _smaller_blocks(smaller), _BLOCK_SQL
        )
    return spans


def _solved(blocks: DataFrame, last: bool) -> DataFrame:
    if last:
        # Blocks of one suffix: a bucket holds equal strings only, so counting is all.
        counts = blocks.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return blocks.join(counts, "core").where(~F.col("known")).select(
            "doc_id", "mark", F.col("start").alias("low"), (F.col("start") + REPEAT_BYTES).alias("high")
        )
    columns = [f.name for f in _BLOCK]
    dealt = blocks.select(*columns).repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(_sorted_buckets, _SPAN_SQL)


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["mark"] == right["mark"])


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(doc_id, mark, low, high): spans of bytes that a repeated string covers. They may overlap.

    ``keyed`` has doc_id, mark (a hash of the text) and text. Rows with the same key are copies.
    """
    runs = staged(keyed.mapInArrow(_runs, _RUN_SQL))
    busy = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    met = staged(runs.join(busy, "gram"))
    discard(runs)
    classes = staged(
        met.groupBy("gram", "same").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "mark", "at")).alias("one"))
    )
    whole = met.join(classes.where("n > 1").select("gram", "same"), ["gram", "same"])
    low = F.shiftright("at", 2 * _SIZE_BITS)
    size = F.shiftright("at", _SIZE_BITS).bitwiseAND(F.lit((1 << _SIZE_BITS) - 1))
    spans = whole.select("doc_id", "mark", low.alias("low"), (low + size - 1 + REPEAT_BYTES).alias("high"))

    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram")
    runs_by_text = (
        classes.join(mixed, "gram", "left_semi")
        .groupBy(F.col("one.doc_id").alias("doc_id"), F.col("one.mark").alias("mark"))
        .agg(F.collect_list(F.struct(F.col("one.at").alias("at"), (F.col("n") > 1).alias("known"))).alias("runs"))
    )
    packed = keyed.mapInArrow(_packed, "doc_id long, mark int, packed binary")
    first = packed.join(runs_by_text, _same_key(packed, runs_by_text)).select(
        packed["doc_id"], packed["mark"], "packed", "runs"
    )
    blocks = first.mapInArrow(_first_blocks(BLOCKS[0]), _BLOCK_SQL)
    return spans.unionAll(_block_spans(blocks))


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
     ("kept_sha256", pa.string()), ("kept", pa.string())]
)
_RESULT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or []):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(s) for s in out]


def _removed(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, packed, found in zip(*(c.to_pylist() for c in batch.columns)):
                raw, spans = _unpacked(packed), _merged(found)
                ends = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
                text = kept.decode("utf-8", "ignore") if with_text else None
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), text))
                size += len(kept)
                if with_text and size >= BATCH_BYTES:
                    yield batch_of(_RESULT, list(zip(*rows)))
                    rows, size = [], 0
            if rows:
                yield batch_of(_RESULT, list(zip(*rows)))

    return run


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept.

    A byte goes if a string of 400 bytes covers it that also begins anywhere else, in the same
    document or another; overlaps count, and strings never cross documents. ``kept`` is the text
    of the bytes that stay, without characters that a cut left incomplete. A null text counts
    as empty. Ids may be null or repeat: each row is a document. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    text = text_of("text")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("mark"), text.alias("text")
    )
    spans = repeated_spans(keyed).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    packed = keyed.mapInArrow(_packed, "doc_id long, mark int, packed binary")
    joined = packed.join(spans, _same_key(packed, spans), "left").select(packed["doc_id"], "packed", "spans")
    result = joined.mapInArrow(_removed(with_text), _RESULT_SQL)
    return result if with_text else result.drop("kept")
