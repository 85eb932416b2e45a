"""Near-duplicates by SimHash, searched by pigeonring filtering.

A 64-bit fingerprint is a ring of four segments. If two fingerprints differ in at most
``MAX_BITS`` bits, then from some segment on every chain of consecutive segments stays within
its share of the budget: 0 bits in the first segment, 1 in two, 2 in three. So fingerprints are
dealt by (start, first segment); inside a cell the second segment is matched with at most one
flipped bit, the third segment's chain prunes what is left, and the full Hamming distance
decides. A cell gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import batch_of, bounded_batches, one_row_each, staged, text_of, texts
from weighbridge.llm.components import connected_components

WORDS = 3
SEED = 42
MAX_BITS = 3
SEGMENTS = 4
BITS = 64 // SEGMENTS
_MASK = (1 << BITS) - 1

# Budgets of chains of one, two and three segments.
BUDGETS = [MAX_BITS * n // SEGMENTS for n in (1, 2, 3)]

# Fingerprints of a cell before it is compared block by block, and pairs at once in a task.
BLOCK_ROWS = 100_000
_PAIRS = 1 << 21

_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE_SLOTS = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str) -> int:
    """The SimHash of one text as an unsigned integer; 0 if it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < WORDS:
        return digest(b" ".join(words), SEED)
    shingles = zip(*(words[i:] for i in range(WORDS)))
    counts = np.zeros(2048, np.int64)
    total = len(words) - WORDS + 1
    block: list[int] = []
    for shingle in shingles:
        block.append(digest(b" ".join(shingle), SEED))
        if len(block) == 1 << 16:
            counts += _byte_counts(block)
            block = []
    if block:
        counts += _byte_counts(block)
    ones = (counts.reshape(8, 256) @ _BIT_TABLE).ravel()
    bits = (2 * ones > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _byte_counts(hashes: list[int]) -> np.ndarray:
    columns = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8) + _BYTE_SLOTS
    return np.bincount(columns.ravel(), minlength=2048)


_PRINT_SCHEMA = "doc_id long, text_hash long, fp long"


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        prints = np.array([fingerprint(t) for t in texts(batch.column(2))], np.uint64).view(np.int64)
        yield batch_of(schema, [batch.column(0), batch.column(1), prints])


def forest(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> None:
    """Joins the pairs (a, b) in ``parent``, a flat forest over 0..n-1 that points to the smallest."""
    while len(a):
        pa_, pb = parent[a], parent[b]
        open_ = pa_ != pb
        a, b, pa_, pb = a[open_], b[open_], pa_[open_], pb[open_]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _spans(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for each j in left[i]..right[i], in portions of about ``_PAIRS`` pairs."""
    sizes = np.maximum(right - left, 0)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _PAIRS, side="right")))
        part = sizes[at:to]
        rows = np.repeat(np.arange(at, to), part)
        first = np.repeat(ends[at:to] - part - done, part)
        yield rows, left[rows] + (np.arange(len(rows)) - first)
        at = to


def linked_forest(cells: np.ndarray, starts: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """For each fingerprint the smallest index it is linked to inside its cell.

    ``starts`` is the segment at which the cell's chains begin.
    """
    n = len(prints)
    order = np.arange(n)
    parent = order.copy()
    turned = prints.copy()
    for s in range(1, SEGMENTS):
        at = starts == s
        turned[at] = (prints[at] >> np.uint64(BITS * s)) | (prints[at] << np.uint64(64 - BITS * s))
    _, dense = np.unique(cells, return_inverse=True)
    second = ((turned >> np.uint64(BITS)) & np.uint64(_MASK)).astype(np.int64)
    code = (dense.astype(np.int64) << BITS) | second
    by = np.argsort(code, kind="stable")
    sorted_code = code[by]
    chain = [np.uint64((1 << (BITS * k)) - 1) for k in (1, 2, 3)]

    def link(i: np.ndarray, j: np.ndarray) -> None:
        fresh = parent[i] != parent[j]
        i, j = i[fresh], j[fresh]
        x = turned[i] ^ turned[j]
        for mask, budget in zip(chain, BUDGETS):
            ok = np.bitwise_count(x & mask) <= budget
            i, j, x = i[ok], j[ok], x[ok]
        ok = np.bitwise_count(x) <= MAX_BITS
        forest(n, i[ok], j[ok], parent)

    own_end = np.searchsorted(sorted_code, sorted_code, side="right")
    for i, j in _spans(order + 1, own_end):
        link(by[i], by[j])
    for bit in range(BITS):
        # Each pair is met from both of its sides; one is enough.
        near = code[(code >> bit) & 1 == 0] | (1 << bit)
        who = np.flatnonzero((code >> bit) & 1 == 0)
        left = np.searchsorted(sorted_code, near, side="left")
        right = np.searchsorted(sorted_code, near, side="right")
        for i, j in _spans(left, right):
            link(who[i], by[j])
    return parent


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside cells; the rows come sorted by cell. A cell may span batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        key, lo, hi, fp, node = (c.to_numpy() for c in table.columns)
        new = np.flatnonzero((np.diff(key) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
        cells = np.zeros(len(key), np.int64)
        cells[new] = 1
        parent = linked_forest(np.cumsum(cells), key >> BITS, fp.view(np.uint64))
        tied = np.flatnonzero(parent != np.arange(len(parent)))
        if len(tied):
            yield batch_of(schema, [node[tied], node[parent[tied]]])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < BLOCK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        last = [c[-1].as_py() for c in table.columns[:3]]
        keys = [c.to_numpy() for c in table.columns[:3]]
        open_ = np.logical_and.reduce([k == v for k, v in zip(keys, last)])
        cut = int(np.argmax(open_))
        yield from solve(table.slice(0, cut))
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield from solve(pa.Table.from_batches(held))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, fingerprint, component_id, text_hash (xxhash64 of the text).

    Documents are linked when their fingerprints differ in at most three bits; component_id is
    the smallest id that links reach. Documents without words have fingerprint 0 and are linked
    like any other. A null text counts as empty. A row with a null id takes the component of
    its fingerprint, and links nothing itself. Rows may repeat. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    prints = staged(rows.mapInArrow(_fingerprints, _PRINT_SCHEMA))

    # Equal fingerprints are one node, named by the smallest id.
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"))
    start = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start")
    segment = F.expr(f"shiftrightunsigned(fp, cast(start * {BITS} as int)) & {_MASK}L")
    dealt = nodes.select("fp", "node", start).select(
        F.expr(f"shiftleft(cast(start as long), {BITS})").bitwiseOR(segment).alias("key"), "fp", "node"
    )
    full = dealt.groupBy("key").count().where(F.col("count") > BLOCK_ROWS)
    blocks = full.select("key", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # A cell that is too large becomes one cell per pair of its blocks.
    celled = (
        dealt.join(blocks, "key", "left")
        .withColumn("own", F.coalesce(block, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp", "node")
    )
    cells = celled.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    edges = cells.mapInArrow(_link_cells, "a long, b long")
    parts = connected_components(edges)
    named = nodes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        F.col("doc_id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "text_hash",
    )


def near_kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) without near-duplicates.

    Of each group the row with the smallest id stays, of rows that share it the one with the
    smallest text hash. Rows with a null id stay where no row with an id is near.
    """
    groups = near_groups(docs)
    first = groups.where("component_id is not null").groupBy("component_id").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("one")
    )
    alone = groups.where("component_id is null").select("doc_id", "text_hash")
    keys = first.select("one.doc_id", "one.text_hash").unionAll(alone)
    return one_row_each(docs, F.xxhash64(text_of("text")), keys.withColumnRenamed("text_hash", "_key"))
