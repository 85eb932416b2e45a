"""Jaccard join of word shingles by a token-group matrix.

A document is the set of its shingles. Equal sets are one node. Similar nodes are partitioned
into groups, by the least hashes of the frequent part of their sets; a group that is too large is
cut. The matrix says which shingles occur in which group: a group stores the union of its members'
sets. How many shingles a node shares with that union bounds what it shares with any member, so
only groups whose bound reaches the least similarity are opened and compared member by member.

Which groups may reach the bound is read from the matrix over prefixes: in one order of all
shingles, rarest first, two similar sets must meet in their first tenth, and the first shingle
that they share has few places before it. The order comes from counts over all documents; it
steers the work and decides nothing. Of what is left, the matrix by bins of shingles bounds the
shared part once more: a sketch counts a set's shingles by bin, a group has the largest counts
of its members. Only texts that pass both bounds travel, compressed.

Links become components in three steps, so that a large group of near copies is never compared
pair by pair: inside groups; between one leader for each component of a group; last between each
node and the groups that hold similar members of other components. No link is lost: a pair whose
sides are in one component already needs no look.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import batch_of, bounded_batches, discard, in_slices, staged, text_of, texts
from weighbridge.llm.components import connected_components
from weighbridge.operators.skew import join_heaviest_first

WORDS = 3
# The least similarity, as a fraction of whole numbers.
PART, WHOLE = 90, 100

# A group's nodes and shingles before it is cut, and the queries of a group that one task takes.
GROUP_NODES = 256
GROUP_SHINGLES = 1 << 20
SLICE_QUERIES = 4096

# Counters by which shingles are ordered, and least hashes that name a group.
_COUNTER_BITS = 17
_LEAST = 3

# The fewest bins of a sketch, as a power of two, shingles per bin at most, and the count from
# which a bin says nothing.
LEAST_BINS = 5
BIN_SHINGLES = 8
FULL = 255

# Texts that are told to all tasks by their keys at most; beyond, the texts are joined.
TOLD_TEXTS = 100_000

# Words of more bytes are hashed one by one.
_LONG_WORD = 64
_GAP = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """The 64-bit hashes of the words of a text, in their order; eight bytes of all words at a time."""
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = _GAP[np.frombuffer(raw, np.uint8)]
    turns = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = turns[::2], turns[1::2]
    sizes = ends - starts
    eight = np.ndarray((len(raw) + 1,), "<u8", raw + bytes(8), strides=(1,))
    out = _mixed(_mixed(sizes.astype(np.uint64)) + (eight[starts] & _MASK[np.minimum(sizes, 8)]))
    at, more = 8, np.flatnonzero(sizes > 8)
    while len(more) and at < _LONG_WORD:
        out[more] = _mixed(out[more] + (eight[starts[more] + at] & _MASK[np.minimum(sizes[more] - at, 8)]))
        at += 8
        more = more[sizes[more] > at]
    for i in more.tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]])
    return out


def shingle_run(text: str) -> np.ndarray:
    """The 64-bit hashes of the shingles of a text, repeats included. A text of fewer words is one shingle."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    hashes = word_hashes(raw)
    if len(hashes) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(raw.split()), 1)] if len(hashes) else [], np.uint64)
    n = len(hashes) - WORDS + 1
    every = _mixed(hashes[:n])
    for i in range(1, WORDS):
        every = _mixed(every + hashes[i : i + n])
    return every


def shingles(text: str) -> np.ndarray:
    """The hashes of the distinct shingles of a text, sorted."""
    every = np.sort(shingle_run(text))
    first = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=first[1:])
    return every[first]


# -- the order of shingles -----------------------------------------------------------------


def _counters(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _COUNTER_BITS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("counter", pa.int32()), ("n", pa.int64())])
    here = np.zeros(1 << _COUNTER_BITS, np.int64)
    for batch in in_slices(batches, 256):
        if batch.num_rows:
            every = np.concatenate([shingle_run(t) for t in texts(batch.column(0))])
            here += np.bincount(_counters(every), minlength=len(here))
    met = np.flatnonzero(here)
    if len(met):
        yield batch_of(schema, [met, here[met]])


def shingle_counts(rows: DataFrame) -> np.ndarray:
    """How often shingles occur in the texts, added up by counter."""
    told = rows.select("text").mapInArrow(_counted, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    out, table = np.zeros(1 << _COUNTER_BITS, np.int64), told.toArrow()
    out[table["counter"].to_numpy()] = table["n"].to_numpy()
    return out


def least_common(n: int) -> int:
    """The fewest shingles that a set of ``n`` shares with a similar one."""
    return -(-PART * n // WHOLE)


def sketch_of(own: np.ndarray) -> bytes:
    """How many of the hashes fall in each bin, at most ``FULL``. Larger sets have more bins."""
    bins = 1 << max(LEAST_BINS, (len(own) // BIN_SHINGLES).bit_length())
    return np.minimum(np.bincount((own & np.uint64(bins - 1)).astype(np.int64), minlength=bins), FULL).astype(np.uint8).tobytes()


def folded(sketches: np.ndarray, bins: int) -> np.ndarray:
    """The sketches, one per row, with fewer bins."""
    while sketches.shape[1] > bins:
        half = sketches.shape[1] // 2
        sketches = np.minimum(sketches[:, :half].astype(np.uint16) + sketches[:, half:], FULL).astype(np.uint8)
    return sketches


def most_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """No fewer than the shingles that two sets share, from sketches in rows. Where both are full, no bound."""
    bins = min(left.shape[1], right.shape[1])
    least = np.minimum(folded(left, bins), folded(right, bins))
    return np.where((least == FULL).any(axis=1), np.iinfo(np.int64).max // WHOLE // 2, least.sum(axis=1, dtype=np.int64))


_SET_SCHEMA = "doc_id long, text_hash long, n long, d1 long, d2 long, likeness long, prefix array<long>, sketch binary"
_FACTORS = _mixed(np.arange(1, _LEAST + 1, dtype=np.uint64)) | np.uint64(1)


def _sets(counts: np.ndarray):
    fields = [(n, pa.int64()) for n in ("doc_id", "text_hash", "n", "d1", "d2", "likeness")]
    schema = pa.schema([*fields, ("prefix", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            rows = []
            for text in texts(batch.column(2)):
                own = shingles(text)
                order = np.argsort(counts[_counters(own)], kind="stable")
                first = len(own) - least_common(len(own)) + 1 if len(own) else 0
                prefix, rest = own[order[:first]], own[order[first:]]
                least = ((rest if len(rest) else own)[:, None] * _FACTORS).min(axis=0, initial=(1 << 64) - 1)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                likeness = xxhash.xxh64_intdigest(least.tobytes())
                named = np.frombuffer(digest, np.int64).tolist() + [int(np.uint64(likeness).astype(np.int64))]
                rows.append((len(own), *named, prefix.view(np.int64), sketch_of(own)))
            if rows:
                yield batch_of(schema, [batch.column(0), batch.column(1), *zip(*rows)])

    return run


# -- groups --------------------------------------------------------------------------------


def linked_sets(sets: list[np.ndarray]) -> np.ndarray:
    """For each of the sets, none empty, the index of the first one of its component."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    present = np.zeros(int(flat.max()) + 1, bool)
    root = np.full(len(sets), -1, np.int64)
    for first in range(len(sets)):
        if root[first] >= 0:
            continue
        root[first] = first
        open_ = [first]
        while open_:
            one = open_.pop()
            rows = np.flatnonzero(root < 0)
            if not len(rows):
                break
            own = flat[ends[one] - sizes[one] : ends[one]]
            present[own] = True
            both = np.add.reduceat(present[flat], ends - sizes, dtype=np.int64)[rows]
            present[own] = False
            near = rows[WHOLE * both >= PART * (sizes[one] + sizes[rows] - both)]
            root[near] = first
            open_.extend(near.tolist())
    return root


class Group:
    """The members of a group, the union of their sets, and who among them is like a query."""

    def __init__(self, members: dict[int, tuple[int, np.ndarray]]):
        self.nodes = np.array(list(members), np.int64)
        self.parts = np.array([c for c, _ in members.values()], np.int64)
        self.sizes = np.array([len(s) for _, s in members.values()], np.int64)
        self.union, self.flat = np.unique(np.concatenate([s for _, s in members.values()]), return_inverse=True)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.present = np.zeros(len(self.union), bool)

    def links(self, part: int, own: np.ndarray) -> list[int]:
        """A similar member for each other component that has one."""
        at = np.searchsorted(self.union, own)
        inner = at[at < len(self.union)]
        at = inner[self.union[inner] == own[: len(inner)]]
        if len(at) < least_common(len(own)):
            return []
        self.present[at] = True
        both = np.add.reduceat(self.present[self.flat], self.starts, dtype=np.int64)
        self.present[at] = False
        near = np.flatnonzero((WHOLE * both >= PART * (len(own) + self.sizes - both)) & (self.parts != part))
        _, one = np.unique(self.parts[near], return_index=True)
        return self.nodes[near[one]].tolist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they travel; the other columns as they are."""
    tool = zstandard.ZstdCompressor(level=3)
    for batch in in_slices(batches, 256):
        small = pa.array([tool.compress(t.encode("utf-8", "surrogatepass")) for t in texts(batch.column("text"))], pa.binary())
        kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in kept), small], names=[*(n for n, _ in kept), "packed"])


def _unpacked(packed: bytes) -> np.ndarray:
    return shingles(zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass"))


_MEMBER, _QUERY = 0, 1


def _opened(within: bool):
    """Links of groups whose rows come together, members first: inside each, or from its queries."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def inside(members: dict[int, tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
        if not within or len(members) < 2:
            return []
        nodes, root = list(members), linked_sets([s for _, s in members.values()])
        return [(nodes[i], nodes[r]) for i, r in enumerate(root.tolist()) if r != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, group = None, {}, None
        for batch in in_slices(batches, 256):
            edges = []
            for *now, role, node, part, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    edges += inside(members)
                    key, members, group = now, {}, None
                if role == _MEMBER:
                    if node not in members:
                        members[node] = (part, _unpacked(packed))
                    continue
                group = group or Group(members)
                edges += [(node, other) for other in group.links(part, _unpacked(packed))]
            if edges:
                yield batch_of(schema, list(zip(*edges)))
        if edges := inside(members):
            yield batch_of(schema, list(zip(*edges)))

    return run


def _links(rows: DataFrame, within: bool) -> DataFrame:
    """``rows`` (group, slice, role, node, part, packed) to links (a, b)."""
    keys = ["group", "slice", "role"]
    dealt = rows.select(*keys, "node", "part", "packed").repartition("group", "slice").sortWithinPartitions(*keys)
    return dealt.mapInArrow(_opened(within), "a long, b long")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (node, doc_id, text_hash, more), a staged table, with the node's text as ``packed``."""
    more = [F.col(c) for c in wanted.columns if c not in ("doc_id", "text_hash")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name not in ("doc_id", "text_hash"))
    if wanted.count() <= TOLD_TEXTS:
        same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["text_hash"] == wanted["text_hash"])
        met = docs.join(F.broadcast(wanted), same).select(*more, "text")
        return met.mapInArrow(_packed, f"{kinds}, packed binary")
    small = docs.select("doc_id", "text_hash", "text").mapInArrow(_packed, "doc_id long, text_hash long, packed binary")
    same = small["doc_id"].eqNullSafe(wanted["doc_id"]) & (small["text_hash"] == wanted["text_hash"])
    return small.join(wanted, same).select(*more, "packed")


def _group_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest counts of the sketches of each group. Rows come sorted by group; one may span batches."""
    schema = pa.schema([("other", pa.int64()), ("union", pa.binary())])
    key, held = None, None
    for batch in batches:
        done = []
        for group, sketch in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(sketch, np.uint8)[None]
            if group == key:
                bins = min(own.shape[1], held.shape[1])
                held = np.maximum(folded(held, bins), folded(own, bins))
                continue
            if key is not None:
                done.append((key, held.tobytes()))
            key, held = group, own
        if done:
            yield batch_of(schema, list(zip(*done)))
    if key is not None:
        yield batch_of(schema, [[key], [held.tobytes()]])


def _within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, other) of the rows (node, other, n, sketch, union) whose sketches allow a similar member."""
    for batch in in_slices(batches, 4096):
        kinds = defaultdict(list)
        sides = [batch.column(i).to_pylist() for i in (3, 4)]
        for i, (own, union) in enumerate(zip(*sides)):
            kinds[len(own), len(union)].append(i)
        able, sizes = np.zeros(batch.num_rows, bool), batch.column(2).to_numpy()
        for rows in kinds.values():
            own, union = (np.frombuffer(b"".join([side[i] for i in rows]), np.uint8).reshape(len(rows), -1) for side in sides)
            able[rows] = WHOLE * most_common(own, union) >= PART * sizes[rows]
        yield batch.select([0, 1]).filter(pa.array(able))


def _links_between(docs: DataFrame, post: DataFrame, nodes: DataFrame, unions: DataFrame) -> DataFrame:
    """Links between nodes of different groups that are not in one component.

    ``post`` (token, place, node, group, n, part) are the prefixes of the nodes, ``nodes`` (node,
    group, n, part, doc_id, text_hash, sketch) what is known of them, ``unions`` (other, union) the sketches
    of groups. The first shingle of the order that two similar sets share has no more places before
    it, in either, than the shingles that the set may have alone.
    """
    reach = (WHOLE * F.col("n") - (WHOLE + PART) * F.col("place")).alias("reach")
    matrix = post.groupBy("token", F.col("group").alias("other")).agg(
        F.min("n").alias("least"), F.max(reach).alias("most"), F.min("part").alias("p0"), F.max("part").alias("p1")
    )
    alike = (reach >= PART * F.col("least")) & (F.col("most") >= PART * F.col("n"))
    apart = (F.col("p0") != F.col("part")) | (F.col("p1") != F.col("part"))
    met = post.join(matrix, "token").where((F.col("group") < F.col("other")) & alike & apart).select("node", "other").distinct()
    told = met.join(nodes.select("node", "n", "sketch"), "node").join(unions, "other")
    asked = staged(told.select("node", "other", "n", "sketch", "union").mapInArrow(_within_bound, "node long, other long"))
    slices = asked.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / SLICE_QUERIES).cast("int").alias("slices"))
    own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice")
    roles = ["group", "slice", F.lit(_QUERY).alias("role"), "node"]
    queries = asked.join(slices, "other").select("node", F.col("other").alias("group"), own).select(*roles)
    roles = ["group", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(_MEMBER).alias("role"), "node"]
    members = nodes.join(slices.withColumnRenamed("other", "group"), "group").select(*roles)
    dealt = staged(members.unionByName(queries))
    wanted = staged(nodes.join(dealt.select("node").distinct(), "node").select("node", "part", "doc_id", "text_hash"))
    found = staged(_links(dealt.join(_texts_of(docs, wanted), "node"), within=False))
    for table in (asked, dealt, wanted):
        discard(table)
    return found


def _named(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component of each node as ``part``."""
    parts = connected_components(links).select("node", "component")
    return rows.drop("part").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")


def _linked(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links by which the nodes' components are whole."""
    post = nodes.select("node", "n", "likeness", F.posexplode("prefix").alias("place", "token"))
    shared = post.groupBy("token").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    met = staged(post.join(shared, "token", "left_semi"))
    sizes = met.select("node", "n", "likeness").distinct().groupBy("likeness").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_NODES, F.sum("n") / GROUP_SHINGLES)).alias("cuts"),
    )
    cut = F.pmod(F.xxhash64("node"), F.coalesce("cuts", F.lit(1)))
    live = staged(
        met.join(sizes.where("cuts > 1"), "likeness", "left")
        .select("token", "place", "node", "n", F.xxhash64("likeness", cut).alias("group"))
    )
    discard(met)
    known = staged(
        nodes.select("node", "n", "doc_id", "text_hash", "sketch").join(live.select("node", "group").distinct(), "node")
    )
    dealt = known.select("group", "sketch").repartition("group").sortWithinPartitions("group")
    unions = staged(dealt.mapInArrow(_group_sketches, "other long, union binary"))

    several = known.groupBy("group").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    inner = staged(known.join(several, "group", "left_semi").select("node", "group", "doc_id", "text_hash"))
    alone = _texts_of(docs, inner).select(
        "group", F.lit(0).alias("slice"), F.lit(_MEMBER).alias("role"), "node", F.col("node").alias("part"), "packed"
    )
    links = staged(_links(alone, within=True))

    first = _named(known.select("node", "group"), links)
    leaders = staged(first.groupBy("group", "part").agg(F.min("node").alias("node")).select("node", "part"))
    links = links.unionAll(_links_between(docs, live.join(leaders, "node"), known.join(leaders, "node"), unions))

    parts = staged(_named(known.select("node"), links))
    rest = _links_between(docs, live.join(parts, "node"), known.join(parts, "node"), unions)
    for table in (live, known, unions, inner, leaders, parts):
        discard(table)
    return links.unionAll(rest)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id.

    Documents are linked when they share at least ``PART`` of ``WHOLE`` parts of the distinct
    shingles that either has; component_id is the smallest id that links reach. A text with fewer
    words than a shingle is one shingle. A null text counts as empty; texts without words have no
    shingles and are linked with nothing, each its own component. Ids may repeat: each row is a
    document. A row with a null id is linked like any other; component_id is null where no id is
    reached. Other columns are ignored. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    text = text_of(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sets = staged(rows.mapInArrow(_sets(shingle_counts(rows)), _SET_SCHEMA))
    one = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    nodes = staged(
        sets.where("n > 0").groupBy("d1", "d2")
        .agg(
            F.min(one).alias("one"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
            F.max("likeness").alias("likeness"), F.max("prefix").alias("prefix"), F.max("sketch").alias("sketch"),
        )
        .select("d1", "d2", "copies", "n", "likeness", "prefix", "sketch", "one.doc_id", "one.text_hash")
        .withColumn("node", F.monotonically_increasing_id())
    )
    parts = connected_components(_linked(rows, nodes))
    least = parts.unionAll(parts.select("component", "component").distinct()).join(nodes.select("node", "doc_id"), "node")
    least = least.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = parts.unionAll(parts.select("component", "component").distinct()).join(least, "component")
    # Sets of one document without links name themselves.
    named = nodes.join(linked.select("node", "component_id", F.lit(True).alias("tied")), "node", "left").where("copies > 1 or tied")
    lookup = named.select("d1", "d2", "copies", F.when(F.col("tied"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    counted = sets.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "d1", "d2")
    found = join_heaviest_first(counted, lookup, ["d1", "d2"], "copies", [F.col("doc_id"), F.col("text_hash")])
    own: Column = F.when((F.col("n_shingles") > 0) & F.col("found").isNotNull(), F.col("found.component_id")).otherwise(F.col("doc_id"))
    return found.select(F.col("doc_id").alias(id_col), "n_shingles", own.alias("component_id"))
