"""Nearest neighbours by cosine in a hierarchical k-means tree.

The tree is fitted to a bounded sample; every vector is then dealt to a leaf. A query walks the
tree best bin first: a priority queue holds the nodes met so far by the nearness of their
centres, the best one is opened next, and leaves are visited in the order in which they come up.
How many leaves a query visits is calibrated: for a set of queries the true neighbours are found
against all rows, and visits widen until the wanted share of them is reached.

Equal vectors are one class, so a vector that half the table repeats is compared once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weighbridge.llm.common import batch_of, bounded_batches, staged

NEAREST = 5
QUERY_STEP = 50

# Classes that the tree is fitted to, at most; it bounds the number of leaves too.
SAMPLE_ROWS = 20_000
BRANCHES = 8
LEAF_ROWS = 1000
LEAF_SAMPLES = 24
LLOYD_ROUNDS = 8

# Queries that calibrate the visits, and the share of their neighbours to reach.
CALIBRATION_QUERIES = 256
RECALL = 0.96

# Vectors and queries that one task compares.
CELL_VECTORS = 20_000
CELL_QUERIES = 4_000
_SLICE = 256


@dataclass
class Tree:
    """Centres of all nodes, root first; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: list[int] = field(default_factory=list)
    sizes: np.ndarray | None = None
    visits: int = 1

    def __post_init__(self):
        count = 0
        self.leaf_of = [-1] * len(self.children)
        for node, below in enumerate(self.children):
            if not below:
                self.leaf_of[node] = count
                count += 1
        self.leaves = count

    def assign(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(units), np.int32)
        work = [(0, np.arange(len(units)))]
        while work:
            node, rows = work.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf_of[node]
                continue
            best = np.argmax(units[rows] @ self.centres[below].T, axis=1)
            work.extend((below[k], rows[best == k]) for k in np.unique(best))
        return out

    def order(self, unit: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-bin-first walk."""
        near = self.centres @ unit
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if not self.children[node]:
                yield self.leaf_of[node]
            for child in self.children[node]:
                heapq.heappush(heap, (-float(near[child]), child))

    def visited(self, unit: np.ndarray, enough: int) -> list[int]:
        """The first leaves, as many as calibrated, and more while they hold too few vectors."""
        out, held = [], 0
        for leaf in self.order(unit):
            if len(out) >= self.visits and held >= enough:
                break
            out.append(leaf)
            held += int(self.sizes[leaf])
        return out


def _kmeans(units: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = units[random.choice(len(units), k, replace=False)]
    for _ in range(LLOYD_ROUNDS):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(sizes > 0, sums / np.where(sizes > 0, sizes, 1), centres)
    return centres, np.argmax(units @ centres.T, axis=1)


def fit_tree(units: np.ndarray, rows: int, seed: int = 11) -> Tree:
    """A tree over unit vectors that stand for ``rows`` vectors."""
    random = np.random.default_rng(seed)
    per = rows / max(1, len(units))
    centres, children = [np.zeros(units.shape[1])], [[]]
    work = [(0, np.arange(len(units)))]
    while work:
        node, own = work.pop()
        if len(own) * per <= LEAF_ROWS or len(own) < LEAF_SAMPLES * BRANCHES:
            continue
        found, kind = _kmeans(units[own], BRANCHES, random)
        parts = [(c, own[kind == k]) for k, c in enumerate(found) if (kind == k).any()]
        if len(parts) < 2:
            continue
        for centre, rows_ in parts:
            children[node].append(len(centres))
            work.append((len(centres), rows_))
            centres.append(centre)
            children.append([])
    return Tree(np.array(centres), children)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def best_in(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, reps: np.ndarray, keep: int):
    """(query id, class, score) of the ``keep`` nearest classes of each query, ties to the smaller class.

    Rough scores choose somewhat more than is kept; the scores that decide are sums over one
    pair each, so they do not depend on what else is in the block.
    """
    right = unit(vectors)
    out = []
    for at in range(0, len(queries), _SLICE):
        left = unit(queries[at : at + _SLICE])
        rough = left @ right.T
        if rough.shape[1] > keep:
            cut = np.partition(rough, rough.shape[1] - keep, axis=1)[:, -keep]
        else:
            cut = np.full(len(left), -2.0)
        rows, cols = np.nonzero(rough >= cut[:, None] - 1e-12)
        exact = (left[rows] * right[cols]).sum(axis=1)
        by = np.lexsort((reps[cols], -exact, rows))
        rows, cols, exact = rows[by], cols[by], exact[by]
        first = np.searchsorted(rows, np.arange(len(left)))
        ok = np.arange(len(rows)) - first[rows] < keep
        out.append((ids[at + rows[ok]], reps[cols[ok]], exact[ok]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]


_FOUND = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])


def _valid(vector: str) -> Column:
    """Not null, not empty, finite throughout and not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def _top(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep).drop("_n")


def _brute(classes: DataFrame, ids: np.ndarray, vectors: np.ndarray, keep: int) -> DataFrame:
    """The nearest classes of a bounded set of queries among all classes."""
    shipped = classes.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        for batch in batches:
            if batch.num_rows:
                yield batch_of(_FOUND, best_in(vectors, ids, matrix(batch.column(1)), batch.column(0).to_numpy(), keep))

    return _top(classes.select("rep", "vector").mapInArrow(run, "query long, rep long, score double"), keep)


def _leafed(classes: DataFrame, tree: Tree) -> DataFrame:
    shipped = classes.sparkSession.sparkContext.broadcast(tree)
    schema = pa.schema([("rep", pa.int64()), ("vector", pa.list_(pa.float64())), ("leaf", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shipped.value.assign(unit(matrix(batch.column(1))))
                yield batch_of(schema, [batch.column(0), batch.column(1), leaf])

    return classes.select("rep", "vector").mapInArrow(run, "rep long, vector array<double>, leaf int")


def _walks(queries: DataFrame, tree: Tree, enough: int) -> DataFrame:
    """One row per query and leaf it visits."""
    shipped = queries.sparkSession.sparkContext.broadcast(tree)
    schema = pa.schema([("query", pa.int64()), ("vector", pa.list_(pa.float64())), ("leaf", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shipped.value
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                walks = [tree.visited(u, enough) for u in unit(matrix(part.column(1)))]
                rows = np.repeat(np.arange(part.num_rows), [len(w) for w in walks])
                yield batch_of(schema, [
                    part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)), np.concatenate(walks)
                ])

    return queries.mapInArrow(run, "query long, vector array<double>, leaf int")


def _calibrated(tree: Tree, classes: DataFrame, ids: np.ndarray, vectors: np.ndarray, keep: int) -> int:
    """The leaves to visit so that the wanted share of the true neighbours is met."""
    true = _brute(classes, ids, vectors, keep).join(classes.select("rep", "leaf"), "rep").select("query", "leaf").collect()
    place = {}
    for q, u in zip(ids.tolist(), unit(vectors)):
        place[q] = {leaf: n for n, leaf in enumerate(tree.order(u))}
    needed = sorted(place[r["query"]][r["leaf"]] + 1 for r in true)
    return needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)] if needed else 1


def nearest(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", keep: int = NEAREST) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score: the nearest rows of each row that ``is_query``.

    The score is the cosine in double precision; a row is not its own neighbour; equal scores
    go to the smaller id. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do rows with a null id or vectors of another dimension than
    the first row's by id. Rows with the same id and vector count once. A query gets all other
    rows where there are fewer than ``keep``. No rows give no rows.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    usable = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    usable = usable.where(F.col("id").isNotNull() & _valid("vector"))
    first = usable.agg(F.min_by(F.size("vector"), "id")).first()[0]
    usable = usable.where(F.size("vector") == F.lit(first or 0))

    # Equal vectors are one class, named by the smallest id; so many ids of it can be needed.
    spare = keep + 1
    order = Window.partitionBy("vector").orderBy("id")
    few = usable.select("id", "vector").withColumn("_n", F.dense_rank().over(order)).where(F.col("_n") <= spare)
    members = few.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = staged(members.select(F.col("ids")[0].alias("rep"), "ids", "vector"))
    asking = staged(
        usable.where("asks").select("id", "vector").distinct()
        .join(classes.select("rep", "vector"), "vector").select(F.col("id").alias("query_id"), "rep")
    )

    total = classes.count()
    sample = classes.select("rep", "vector").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).toArrow()
    tree = fit_tree(unit(matrix(sample.column(1))), total) if total else Tree(np.zeros((1, 1)), [[]])
    leafed = staged(_leafed(classes, tree))
    counts = {r["leaf"]: r["n"] for r in leafed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    tree.sizes = np.array([counts.get(k, 0) for k in range(tree.leaves)])
    queries = asking.select("rep").distinct().join(classes.select("rep", "vector"), "rep").select(F.col("rep").alias("query"), "vector")
    probe = queries.orderBy(F.xxhash64("query"), "query").limit(CALIBRATION_QUERIES).toArrow()
    if probe.num_rows:
        tree.visits = _calibrated(tree, leafed, probe.column(0).to_numpy(), matrix(probe.column(1)), spare)

    # A cell is a leaf's block of vectors and a block of the queries that visit it.
    walks = staged(_walks(queries, tree, 4 * spare))
    asked = walks.groupBy("leaf").agg(F.count(F.lit(1)).alias("q"))
    held = leafed.groupBy("leaf").agg(F.count(F.lit(1)).alias("v"))
    blocks = held.join(asked, "leaf").select(  # a row per leaf, which the sample bounds
        "leaf", F.ceil(F.col("v") / CELL_VECTORS).cast("int").alias("vs"), F.ceil(F.col("q") / CELL_QUERIES).cast("int").alias("qs")
    )
    left = walks.join(F.broadcast(blocks), "leaf").select(
        "leaf", F.pmod(F.xxhash64("query"), "qs").cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("vs") - 1)).alias("vb"), "query", "vector",
    )
    right = leafed.join(F.broadcast(blocks), "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"),
        F.pmod(F.xxhash64("rep"), "vs").cast("int").alias("vb"), "rep", "vector",
    )

    def cell(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return _FOUND.empty_table()
        q, v = matrix(asked.column("vector")), matrix(held.column("vector"))
        found = best_in(q, asked.column("query").to_numpy(), v, held.column("rep").to_numpy(), spare)
        return pa.Table.from_batches([batch_of(_FOUND, found)])

    keys = ["leaf", "qb", "vb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query long, rep long, score double")
    best = _top(found, spare).join(classes.select("rep", "ids"), "rep")
    listed = (
        best.select("query", "score", F.explode("ids").alias("id"))
        .groupBy("query")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "id"))), 1, spare).alias("near"))
    )
    own = asking.join(listed, asking["rep"] == listed["query"]).select(
        "query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, keep).alias("near")
    )
    return own.select("query_id", F.posexplode("near").alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias(id_col),
        (-F.col("hit.less")).alias("score"),
    )
