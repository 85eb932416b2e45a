"""Product codes of vectors in exact integer arithmetic.

Components become integers. Vectors are cut into equal parts, each part position has a codebook,
and a part's code is the index of the nearest entry. The codebooks start from the vectors with
the smallest ids and are improved by rounds over all rows: each task adds up the parts of each
entry, Spark adds the tasks up.

Distances come from matrix products. Integers are split into limbs so small that every product
and sum of a float64 product stays below 2**53 and is exact; the products of limbs are put
together as 64-bit integers. The first of the least distances wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import batch_of, bounded_batches, in_slices, staged
from weighbridge.operators.skew import join_heaviest_first

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4

# float64 holds all integers up to this power of two.
EXACT_BITS = 53
# A part's squared distance and the sum over all parts must stay below 2**62.
DISTANCE_BITS = 62

_BLOCK_ROWS = 4096


def largest_component(width: int) -> int:
    """The largest integer component for which the error of a vector of that width fits in a long."""
    return (1 << (DISTANCE_BITS - max(1, width - 1).bit_length()) // 2) // 2 - 1


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays whose sum, each shifted by ``bits`` more than the one before, gives the integers."""
    out = []
    while True:
        rest = values >> bits
        # Numbers of both signs: what is left of each is its sign, and the highest limb holds it.
        if ((rest == 0) | (rest == -1)).all():
            return [*out, values.astype(np.float64)]
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = rest


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of integer matrices, in int64, by float64 products of limbs."""
    # A limb is below 2**bits in magnitude, the highest one in two's complement as well.
    bits = (EXACT_BITS - max(1, left.shape[1]).bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest row of ``book`` to each point, the first of equals, and its squared distance."""
    far = (book * book).sum(axis=1) - 2 * exact_products(points, book)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(points)), code] + (points * points).sum(axis=1)


def integer_rows(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are of that width with components that can be used, and their integers.

    ``width`` 0 means none.
    """
    fits = np.zeros(len(vectors), bool)
    if not len(vectors) or not width:
        return fits, np.zeros((0, width), np.int64)
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    fits = lengths == width
    values = vectors.filter(pa.array(fits)).flatten().cast(pa.float64())
    rows = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, width)
    with np.errstate(over="ignore", invalid="ignore"):
        rows = np.floor(rows * SCALE)
        good = (np.abs(rows) <= largest_component(width)).all(axis=1)
    fits[np.flatnonzero(fits)[~good]] = False
    return fits, rows[good].astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return in_slices(batches, _BLOCK_ROWS)


def _sums(books: np.ndarray | None, width: int):
    """Sums and counts of the parts of each entry over a task: (part, entry, n, s0, s1, ...)."""
    size = width // PARTS
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), *((f"s{i}", pa.int64()) for i in range(size))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, books.shape[1]), np.int64)
        sums = np.zeros((PARTS, books.shape[1], size), np.int64)
        for batch in _batches(batches):
            _, rows = integer_rows(batch.column(0), width)
            for p in range(PARTS):
                points = rows[:, p * size : (p + 1) * size]
                code, _ = nearest_entries(points, books[p])
                counts[p] += np.bincount(code, minlength=books.shape[1])
                order = np.argsort(code, kind="stable")
                met = np.flatnonzero(np.bincount(code, minlength=books.shape[1]))
                if len(met):
                    sums[p, met] += np.add.reduceat(points[order], np.searchsorted(code[order], met), axis=0)
        part, entry = np.nonzero(counts)
        if len(part):
            yield batch_of(schema, [part, entry, counts[part, entry], *sums[part, entry].T])

    return run, ", ".join(["part int", "entry int", "n long", *(f"s{i} long" for i in range(size))])


def improved(vectors: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after one round over all rows; entries without parts stay."""
    run, schema = _sums(books, width)
    size = width // PARTS
    sums = [F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    told = vectors.mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)
    after = books.copy()
    for r in told.collect():  # a row per part and entry
        after[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    return after


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(books: np.ndarray, width: int):
    schema = pa.schema([("code", pa.string()), ("error", pa.int64())])
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            fits, rows = integer_rows(batch.column("vector"), width)
            codes, error = np.zeros((len(rows), PARTS), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(PARTS if len(rows) else 0):
                codes[:, p], off = nearest_entries(rows[:, p * size : (p + 1) * size], books[p])
                error += off
            # Rows that do not fit get null.
            place = pa.array(np.where(fits, np.cumsum(fits) - 1, 0), mask=~fits)
            made = [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)]
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n != "vector"]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(m.take(place) for m in made)],
                names=[*(n for n in batch.schema.names if n != "vector"), *schema.names],
            )

    return run


def _usable(vector: str):
    """Neither null nor holding a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def first_books(kept: DataFrame) -> tuple[np.ndarray, int]:
    """Codebooks from the vectors with the smallest ids, equal ids by vector, and the vectors' width."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).toArrow()
    width = len(first["vector"][0]) if first.num_rows else 0
    if not width or width % PARTS:
        return np.zeros((PARTS, 0, 0), np.int64), 0
    bound = largest_component(width)
    inside = F.forall("vector", lambda x: F.abs(F.floor(x * F.lit(float(SCALE)))) <= bound)
    start = kept.where((F.size("vector") == width) & inside).orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES)
    _, rows = integer_rows(start.toArrow()["vector"].combine_chunks(), width)
    if not len(rows):
        return np.zeros((PARTS, 0, 0), np.int64), 0
    return np.stack(np.split(rows, PARTS, axis=1)), width


def codebooks(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[np.ndarray, int]:
    """The final codebooks (part, entry, component), and the width of the vectors they are for."""
    kept = _kept(rows, id_col, vector_col)
    books, width = first_books(kept)
    if width:
        for _ in range(ROUNDS):
            books = improved(kept.select("vector"), books, width)
    return books, width


def _kept(rows: DataFrame, id_col: str, vector_col: str, *more) -> DataFrame:
    bounded_batches(rows.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), *more).where(_usable("vector"))


def coded(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: ``id_col``, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold null or non-finite components are left out. Ids may be null
    (then last in the order of ids) or repeat. Vectors whose width is not that of the first one by
    id, or is not a multiple of ``PARTS``, and vectors with a component so large that a squared
    distance might not fit in a long (``largest_component``), train nothing and get null for code and
    error. ``label_error`` adds the errors of equal labels, of null labels together; null if none
    of them has an error. Fewer than ``ENTRIES`` vectors make so many entries. No rows give no rows.
    """
    books, width = codebooks(rows, id_col, vector_col)
    kept = _kept(rows, id_col, vector_col, F.col(label_col).alias("label"))
    kind = rows.schema[label_col].dataType.simpleString()
    codes = staged(kept.mapInArrow(_coded(books, width), f"id long, label {kind}, code string, error long"))
    named = codes.withColumn("unlabelled", F.col("label").isNull()).withColumn("name", F.coalesce(F.col("label").cast("string"), F.lit("")))
    sums = named.groupBy("unlabelled", "name").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    found = join_heaviest_first(named, sums, ["unlabelled", "name"], "n", [F.col("id"), F.col("code")])
    return found.select(
        F.col("id").alias(id_col), "code", "error", F.col("found.label_error").alias("label_error"),
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
