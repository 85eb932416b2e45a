"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

A uniform permutation of all rows sends a hypergeometric number of rows from each input
partition to each shard. So those numbers are drawn first, exactly: the shards' sizes are split
over the halves of the partition list, then over their halves, and so on, each split a chain
of hypergeometric draws. Each partition then permutes its rows, cuts them by its row of the
matrix, the rows are exchanged, and each shard permutes what it got. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import ranked, staged

# Rows of a shard that one task orders, about.
CELL_ROWS = 50_000

# Partitions below which the halving goes on in one task; beyond, halves are dealt out.
_LOCAL_LEVELS = 8

# Standard deviations from the mean that a draw may lie. Beyond lies less than 2^-53.
_WIDTH = 12


def _draw(population: str, marked: str, taken: str, uniform: str) -> str:
    """SQL for a hypergeometric draw: how many of ``taken`` rows are among the ``marked``.

    Inverts the distribution by its ratio of neighbours, summed up from far below the mean.
    """
    ratio = (
        f"((({marked}) - k) / (k + 1d) * ((({taken}) - k) / "
        f"cast(({population}) - ({marked}) - ({taken}) + k + 1 as double)))"
    )
    mean = f"(({taken}) * (({marked}) / cast(greatest({population}, 1) as double)))"
    spread = (
        f"({_WIDTH} * sqrt({mean} * greatest(0d, 1 - ({marked}) / cast(greatest({population}, 1) as double))) + {_WIDTH})"
    )
    low = f"cast(greatest(0, ({taken}) + ({marked}) - ({population}), floor({mean} - {spread})) as bigint)"
    high = f"cast(least({marked}, {taken}, ceil({mean} + {spread})) as bigint)"
    steps = f"if({high} > {low}, sequence({low}, {high} - 1), cast(array() as array<bigint>))"
    total = (
        f"aggregate({steps}, named_struct('w', 1d, 't', 1d), "
        f"(s, k) -> named_struct('w', s.w * {ratio}, 't', s.t + s.w * {ratio}), s -> s.t)"
    )
    return (
        f"aggregate({steps}, named_struct('w', 1d, 't', 1d, 'x', {low}, 'goal', {uniform} * {total}), "
        f"(s, k) -> if(s.t > s.goal, s, named_struct('w', s.w * {ratio}, 't', s.t + s.w * {ratio}, "
        f"'x', k + 1, 'goal', s.goal)), s -> s.x)"
    )


def _uniform(seed: int, *what: str) -> str:
    """SQL for a number in [0, 1) that depends on the seed and the columns only."""
    return f"(shiftrightunsigned(xxhash64({seed}L, {', '.join(what)}), 11) * {2.0**-53!r}d)"


def _half(seed: int) -> Column:
    """Rows that each shard takes from the left half: draws without return, shard by shard."""
    uniform = _uniform(seed, "level", "node", "j")
    return F.expr(
        f"""aggregate(sequence(0, size(sizes) - 1),
          named_struct('out', cast(array() as array<bigint>),
            'pool', aggregate(sizes, 0L, (a, b) -> a + b), 'left', taken),
          (g, j) -> transform(array({_draw("g.pool", "sizes[j]", "g.left", uniform)}),
            x -> named_struct('out', concat(g.out, array(x)), 'pool', g.pool - sizes[j], 'left', g.left - x))[0],
          g -> g.out)"""
    )


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, sizes): how many rows partition ``part`` sends to each shard.

    ``counts`` has one row per partition: part, n. Its list, a number per partition, is held
    by one row; the matrix itself is made and kept in pieces.
    """
    root = counts.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "n"))), lambda x: x["part"]).alias("parts"),
        F.transform(F.array_sort(F.collect_list(F.struct("part", "n"))), lambda x: x["n"]).alias("ns"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    share = F.expr(f"transform(sequence(0L, {shards - 1}L), j -> total div {shards} + if(j < total % {shards}, 1L, 0L))")
    nodes = root.select(F.lit(0).alias("level"), F.lit(0).cast("long").alias("node"), "parts", "ns", share.alias("sizes"))
    width = counts.count()
    level = 0
    while width > 1 << level:
        if level and level % _LOCAL_LEVELS == 0:
            nodes = staged(nodes.repartition("node"))
        middle = F.expr("cast(ceil(size(parts) / 2) as int)")
        split = nodes.withColumn("middle", middle).withColumn(
            "taken", F.expr("aggregate(slice(ns, 1, middle), 0L, (a, b) -> a + b)")
        )
        drawn = split.withColumn("drawn", _half(seed))
        halves = F.expr(
            """inline(array(
              named_struct('half', 0L, 'p', slice(parts, 1, middle), 'q', slice(ns, 1, middle), 's', drawn),
              named_struct('half', 1L, 'p', slice(parts, middle + 1, size(parts)),
                'q', slice(ns, middle + 1, size(ns)), 's', zip_with(sizes, drawn, (a, b) -> a - b))))"""
        )
        level += 1
        nodes = staged(
            drawn.select("node", halves).where("size(p) > 0").select(
                F.lit(level).alias("level"), (F.col("node") * 2 + F.col("half")).alias("node"),
                F.col("p").alias("parts"), F.col("q").alias("ns"), F.col("s").alias("sizes"),
            )
        )
    return nodes.where("size(parts) = 1").select(F.col("parts")[0].alias("part"), "sizes")


def shuffle_to_shards(rows: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """``rows`` with shard (int) and slot (long): a uniform shuffle, sizes at most one apart.

    Shards are numbered from 0 and slots in each shard from 0 without gaps. Equal rows, nulls
    in any column and empty tables need no special care: nothing but the place of a row decides.
    Columns of ``rows`` named shard or slot, are replaced; _cell, _row, _start and names in
    "_sh_" are left out.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot", "_cell", "_row", "_start") and c[:4] != "_sh_"]
    placed = rows.select(*names).withColumn("_sh_at", F.monotonically_increasing_id())
    local = placed.sortWithinPartitions(F.xxhash64(F.lit(seed), F.lit("local"), "_sh_at"))
    numbered = staged(
        local.withColumn("_sh_id", F.monotonically_increasing_id()).select(
            *names,
            F.shiftrightunsigned("_sh_id", 33).cast("int").alias("_sh_part"),
            F.col("_sh_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_sh_rank"),
        )
    )
    counts = staged(numbered.groupBy(F.col("_sh_part").alias("part")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    cuts = communication_matrix(counts, shards, seed).select(
        F.col("part").alias("_sh_part"),
        F.expr(
            "aggregate(sizes, array(0L), (a, n) -> concat(a, array(element_at(a, -1) + n)))"
        ).alias("_sh_cuts"),
    )
    # The first cut is 0; each cut at or below the rank moves the row on by one shard.
    shard = F.expr("size(filter(_sh_cuts, c -> c <= _sh_rank)) - 1").cast("int")
    sent = numbered.join(cuts, "_sh_part").withColumn("shard", shard).drop("_sh_cuts")
    again = F.xxhash64(F.lit(seed), F.lit("shard"), "_sh_part", "_sh_rank")
    cells = max(1, -(-total // (shards * CELL_ROWS)))
    spread = F.xxhash64(F.lit(seed), F.lit("cell"), "_sh_part", "_sh_rank")
    order = [again, F.col("_sh_part"), F.col("_sh_rank")]
    return ranked(sent, "shard", order, spread, cells, "slot").select(*names, "shard", "slot")
