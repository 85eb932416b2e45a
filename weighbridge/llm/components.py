"""Connected components by alternating stars, for graphs of any shape and size.

Large-star links each node's larger neighbours to its smallest one, small-star its smaller
ones. The rounds grow with the logarithm of the number of nodes. Each round is written to the
shared folder, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weighbridge.llm.common import discard, staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")
    ).first()
    return row["n"], row["sum"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b) that is not its component's smallest."""
    now = staged(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo")
        .distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(floor, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = staged(small.unionAll(floor.select("hi", F.col("m").alias("lo"))).distinct())
        before, state = state, _state(after)
        discard(now)
        now = after
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
