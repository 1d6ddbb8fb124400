"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import discard, staged

ROUNDS = 100


def connected_components(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the least node.

    edges: u, v of one orderable type; direction, repeats and loops don't matter, rows with a
    null fall out. Each round is a keyed minimum and an equi-join, written to the shared
    folder; nothing but two numbers a round reaches the driver. The number of rounds grows with
    the logarithm of the edges; one that doesn't settle in so many raises an error. The result is staged.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = least(both)
        return both.where("v > u").join(m, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        m = least(down)
        j = down.join(m, F.col("u") == F.col("c"))
        return j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select(F.col("c").alias("u"), F.col("m").alias("v"))).where("u != v").distinct()

    def seal(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = staged(edges.select("u", "v").where("u != v").distinct(), "edges")
    before = seal(e)
    for _ in range(rounds):
        if not before[0]:
            break
        newer = staged(small_star(large_star(e)), "stars")
        discard(e)
        e, now = newer, seal(newer)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    out = staged(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    discard(e)
    return out
