"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.sources.staging import removed, written


def connected_components(links: DataFrame, left: str, right: str, rounds: int = 64) -> DataFrame:
    """(node, component) of every node that is linked to another; component is the least node of its class.

    left and right are of one orderable type; direction, repeats and loops don't matter, links with a
    null fall out. Each round hangs the greater neighbours of a node below its least neighbour, then
    all its lesser neighbours; a class becomes a star in a number of rounds that grows with the
    logarithm of its size. Minima are taken before rows are shuffled; a round is a table of its
    own in the shared folder, and only its row count and checksum reach the driver.
    """

    def hung(pairs: DataFrame, to: DataFrame) -> DataFrame:
        """Every pair (a, b) as (b, least of a's neighbours and a)."""
        least = to.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("a", "least").alias("least"))
        return pairs.join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")

    def turned(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))

    def one_round(pairs: DataFrame) -> DataFrame:
        both = pairs.unionByName(turned(pairs))
        outer = hung(both.where("b > a"), both).distinct()
        least = outer.groupBy("a").agg(F.min("b").alias("b"))
        return hung(outer, outer).unionByName(least).where("a <> b").distinct()

    def seal(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    now = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b AND a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    before = seal(now)
    for _ in range(rounds):
        if not before[0]:
            break
        newer = written(one_round(now), "links")
        removed(now)
        now, after = newer, seal(newer)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
