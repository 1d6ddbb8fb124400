"""Mixing sources to target weights by fitting subset sums to word budgets.

1. Documents are counted by source and exact length; a table of lengths, not of documents, decides.
2. Budgets: the sources share a number of words by weight; those that would take more than a
   multiple of what they have stop there, and the excess is shared again among the others.
3. Fitting, source by source over its counts by length: whole copies of all documents first; of what
   remains, each length gives its proportional part, and a bounded knapsack by dynamic programming
   over the last WINDOW words finds how many further documents of which lengths come nearest to it.
   A source of S words has at most sqrt(2 S) lengths, so its counts fit in one task.
4. Selection: of each length, the documents with the smallest seeded hashes, found by ranges of the
   hash, whose counts tell which ranges are in, out or cut. Equal documents are counted, not ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.llm.common import BROADCAST_ROWS, discard, hidden, staged
from litfunnel.operators.core import numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), Fraction(3, 2), 2
#: Words that the dynamic programme fills exactly; four of the shortest documents left, if that is more.
WINDOW = 1 << 16
#: No window is longer; where every document left is longer than a quarter of it, fewer than four fill it.
LONGEST_WINDOW = 1 << 22
#: Different documents of one source and length that are ranked in one task.
RANGE_ROWS = 20_000
#: Rows that one row may become at once; a document that repeats more often is spread over tasks first.
COPIES = 100_000


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def counted(docs: DataFrame, seed: int) -> DataFrame:
    """source, doc_id, size, mark, n: how often each document of one text stands in docs; mark is its seeded hash."""
    mark = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")
    return docs.select("source", "doc_id", words_of(F.col("text")).alias("size"), mark.alias("mark")).groupBy("source", "doc_id", "size", "mark").agg(F.count("*").alias("n"))


def targets(sources: DataFrame, weights: Sequence[int], share: Fraction, most_copies: int) -> DataFrame:
    """source, source_size, target of sources (source, source_size): the budget share * all sizes, by weights that
    repeat along the sources in code-point order (null last), none above most_copies times its size.

    Each round takes out the sources that reach their stop at the present level of words per weight.
    Comparisons are exact, in whole numbers; two sums a round reach the driver.
    """
    turn = numbered(sources, [F.asc_nulls_last("source")], "turn")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("turn") - 1).cast("int") % len(weights) + 1)
    weighed = staged(turn.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    stop = F.col("source_size").cast("decimal(38,0)") * most_copies
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = None, F.lit(False)
    while True:
        ended, weight_left = weighed.agg(F.sum(F.when(stopped, stop)), F.sum(F.when(~stopped, F.col("weight")))).first()
        now = max(Fraction(0), share * total - int(ended or 0)) / int(weight_left) if weight_left else Fraction(0)
        if now == level:
            break
        level = now
        # weight * level > stop, with level = numerator / denominator.
        stopped = F.col("weight").cast("decimal(38,0)") * F.lit(str(level.numerator)).cast("decimal(38,0)") > stop * F.lit(level.denominator)
    exact = F.when(stopped, stop.cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return weighed.select("source", "source_size", exact.alias("target"))


def fitted(lengths: np.ndarray, left: np.ndarray, wanted: float, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length bring the sum of lengths nearest to wanted; the lower of two equally near.

    lengths ascending and positive, left: how many there are of each. Proportional parts and then the
    longest that still fit bring what is wanted under the window; there every sum that can be had is
    found, and the nearest is traced back.
    """
    taken = np.zeros(len(lengths), np.int64)
    whole = float((lengths * left.astype(np.float64)).sum())
    if not len(lengths) or wanted <= 0:
        return taken
    taken = np.minimum(left, np.floor(left * min(1.0, wanted / whole) * (1 - 1e-12)).astype(np.int64))
    remain = wanted - float((lengths * taken.astype(np.float64)).sum())
    spare = left - taken
    if not spare.any():
        return taken
    shortest = int(lengths[np.flatnonzero(spare)[0]])
    window = min(LONGEST_WINDOW, max(window, 4 * shortest))
    for i in np.flatnonzero(spare)[::-1]:
        if remain <= window:
            break
        more = min(int(spare[i]), int((remain - window // 2) // lengths[i]))
        if more > 0:
            taken[i] += more
            spare[i] -= more
            remain -= more * int(lengths[i])
    # Sums a little above what remains count too: the nearest may be there.
    top = int(min(max(remain, 0), 2 * LONGEST_WINDOW)) + shortest + 1
    by = np.full(top + 1, -1, np.int32)
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    goal = int(math.floor(remain))
    for i in np.flatnonzero(spare):
        n, step = min(int(spare[i]), top // int(lengths[i])), 1
        while n > 0 and not (goal <= top and goal == remain and reached[goal]):
            k = min(step, n)
            add = k * int(lengths[i])
            fresh = np.flatnonzero(reached[: top + 1 - add] & ~reached[add:]) + add
            by[fresh] = len(items)
            reached[fresh] = True
            items.append((int(i), k))
            n, step = n - k, step * 2
    sums = np.flatnonzero(reached)
    best = int(sums[np.argmin(np.abs(sums - remain))])
    while best:
        i, k = items[by[best]]
        taken[i] += k
        best -= k * int(lengths[i])
    return taken


def plan_of(lengths: DataFrame, budgets: DataFrame, most_copies: int, window: int) -> DataFrame:
    """source, size, n, source_size, target, copies of every document, extra: documents of the length that get one more."""
    same = hidden()
    joined = lengths.join(F.broadcast(budgets.withColumnRenamed("source", same)) if budgets.count() <= BROADCAST_ROWS else budgets.withColumnRenamed("source", same), F.col("source").eqNullSafe(F.col(same))).drop(same)
    schema = "source string, size long, n long, kinds long, source_size long, target double, copies long, extra long"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        copies = min(most_copies, int(target // size)) if size else 0
        extra = np.zeros(len(pdf), np.int64)
        real = (pdf["size"] > 0).to_numpy()
        if copies < most_copies:
            extra[real] = fitted(pdf["size"].to_numpy()[real], pdf["n"].to_numpy()[real], target - copies * size, window)
        return pdf.assign(copies=copies, extra=extra)[[c.split()[0] for c in schema.split(", ")]]

    return joined.groupBy("source").applyInPandas(fit, schema)


def judged(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most_copies: int = MOST_COPIES, seed: int = 0, window: int = WINDOW, range_rows: int = RANGE_ROWS) -> DataFrame:
    """source, doc_id, size, mark, n, source_size, target, copies, more: of n equal documents, more are
    taken copies + 1 times and the rest copies times. A staged table."""
    if not weights or min(weights) <= 0 or most_copies < share:
        raise ValueError("weights must be positive and most_copies no less than share")
    own = staged(counted(docs.select("doc_id", F.col("source").cast("string").alias("source"), "text"), seed), "counted")
    lengths = staged(own.groupBy("source", "size").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")), "lengths")
    sizes = staged(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sizes")
    plan = staged(plan_of(lengths, targets(sizes, weights, share, most_copies), most_copies, window), "plan")
    right = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("n").alias("of_length"), "kinds", "source_size", "target", "copies", "extra")
    few = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    at = F.shiftrightunsigned("mark", 1) / F.lit(float(1 << 63))
    # Nothing or all of a length needs no rank; its rows stay in one range, and where they lie.
    cut = F.col("extra").between(1, F.col("of_length") - 1)
    span = F.when(cut, F.floor(at * F.ceil(F.col("kinds") / range_rows))).otherwise(0)
    marked = own.join(F.broadcast(right) if few else right, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z").withColumn("span", span)
    ranked, settled = marked.where(cut), marked.where(~cut)
    spans = ranked.groupBy("source", "size", "span").agg(F.sum("n").alias("held"))
    before = spans.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("span").alias("p"), (F.sum("held").over(Window.partitionBy("source", "size").orderBy("span")) - F.col("held")).alias("before"))
    inside = Window.partitionBy("source", "size", "span").orderBy(F.shiftrightunsigned("mark", 1), "mark", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("span") == F.col("p")))
    columns = ["source", "doc_id", "size", "mark", "n", "source_size", "target", "copies"]
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before") - F.col("ahead")))
    all_or_none = F.when(F.col("extra") > 0, F.col("n")).otherwise(0)
    out = staged(placed.select(*columns, more.alias("more")).unionByName(settled.select(*columns, all_or_none.alias("more"))), "mix")
    for df in (own, lengths, sizes, plan):
        discard(df)
    return out


def mixed_sizes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most_copies: int = MOST_COPIES, seed: int = 0, window: int = WINDOW, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (copies * size).

    docs needs doc_id, source and text; other columns are ignored. A size is the number of runs of
    anything but blanks, tabs and line ends in the whole text; null text has none. A null source is a
    source, the last; a source without words has target 0, and a document without words takes nothing.
    Rows that repeat are rows: equal ones may get different copies. The same rows, in any order and
    partitions, give the same result for the same seed. An empty table gives no rows.
    """
    mix = judged(docs, weights, share, most_copies, seed, window, range_rows)
    kept = ["doc_id", "source", "size", "source_size", "target"]
    total = mix.agg(F.max("n")).first()[0] or 0
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))) if total > COPIES else F.lit(0)
    pieces = mix.withColumn("piece", piece)
    if total > COPIES:
        pieces = pieces.repartition("source", "doc_id", "mark", "piece")
    row = F.explode(F.sequence(F.col("piece") * COPIES, F.least(F.col("n"), (F.col("piece") + 1) * COPIES) - 1)).alias("row")
    rows = pieces.select(*kept, "copies", "more", row)
    copies = F.when(F.col("size") > 0, F.col("copies") + (F.col("row") < F.col("more")).cast("long")).otherwise(0)
    return rows.select(*kept, copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most_copies: int = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The mix itself: the rows of docs with all their columns, each as often as mixed_sizes takes it.

    Documents without words don't stand in it.
    """
    mix = judged(docs, weights, share, most_copies, seed).where("size > 0")
    key, own, source, copies, more, n, times = (hidden() for _ in range(7))
    right = mix.select(F.col("doc_id").alias(key), F.col("mark").alias(own), F.col("source").alias(source), F.col("copies").alias(copies), F.col("more").alias(more), F.col("n").alias(n))
    right = F.broadcast(right) if right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else right
    mark = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (mark == F.col(own)) & F.col("source").cast("string").eqNullSafe(F.col(source))
    joined = docs.join(right, same)
    each = F.col(copies) + F.when(F.col(n) == 1, F.col(more)).otherwise(0)
    rows = joined.where(each > 0).withColumn(times, F.explode(F.sequence(F.lit(1), each)))
    # Of equal documents, one row stands for those that are taken once more.
    extra = joined.where((F.col(n) > 1) & (F.col(more) > 0)).dropDuplicates([key, own, source])
    extra = extra.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(more))))
    return rows.select(*docs.columns).unionByName(extra.select(*docs.columns))
