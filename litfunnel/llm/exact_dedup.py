"""Exact deduplication by a tree merge of sorted digest runs.

1. Each input partition turns its documents into sorted runs, one per range of the digest
   space: distinct digests with the least doc_id and the number of copies.
2. In binomial rounds, run k of a range meets runs k ^ 1 .. of its block of FAN_IN; each
   round is one multiway merge per (range, block), which keeps the least identifier of each
   digest. Equal digests are verified by the length of the normalised text.
3. When one run per range is left, its digests are joined back to the rows.

A digest shared by a third of all rows costs one entry per run, so no task holds its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import SPACE_CLASS, discard, hidden, staged, without_rows

FAN_IN = 16
#: Digests of one range when all of its runs have met; a range is what one task holds at most.
RANGE_DIGESTS = 250_000
NO_ID = np.iinfo(np.int64).max
ENTRY = np.dtype([("digest", "S64"), ("chars", "<i8"), ("least", "<i8"), ("copies", "<i8")])
RUN_SCHEMA = "range int, run long, entries binary"


class DigestClash(ValueError):
    """Texts of different lengths share a SHA-256 digest."""


def merged(entries: np.ndarray) -> np.ndarray:
    """One sorted run of sorted runs laid end to end: least id and copies of each digest."""
    entries = entries[np.argsort(entries["digest"], kind="stable")]  # merges runs that are sorted
    if not len(entries):
        return entries
    start = np.flatnonzero(np.r_[True, entries["digest"][1:] != entries["digest"][:-1]])
    out = entries[start].copy()
    if (np.minimum.reduceat(entries["chars"], start) != np.maximum.reduceat(entries["chars"], start)).any():
        raise DigestClash("equal digests of texts of different lengths")
    out["least"] = np.minimum.reduceat(entries["least"], start)
    out["copies"] = np.add.reduceat(entries["copies"], start)
    return out


def normal_text() -> Column:
    return F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_CLASS + "+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, chars of the text with each run of white space as one blank; null counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_text().alias("t")).select("doc_id", F.sha2("t", 256).alias("text_sha256"), F.length("t").cast("long").alias("chars"))


def first_runs(digested: DataFrame, ranges: int) -> DataFrame:
    """The sorted runs of each partition."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = []
        for batch in batches:
            e = np.empty(batch.num_rows, ENTRY)
            e["digest"] = batch.column("text_sha256").to_numpy(zero_copy_only=False).astype("S64")
            e["chars"] = batch.column("chars").to_numpy(zero_copy_only=False)
            e["least"] = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            e["copies"] = 1
            parts.append(merged(e))
        if not parts:
            return
        run = merged(np.concatenate(parts))
        top = np.array([int(x[:8], 16) for x in run["digest"]], np.int64)
        edges = np.searchsorted(top, np.arange(ranges + 1) * (1 << 32) // ranges)
        for r in range(ranges):
            if edges[r] < edges[r + 1]:
                yield pa.record_batch([pa.array([r], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([run[edges[r] : edges[r + 1]].tobytes()], pa.binary())], names=["range", "run", "entries"])

    return digested.mapInArrow(runs, RUN_SCHEMA)


def merge_round(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One round: each block of fan_in neighbouring runs of a range becomes one run."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        run = merged(np.concatenate([np.frombuffer(x, ENTRY) for x in pdf["entries"]]))
        return pd.DataFrame({"range": [pdf["range"].iloc[0]], "run": [pdf["run"].iloc[0]], "entries": [run.tobytes()]})

    return runs.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy("range", "run").applyInPandas(merge, RUN_SCHEMA)


def keepers(digested: DataFrame, fan_in: int = FAN_IN, range_digests: int = RANGE_DIGESTS) -> DataFrame:
    """text_sha256, keep_id, group_size of each digest, by rounds until one run per range is left."""
    n, parts = digested.select(F.spark_partition_id().alias("p")).agg(F.count("*"), F.max("p")).first()
    runs = first_runs(digested, max(1, math.ceil(n / range_digests)))
    left = (parts or 0) + 1
    while left > 1:
        runs, left = merge_round(runs, fan_in), math.ceil(left / fan_in)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("entries").to_pylist():
                e = np.frombuffer(x, ENTRY)
                for i in range(0, len(e), 20_000):
                    p = e[i : i + 20_000]
                    yield pa.record_batch([pa.array(p["digest"].astype("U64")), pa.array(p["least"], mask=p["least"] == NO_ID), pa.array(p["copies"])], names=["text_sha256", "keep_id", "group_size"])

    return runs.mapInArrow(rows, "text_sha256 string, keep_id long, group_size long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    docs needs doc_id and text; other columns are ignored. Texts are equal when identical
    after each run of blanks, tabs and line ends becomes one blank; null text counts as
    empty. Of equal texts the row with the least doc_id stays; a null doc_id stays only
    where no copy has an id. Rows that repeat the least doc_id with an equal text count in
    group_size, and exactly one of them is kept. An empty table gives no rows.
    """
    digested = staged(digests(docs), "digests")
    # Copies that repeat a doc_id are told apart by number; they are summed before any join.
    rows = digested.groupBy("text_sha256", "doc_id").count()
    joined = rows.join(keepers(digested), "text_sha256")
    numbered = joined.select("doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    return numbered.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all their columns; one row of each group.

    Copies are decided on identifiers and digests alone. Texts aren't shuffled: the rows to drop
    are taken out where docs lie, unless they are too many to be broadcast.
    """
    digested = staged(digests(docs), "digests")
    many = keepers(digested).where("group_size > 1")
    rows = digested.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n"))
    judged = staged(rows.join(many, "text_sha256").select("doc_id", "text_sha256", "n", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("stays")), "judged")
    discard(digested)
    # Rows that repeat the identifier and the text of the one that stays go too, but for one.
    repeated = staged(judged.where("stays AND n > 1").select("doc_id", "text_sha256"), "repeated")
    lost = staged(judged.where("NOT stays").select("doc_id", "text_sha256").unionByName(repeated), "lost")
    discard(judged)
    sha = hidden()
    keyed = docs.withColumn(sha, F.sha2(normal_text(), 256))
    keys = {"doc_id": F.col("doc_id").cast("long"), "text_sha256": F.col(sha)}
    kept = without_rows(keyed, keys, lost).select(*docs.columns)
    if repeated.isEmpty():
        return kept
    id_name, sha_name = hidden(), hidden()
    again = repeated.select(F.col("doc_id").alias(id_name), F.col("text_sha256").alias(sha_name))
    one = keyed.join(again, F.col("doc_id").cast("long").eqNullSafe(F.col(id_name)) & (F.col(sha) == F.col(sha_name))).dropDuplicates([id_name, sha_name])
    return kept.unionByName(one.select(*docs.columns))
