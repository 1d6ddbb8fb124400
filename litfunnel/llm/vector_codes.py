"""Product quantisation of vectors: four codebooks learned by an RDD tree reduction over columnar blocks.

1. Vectors are written as columnar NumPy blocks: for each of the PARTS parts, one array of
   (dimension, vector). Blocks are a table in the shared folder, so each pass reads them again
   wherever an executor was lost.
2. In each round, tasks add up the distances of a block to all entries dimension by dimension, take
   the nearest entry, and np.add.at puts sums and counts by entry into int64 tensors; treeAggregate
   merges the tensors in levels. What reaches the driver has the size of the codebooks.
3. A last pass writes the codes.

Components are integers floor(GRID * x), so that codes don't depend on the order of additions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import BROADCAST_ROWS, discard, hidden, staged

PARTS, ENTRIES, ROUNDS, GRID = 4, 256, 4, 1024
#: Vectors of one block: its distances to all entries are 2 MB at most.
BLOCK = 1024
#: Integers beyond this are kept as Python's own, which know no overflow: sums of 5e11 smaller ones fit in 64 bits.
WIDE = 1 << 24
#: Partial sums that the last level of the reduction tree sends to the driver.
LAST_LEVEL = 8
#: Pieces of a label that holds most of the rows, where the sums by label are too many to be broadcast.
SALTS = 32


def kept_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """key, label, vector of the rows whose vector is there and has finite components only."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False))
    v = F.col(vector)
    return vectors.where(v.isNotNull() & F.coalesce(F.forall(v, finite), F.lit(False))).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), v.alias("vector"))


def first_vectors(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest vec_ids, in their order, null last; of an id that repeats, its least vector.

    entries vectors at most reach the driver: they are the first codebooks.
    """
    ids = kept.groupBy("vec_id").count().orderBy(F.asc_nulls_last("vec_id")).limit(entries).select(F.col("vec_id").alias("first_id"))
    rows = kept.join(F.broadcast(ids), F.col("vec_id").eqNullSafe(F.col("first_id"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return [r["vector"] for r in rows.orderBy(F.asc_nulls_last("vec_id")).collect()]


def integers(x: np.ndarray) -> np.ndarray:
    """floor(GRID * x), as int64, or as Python's integers where one of them is beyond WIDE."""
    if not x.size or np.abs(x).max() < WIDE / GRID:
        return np.floor(x.astype(np.float64) * GRID).astype(np.int64)
    return np.array([math.floor(Fraction(float(v)) * GRID) for v in x.ravel()], object).reshape(x.shape)


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower of equal ones) and its squared distance for each column of part.

    part: (dimension, vector), book: (entry, dimension). Distances accumulate dimension by dimension,
    in the narrowest integers that can't overflow.
    """
    reach = int(max(np.abs(part).max(initial=0), 1)) + int(max(np.abs(book).max(initial=0), 1))
    most = len(part) * reach * reach
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
    part, book = part.astype(kind), book.astype(kind)
    total = np.zeros((len(book), part.shape[1]), kind)
    for x, c in zip(part, book.T, strict=True):
        apart = x[None, :] - c[:, None]
        apart *= apart
        total += apart
    code = total.argmin(axis=0)
    return code, total[code, np.arange(part.shape[1])]


def blocks_of(kept: DataFrame, dims: int, parts: int, block: int) -> DataFrame:
    """ids, labels and one columnar array a part (little-endian 64-bit floats) of up to block vectors of dims components."""
    fields = kept.schema

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                table = np.asarray(some.column("vector").flatten().to_numpy(zero_copy_only=False), "<f8").reshape(some.num_rows, dims)
                columns = [np.ascontiguousarray(x.T).tobytes() for x in np.split(table, parts, axis=1)]
                lists = [pa.array([some.column(c).to_pylist()], pa.list_(some.schema.field(c).type)) for c in ("vec_id", "label")]
                yield pa.record_batch([*lists, pa.array([columns], pa.list_(pa.binary()))], names=["ids", "labels", "parts"])

    ids, labels = (fields[c].dataType.simpleString() for c in ("vec_id", "label"))
    return kept.where(F.size("vector") == dims).mapInArrow(build, f"ids array<{ids}>, labels array<{labels}>, parts array<binary>")


def part_arrays(parts: Sequence[bytes], dims: int) -> list[np.ndarray]:
    width = dims // len(parts)
    return [integers(np.frombuffer(x, "<f8").reshape(width, -1)) if width else np.zeros((0, 0), np.int64) for x in parts]


def learned(blocks: DataFrame, books: list[np.ndarray], dims: int, rounds: int) -> list[np.ndarray]:
    """The codebooks after so many rounds of assigning every part and moving each used entry to its parts' floored mean."""
    context = blocks.sparkSession.sparkContext
    rdd = blocks.select("parts").rdd.map(lambda row: row[0])
    depth = max(2, math.ceil(math.log(max(2, rdd.getNumPartitions()), LAST_LEVEL)))
    for _ in range(rounds):
        sent = context.broadcast(books)

        def add(total: list | None, parts: Sequence[bytes]) -> list:
            total = total or [(np.zeros(b.shape, np.int64), np.zeros(len(b), np.int64)) for b in sent.value]  # noqa: B023
            for p, (part, book) in enumerate(zip(part_arrays(parts, dims), sent.value, strict=True)):  # noqa: B023
                sums, counts = total[p]
                code, _ = nearest(part, book)
                if part.dtype == object and sums.dtype != object:
                    sums = sums.astype(object)
                np.add.at(sums, code, part.T)
                np.add.at(counts, code, 1)
                total[p] = (sums, counts)
            return total

        def merge(a: list | None, b: list | None) -> list | None:
            if a is None or b is None:
                return b if a is None else a
            return [(x + y, m + n) for (x, m), (y, n) in zip(a, b, strict=True)]

        total = rdd.treeAggregate(None, add, merge, depth)
        sent.unpersist()
        if total is None:
            break
        books = [np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], book) for book, (s, n) in zip(books, total, strict=True)]
    return books


def book_digest(books: Sequence[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text by part, entry and position, apart by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def coded(blocks: DataFrame, books: Sequence[np.ndarray], dims: int) -> DataFrame:
    """vec_id, label, code, error of every vector of the blocks; an error beyond 64 bits is null."""
    types = [blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
                found = [nearest(p, b) for p, b in zip(part_arrays(batch.column("parts")[i].as_py(), dims), books, strict=True)] if dims else [(np.zeros(len(ids), int),) * 2] * len(books)
                code = ["".join(f"{x:02x}" for x in xs) for xs in zip(*(c.tolist() for c, _ in found), strict=True)]
                error = [e if (e := sum(xs)) < 1 << 63 else None for xs in zip(*(e.tolist() for _, e in found), strict=True)]
                yield pa.record_batch([ids, labels, pa.array(code), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(assign, f"vec_id {types[0]}, label {types[1]}, code string, error long")


def with_label_error(codes: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """codes with label_error, the sum of error over the rows of equal label, nulls together.

    Sums are made before any row moves. Up to most labels are broadcast; more are joined with every
    label in SALTS copies, so that one that holds most of the rows is spread over as many tasks.
    """
    name = hidden()
    sums = codes.groupBy(F.col("label").alias(name)).agg(F.sum("error").alias("label_error"))
    if sums.limit(most + 1).count() <= most:
        return codes.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col(name)), "left").drop(name)
    salt, part = hidden(), hidden()
    spread = sums.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = codes.withColumn(part, F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int"))
    return salted.join(spread.hint("merge"), F.col("label").eqNullSafe(F.col(name)) & (F.col(part) == F.col(salt)), "left").drop(name, salt, part)


def codebooks_of(first: Sequence[Sequence[float]], parts: int) -> tuple[int, list[np.ndarray]]:
    """Components of the vector of the smallest vec_id, and the first codebooks; none where they can't be cut into equal parts."""
    dims = len(first[0]) if first else 0
    if not first or dims % parts:
        return dims, []
    same = [v for v in first if len(v) == dims]
    rows = np.array(same, np.float64).reshape(len(same), dims)
    return dims, [integers(x) for x in np.split(rows, parts, axis=1)]


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256: one row per row of vectors that is kept.

    Rows whose vector is null or holds a null, a NaN or an infinity fall out. Repeated rows are rows;
    of a repeated vec_id, the least vector may become a first entry. A null vec_id comes after all
    others, a null label is a label. The vector of the smallest vec_id tells the number of components:
    vectors of another length, and all if it isn't a multiple of parts, have a null code and error;
    vectors without components have error 0. Fewer than entries vec_ids make smaller codebooks. An
    empty table gives no rows. Other columns are ignored. At most 256 entries (two hex digits).
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    kept = kept_vectors(vectors, key, vector, label)
    dims, books = codebooks_of(first_vectors(kept, entries), parts)
    fits = F.size("vector") == dims if books else F.lit(False)
    odd = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if books:
        blocks = staged(blocks_of(kept, dims, parts, block), "vector-blocks")
        books = learned(blocks, books, dims, rounds) if dims else books
        codes = staged(coded(blocks, books, dims).unionByName(odd), "vector-codes")
        discard(blocks)
    else:
        codes = odd
    digest: Column = F.lit(book_digest(books) if books else None).cast("string")
    return with_label_error(codes).withColumn("codebooks_sha256", digest)
