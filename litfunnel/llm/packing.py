"""Best-fit decreasing packing of token sequences.

Every input partition tokenises its documents once and packs them by best-fit decreasing:
overlong documents give full windows first, and each remaining piece, longest first, goes to
the open window with the tightest room, found by a segment tree over remaining capacities. No
row is shuffled; a lost executor costs the partitions it held. A task holds the ids of its own
partition, so partitions bound its memory. Padding is about one window in each partition: on
tables of many small partitions coalesce them first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import TOKENIZER_FILE, short_batches, slices, texts_of, tokenizer_path
from litfunnel.llm.tokens import encoder_of

END_ID = 1
WINDOW = 2048
SEQUENCES_PER_PARTITION = 1 << 32


class CapacityTree:
    """Counts of open windows by remaining capacity; finds the least capacity >= n with an open window."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        i = self.leaves + capacity
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, n: int) -> int:
        """-1 if no open window has room for n."""
        i = self.leaves + n
        if self.count[i]:
            return n
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; lengths lie in 1..window. Ties keep input order."""
    tree = CapacityTree(window)
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    number, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        room = tree.tightest(n)
        if room < 0:
            room, at, used = window, used, used + 1
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        number[i], offset[i] = at, window - room
        if room > n:
            open_at[room - n].append(at)
            tree.add(room - n, 1)
    return number, offset


def padded_length(used: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """What sequences of these lengths are padded to: the window, but a power of two stays as it is."""
    return np.where(used & (used - 1) == 0, used, window)


PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "padded_to")] + [("ids", pa.binary())])


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_file: str = TOKENIZER_FILE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, padded_to, ids.

    ids holds the piece's ids as little-endian unsigned 32-bit numbers; sequence_id is unique over
    the table and padded_to the length of its sequence with padding. docs needs doc_id and text;
    other columns are ignored. Null text counts as empty and gives the single end id. Null and
    repeated doc_ids are packed like any row. An empty table gives no rows.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer_path(tokenizer_file))
        doc_ids, starts, lengths, totals, pieces = [], [], [], [], []
        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(texts_of(batch.column("text"))), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                total = len(ids) // 4
                for start in range(0, total, window):
                    doc_ids.append(doc_id)
                    starts.append(start)
                    lengths.append(min(window, total - start))
                    totals.append(total)
                    pieces.append(ids[4 * start : 4 * (start + window)])
        length = np.array(lengths, np.int64)
        number, offset = best_fit_decreasing(length, window)
        padded = padded_length(np.bincount(number, length).astype(np.int64), window)[number] if len(number) else number
        first = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        for i in range(0, len(pieces), 2000):
            cut = slice(i, i + 2000)
            columns = [doc_ids[cut], starts[cut], length[cut], totals[cut], number[cut] + first, offset[cut], padded[cut]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(pieces[cut], pa.binary())], schema=PIECES)

    return short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(packed, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded_to long, ids binary")


def with_digests(pieces: DataFrame) -> DataFrame:
    """pieces with ids_crc32 in place of ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


def sequences(pieces: DataFrame, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (binary, little-endian unsigned 32-bit, padded to padded_to)."""
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    g = pieces.groupBy("sequence_id", "padded_to").agg(F.sum("length").alias("n_tokens"), listed.alias("pieces"))
    hexes = F.array_join(F.transform("pieces", lambda p: F.hex(p["ids"])), "")
    pad = F.repeat(F.lit(np.uint32(pad_id).astype("<u4").tobytes().hex()), (F.col("padded_to") - F.col("n_tokens")).cast("int"))
    return g.select("sequence_id", "n_tokens", F.unhex(F.concat(hexes, pad)).alias("ids"))
