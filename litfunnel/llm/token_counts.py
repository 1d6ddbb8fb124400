"""Token counts per document of flat, unindexed token files.

A token file is a stream of little-endian unsigned 16-bit ids in which a separator id ends
each document. It is held as blocks: rows (file_id, block_no, data) whose bytes follow each
other; a document may begin in one block and end many blocks later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.llm.common import TOKENIZER_FILE, slices, texts_of, tokenizer_path
from litfunnel.llm.tokens import encoder_of

SEPARATOR = 49407
BLOCK_TOKENS = 1 << 15
#: Blocks whose sums are scanned together; the sums of such segments are scanned next.
SEGMENT_BLOCKS = 4096


def write_token_files(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, tokenizer_file: str = TOKENIZER_FILE, separator: int = SEPARATOR) -> DataFrame:
    """A flat token file per input partition: rows (file_id, block_no, data, doc_ids).

    doc_ids lists the documents whose separator lies in the block, in order: the manifest
    by which a caller names documents; the scan itself doesn't read it. Null text counts as
    empty and gives a separator alone. Ids of special tokens inside texts can't occur: their
    strings are encoded as ordinary text.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer_path(tokenizer_file), as_plain_text=True)
        file_id, block_no = TaskContext.get().partitionId(), 0
        held, size, ended = [], 0, []  # ended: (position after the separator, doc_id)

        def block(data: np.ndarray, doc_ids: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([file_id], pa.int64()), pa.array([block_no], pa.int64()), pa.array([data.tobytes()], pa.binary()), pa.array([doc_ids], pa.list_(pa.int64()))], names=["file_id", "block_no", "data", "doc_ids"])

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(texts_of(batch.column("text"))), strict=True):
                ids = np.append(ids, np.uint32(separator)).astype("<u2")
                held.append(ids)
                size += len(ids)
                ended.append((size, doc_id))
                if size >= block_tokens:
                    stream, at = np.concatenate(held), 0
                    while size - at >= block_tokens:
                        at += block_tokens
                        here = [d for p, d in ended if at - block_tokens < p <= at]
                        yield block(stream[at - block_tokens : at], here)
                        block_no += 1
                    held, size, ended = [stream[at:]], size - at, [(p - at, d) for p, d in ended if p > at]
        if size:
            yield block(np.concatenate(held), [d for _, d in ended])

    return docs.select("doc_id", "text").mapInArrow(written, "file_id long, block_no long, data binary, doc_ids array<long>")


def scan_separators(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """One row per block: file_id, block_no, n_tokens, ends (array<int>, positions of separators)."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.frombuffer(x or b"", "<u2") for x in batch.column("data").to_pylist()]
            ends = [np.flatnonzero(x == separator).astype(np.int32) for x in data]
            yield pa.record_batch([batch.column("file_id"), batch.column("block_no"), pa.array([len(x) for x in data], pa.int64()), pa.array(ends, pa.list_(pa.int32()))], names=["file_id", "block_no", "n_tokens", "ends"])

    return blocks.select("file_id", "block_no", "data").mapInArrow(scanned, "file_id long, block_no long, n_tokens long, ends array<int>")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, segment_blocks: int = SEGMENT_BLOCKS) -> DataFrame:
    """One row per document: file_id, doc_no (from 0 in its file), n_tokens (without the separator), closed.

    Two-level exclusive prefix scan over blocks: inside segments of consecutive blocks, then
    over segment totals, so no task ever holds more than a segment of a huge file. Tokens
    after a file's last separator form a last document with closed = false. A file without
    tokens, or an empty table, gives no rows; null data counts as an empty block. A document may
    span any number of blocks. Blocks of one file must not repeat a block_no.
    """
    segment = F.floor(F.col("block_no") / segment_blocks)
    b = scan_separators(blocks, separator).withColumn("segment", segment)
    inside = Window.partitionBy("file_id", "segment").orderBy("block_no")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    last_end = F.when(F.size("ends") > 0, F.coalesce(F.sum("n_tokens").over(before), F.lit(0)) + F.element_at("ends", F.lit(-1)))
    b = b.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("tokens_before"), F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ends_before"), last_end.alias("last_end"))
    b = b.withColumn("prior_end", F.max("last_end").over(before))
    s = b.groupBy("file_id", "segment").agg(F.sum("n_tokens").alias("n"), F.sum(F.size("ends")).alias("n_ends"), F.max("last_end").alias("s_last"))
    over = Window.partitionBy("file_id").orderBy("segment")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("file_id", "segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("s_tokens"), F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("s_ends"), "s_last", (F.lead("segment").over(over).isNull()).alias("s_final"), "n")
    s = s.withColumn("s_prior", F.max(F.col("s_last") + F.col("s_tokens")).over(earlier))
    last_block = F.lead("block_no").over(inside).isNull()
    j = b.withColumn("b_final", last_block).join(s.drop("s_last"), ["file_id", "segment"])
    # Positions are counted from the start of the file; -1 stands for "before its first token".
    base = F.col("s_tokens") + F.col("tokens_before")
    prior = F.coalesce(F.col("s_tokens") + F.col("prior_end"), F.col("s_prior"), F.lit(-1))
    ends = F.transform("ends", lambda e: e + base)
    final = F.col("b_final") & F.col("s_final")
    total = F.col("s_tokens") + F.col("n")
    j = j.select("file_id", (F.col("s_ends") + F.col("ends_before")).alias("first_no"), F.when(final, F.concat(ends, F.array(total))).otherwise(ends).alias("ends"), prior.alias("prior"), F.when(final, F.size("ends")).otherwise(F.lit(-1)).alias("tail"))
    j = j.select("file_id", "first_no", "tail", F.transform("ends", lambda e, i: e - F.when(i == 0, F.col("prior")).otherwise(F.get("ends", i - 1)) - 1).alias("lengths"))
    d = j.select("file_id", "first_no", "tail", F.posexplode("lengths").alias("i", "n_tokens"))
    d = d.where((F.col("i") != F.col("tail")) | (F.col("n_tokens") > 0))
    return d.select("file_id", (F.col("first_no") + F.col("i")).alias("doc_no"), F.col("n_tokens").cast("long").alias("n_tokens"), (F.col("i") != F.col("tail")).alias("closed"))


def manifest(files: DataFrame) -> DataFrame:
    """(file_id, doc_no, doc_id) of files made by write_token_files."""
    w = Window.partitionBy("file_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    m = files.select("file_id", "block_no", "doc_ids").withColumn("first_no", F.coalesce(F.sum(F.size("doc_ids")).over(w), F.lit(0)))
    m = m.select("file_id", "first_no", F.posexplode("doc_ids").alias("i", "doc_id"))
    return m.select("file_id", (F.col("first_no") + F.col("i")).alias("doc_no"), "doc_id")
