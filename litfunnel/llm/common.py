"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
TOKENIZER_FILE = "word_bpe_49k.json"
#: [\x20\x09-\x0D], the white space of the contracts, as a Java or Python class.
SPACE_CLASS = r"[\x20\x09-\x0D]"


#: Rows of two or three numbers that may be broadcast: some 100 MB at most.
BROADCAST_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session, where driver and executors are one process, gets a folder of its
    own if it names none; on a cluster a machine-local folder would be read by nobody.
    """
    found = spark.conf.get(CHECKPOINT_KEY, None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="litfunnel-checkpoint-")
        spark.conf.set(CHECKPOINT_KEY, found)
    return found


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back, so that later steps
    depend on a table that outlives any executor and nothing is computed twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def hidden() -> str:
    """A column name that no table has."""
    return f"_{uuid.uuid4().hex}"


def without_rows(docs: DataFrame, keys: Mapping[str, Column], lost: DataFrame) -> DataFrame:
    """docs without the rows whose keys (null equal to null) are in lost, a staged table of these columns.

    Up to BROADCAST_ROWS rows of lost are broadcast, so that docs stay where they are; more
    are joined by their keys.
    """
    names = {k: hidden() for k in keys}
    right = lost.select(*(F.col(k).alias(names[k]) for k in keys))
    same = reduce(lambda a, b: a & b, (column.eqNullSafe(F.col(names[k])) for k, column in keys.items()))
    few = lost.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(right) if few else right.hint("merge"), same, "left_anti")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is staged inside, where rows are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows of an Arrow batch of texts; Spark's own 10,000 can be 100 MB for each task, in the JVM and in Python.
TEXT_ROWS = 2000


def short_batches(df: DataFrame) -> DataFrame:
    """df, whose session from now on sends at most TEXT_ROWS rows to Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= TEXT_ROWS:
        df.sparkSession.conf.set(key, TEXT_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Path of a public tokenizer file, looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def texts_of(column: pa.Array) -> list[str]:
    """A string column as Python strings, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text of each piece stays near max_bytes, whatever the row lengths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
    # Spark reuses its Python workers: what this task no longer needs goes back.
    pa.default_memory_pool().release_unused()
