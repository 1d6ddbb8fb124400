"""Structured Streaming forms of the projection (an extension)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from litfunnel.operators.core import latest_per_key
from litfunnel.sources.keyed_table import BUCKETS, KeyedTable


def tumbling_counts(events: DataFrame, at: str, key: str, width: str = "7 days", lateness: str = "14 days", start: str = "4 days") -> DataFrame:
    """Counts by window and key, late rows up to lateness. Windows are counted from 1970-01-01 plus
    start, a Thursday, so that weeks begin on Monday."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, width, startTime=start).alias("w"), key).agg(F.count("*").alias("n"))


def keep_projection(log: DataFrame, keys: Sequence[str], at: str, tie: str, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Maintain the latest row of each key in a KeyedTable under path. A micro-batch writes only the
    buckets in which it changes a row: late rows older than the stored one change nothing, and a
    batch that runs again after a failure is known by its number and left out."""
    spark = log.sparkSession
    columns = log.columns
    if not KeyedTable(spark, path).exists():
        KeyedTable.create(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in log.schema), keys, buckets)

    def merge(batch: DataFrame, number: int) -> None:
        newest = lambda old, new: latest_per_key(old.unionByName(new.select(*columns)), keys, at, tie)
        KeyedTable(batch.sparkSession, path).change(batch, newest, applied=(checkpoint, number))

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_projection(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return KeyedTable(spark, path).read(version)


def first_seen(log: DataFrame, keys: Sequence[str], at: str, lateness: str = "14 days") -> DataFrame:
    """The first row to arrive of each key, exactly once, whatever is sent again within lateness. State is
    kept by key and dropped behind the watermark. A key that returns later counts anew."""
    return log.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))
