"""Runs, attempts and requests: append-only events and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litfunnel.operators import core
from litfunnel.sources.keyed_table import BUCKETS, KeyedTable

ERRORS_SHOWN = 20


def attempts(events: DataFrame, run: str, item: str, at: str, tie: str) -> DataFrame:
    """events with the number of each item's attempt in its run, from 1."""
    return events.withColumn("attempt", F.row_number().over(Window.partitionBy(run, item).orderBy(at, tie)))


def run_state(events: DataFrame, run: str, at: str, tie: str) -> DataFrame:
    """The last event of each run, with the milliseconds since its first."""
    first = events.groupBy(run).agg(F.min(at).alias("started_at"))
    last = core.latest_per_key(events, [run], at, tie).join(first, run)
    return last.withColumn("duration_ms", millis(F.col(at)) - millis(F.col("started_at")))


def millis(at: Column) -> Column:
    return F.unix_millis(at.cast("timestamp"))


def rollup_status(n: Column, failed: Column) -> Column:
    return F.when(failed == 0, "succeeded").when(failed < n, "partial").otherwise("failed")


def run_totals(batches: DataFrame, run: str) -> DataFrame:
    """Totals of each run over its batches (calls, tokens_in, tokens_out, cost, ok, failed, error, batch), its
    status and its first ERRORS_SHOWN errors. Errors are cut per group by rank, not collected whole."""
    sums = batches.groupBy(run).agg(*(F.sum(c).alias(c) for c in ("calls", "tokens_in", "tokens_out")), F.round(F.sum("cost"), 6).alias("cost"), F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))
    rank = F.row_number().over(Window.partitionBy(run).orderBy("batch"))
    shown = batches.where("error IS NOT NULL").withColumn("_rank", rank).where(f"_rank <= {ERRORS_SHOWN}").groupBy(run).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "error"))), lambda x: x["error"]).alias("errors"))
    return sums.join(shown, run, "left").withColumn("errors", F.coalesce("errors", F.array().cast("array<string>"))).withColumn("status", rollup_status(F.col("ok") + F.col("failed"), F.col("failed")))


def histogram(df: DataFrame, *columns: str) -> DataFrame:
    """(name, value, n) of each column."""
    pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.name", "p.value").agg(F.count("*").alias("n"))


def projected_cost(papers: DataFrame, text: str, batch: int, prompt_chars: int, out_tokens: int, price_in: float, price_out: float) -> DataFrame:
    """What a model run would take: papers, calls of batch papers, tokens in at four characters each, tokens out, USD."""
    s = papers.agg(F.count("*").alias("papers"), F.coalesce(F.sum(F.floor(F.length(F.coalesce(text, F.lit(""))) / 4)), F.lit(0)).alias("body"))
    calls = F.ceil(F.col("papers") / batch)
    s = s.select("papers", calls.alias("calls"), (F.col("body") + calls * (prompt_chars // 4)).alias("tokens_in"), (F.col("papers") * out_tokens).alias("tokens_out"))
    return s.withColumn("cost", F.round(F.col("tokens_in") / 1e6 * price_in + F.col("tokens_out") / 1e6 * price_out, 6))


def request_key(request: Column) -> Column:
    """Name of a request: the first 16 hexadecimal digits of the digest of its JSON, fields in order of their names."""
    return F.substring(F.sha2(F.to_json(request), 256), 1, 16)


def file_name(value: Column) -> Column:
    """value as a safe part of a file name."""
    return F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "_")


def newest_responses(raw: DataFrame, request: str, at: str) -> DataFrame:
    """The newest stored response of each request."""
    return core.latest_per_key(raw, [request], at, "payload")


def checkpoints(events: DataFrame) -> DataFrame:
    """The last state of each harvest window (source, set_spec, window_from, window_until, status, at, id)."""
    return core.latest_per_key(events, ["source", "set_spec", "window_from", "window_until"], "at", "id")


def open_windows(windows: DataFrame, events: DataFrame, force: bool = False) -> DataFrame:
    """The windows to harvest: all with force, else those not COMPLETE."""
    if force:
        return windows
    key = ["source", "set_spec", "window_from", "window_until"]
    return windows.join(checkpoints(events).where("status = 'COMPLETE'").select(*key), key, "left_anti")


WINDOW = ["source", "set_spec", "window_from", "window_until"]
COUNTERS = ["seen", "kept", "new", "dupe"]
#: Characters of an error that a checkpoint keeps.
ERROR_CHARS = 2000


def checkpoint_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    """A new table of the state of each harvest window, for start_windows and finish_windows."""
    text = ", ".join(f"{c} string" for c in [*WINDOW, "status", "error", "started_at", "ended_at"])
    return KeyedTable.create(spark, path, text + "".join(f", {c} long" for c in COUNTERS), WINDOW, buckets)


def start_windows(table: KeyedTable, windows: DataFrame, at: Column) -> int:
    """Set the windows to RUNNING; what an earlier run has left (counters, end, error) is reset."""
    none = F.lit(None).cast("string")
    return table.replace(windows.select(*WINDOW, F.lit("RUNNING").alias("status"), none.alias("error"), at.alias("started_at"), none.alias("ended_at"), *(F.lit(0).alias(c) for c in COUNTERS)))


def finish_windows(table: KeyedTable, results: DataFrame, at: Column) -> int:
    """Write status, error (its first ERROR_CHARS characters) and counters of windows that were started; others are left out."""
    told = results.select(*WINDOW, "status", F.substring("error", 1, ERROR_CHARS).alias("error"), at.alias("ended_at"), *COUNTERS)
    return table.change(told, lambda old, new: old.select(*WINDOW, "started_at").join(new, WINDOW))


def unfinished(windows: DataFrame, table: KeyedTable, force: bool = False) -> DataFrame:
    """The windows to harvest: all with force, else those that the table doesn't know as COMPLETE."""
    return windows if force else windows.join(table.read().where("status = 'COMPLETE'").select(*WINDOW), WINDOW, "left_anti")
