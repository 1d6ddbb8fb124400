"""Harvests of paged record lists from stored pages, as a batch and a streaming source.

A folder holds one file for each page, named after the request it answers: the first page of a set
and window, or the page behind a token. The source has one partition for each set and window, whose
task follows the tokens, one page in memory at a time, and gives pages as rows; Spark parses
them (ingest.page_records).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "stored_pages"
PAGES = "set_spec string, window_from date, window_until date, page int, xml string, failure string"
#: The error code that means an empty list.
NO_RECORDS = "noRecordsMatch"
_ERROR = re.compile(r"<(?:\w+:)?error\b[^>]*\bcode=\"([^\"]+)\"[^>]*>([^<]*)")
_TOKEN = re.compile(r"<(?:\w+:)?resumptionToken\b[^>]*>([^<]*)</")
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


class HarvestError(RuntimeError):
    """A page answers with an error, is missing or leads back to an earlier one."""


def first_page(set_spec: Column, first: Column, last: Column) -> Column:
    """File name of the first page of a window; dates as YYYY-MM-DD."""
    return F.concat(F.sha2(F.concat_ws("\n", F.lit("list"), set_spec, first, last), 256), F.lit(".xml"))


def next_page(token: Column) -> Column:
    """File name of the page behind a token."""
    return F.concat(F.sha2(F.concat_ws("\n", F.lit("token"), token), 256), F.lit(".xml"))


def _name(*request: str) -> str:
    return hashlib.sha256("\n".join(request).encode()).hexdigest() + ".xml"


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def store_pages(pages: DataFrame, folder: str) -> None:
    """Write pages (name, xml) as files of folder, from the tasks. A page that is written again is replaced."""

    def write(rows) -> Iterator[tuple[int]]:
        files, root = _opened(folder)
        files.create_dir(root, recursive=True)
        n = 0
        for batch in rows:
            for name, xml in zip(batch.column("name").to_pylist(), batch.column("xml").to_pylist(), strict=True):
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write((xml or "").encode())
                n += 1
        import pyarrow as pa

        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    pages.select("name", "xml").mapInArrow(write, "n long").agg(F.sum("n")).collect()


@dataclass
class Window(InputPartition):
    set_spec: str
    first: date
    last: date


def windows_of(sets: list[str], first: date, last: date, days: int) -> list[Window]:
    """Windows of days from first to last, both included, oldest first; the last one may be shorter."""
    starts = [first + timedelta(days=i) for i in range(0, (last - first).days + 1, days)]
    return [Window(s, a, min(a + timedelta(days=days - 1), last)) for a in starts for s in sets]


class _Pages:
    def __init__(self, options: dict[str, str]):
        self.folder, self.keep = options["path"], options.get("failures", "raise") == "keep"
        sets = [s for s in options["sets"].split(",") if s]
        self.windows = windows_of(sets, date.fromisoformat(options["from"]), date.fromisoformat(options["until"]), int(options.get("days", 7)))

    def chain(self, w: Window) -> Iterator[str]:
        """The pages of a window in their order."""
        files, root = _opened(self.folder)
        request, seen = _name("list", w.set_spec, w.first.isoformat(), w.last.isoformat()), set()
        while request:
            if request in seen:
                raise HarvestError("a token leads back to an earlier page")
            seen.add(request)
            try:
                with files.open_input_stream(f"{root}/{request}") as stream:
                    xml = stream.read().decode()
            except FileNotFoundError:
                raise HarvestError(f"page {len(seen)} is missing") from None
            error = _ERROR.search(xml)
            if error and error[1] != NO_RECORDS:
                raise HarvestError(f"error code={error[1]} message={error[2].strip()}")
            if error:
                return
            yield xml
            token = _TOKEN.search(xml)
            text = re.sub("|".join(_ENTITIES), lambda m: _ENTITIES[m[0]], token[1]).strip() if token else ""
            request = _name("token", text) if text else None

    def rows(self, w: Window) -> Iterator[tuple]:
        own = (w.set_spec, w.first, w.last)
        if self.keep:
            # A window is given whole or not at all, so its pages are tried before the first is given.
            try:
                for _ in self.chain(w):
                    pass
            except HarvestError as e:
                yield (*own, None, None, str(e))
                return
        for i, xml in enumerate(self.chain(w), 1):
            yield (*own, i, xml, None)


class _Batch(_Pages, DataSourceReader):
    def partitions(self) -> list[Window]:
        return self.windows

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.rows(partition)


class _Stream(_Pages, DataSourceStreamReader):
    """An offset is a number of windows, in their fixed order; a window is there once its first page is."""

    def initialOffset(self) -> dict:
        return {"windows": 0}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        files, root = _opened(self.folder)
        found = files.get_file_info([f"{root}/{_name('list', w.set_spec, w.first.isoformat(), w.last.isoformat())}" for w in self.windows])
        missing = [i for i, f in enumerate(found) if f.type != fs.FileType.File]
        return {"windows": missing[0] if missing else len(found)}

    def partitions(self, start: dict, end: dict) -> list[Window]:
        return self.windows[start["windows"] : end["windows"]]

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class StoredPages(DataSource):
    """spark.read or readStream .format(FORMAT), after register().

    Options: path (a folder that all tasks reach), sets (separated by commas), from and until
    (YYYY-MM-DD, included), days of a window (7), failures. NO_RECORDS is an empty window; with
    failures=raise (the default) any other error, a missing page or a circle of tokens fails the
    job; with keep such a window gives one row with the failure and no page, and leaves the others
    as they are. A stream reads windows in their order as far as their first pages are there and
    goes on from its checkpoint; from, days and sets must stay the same between its runs, and until
    must too unless it ends a whole window.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StoredPages)


def pages_of(records: DataFrame, set_spec: str, window: tuple[str, str], order: str, record: str, size: int) -> DataFrame:
    """(name, xml) of the pages that hold records, size to a page in order, chained by tokens.

    window names the two date columns of a record's window. Rows are numbered inside (set, window); only
    size of them ever meet in one group.
    """
    from pyspark.sql import Window as W

    group = [set_spec, *window]
    at = F.row_number().over(W.partitionBy(*group).orderBy(order)) - 1
    one = records.select(*group, F.col(order).alias("o"), F.col(record).alias("r"), F.floor(at / size).alias("page"), F.count("*").over(W.partitionBy(*group)).alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "r"))), lambda x: x["r"]), "")
    p = one.groupBy(*group, "page").agg(text.alias("body"), F.max("n").alias("n"))
    ends = [F.col(c).cast("string") for c in window]
    token = lambda page: F.concat_ws("|", set_spec, *ends, page.cast("string"))
    safe = F.replace(F.replace(token(F.col("page") + 1), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    more = F.when((F.col("page") + 1) * size < F.col("n"), F.concat(F.lit("<resumptionToken>"), safe, F.lit("</resumptionToken>"))).otherwise("")
    name = F.when(F.col("page") == 0, first_page(F.col(set_spec), *ends)).otherwise(next_page(token(F.col("page"))))
    return p.select(name.alias("name"), F.concat(F.lit("<OAI-PMH><ListRecords>"), "body", more, F.lit("</ListRecords></OAI-PMH>")).alias("xml"))
