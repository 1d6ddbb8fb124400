"""Merkle fixity audit of WARC replicas.

A store is an index of records: archive, offset, length, page and the digest of what it holds
there. A tree stands over each archive: a leaf covers the records that begin in one range of
RANGE_BYTES, in order of their offsets, and hashes the offset, end, page, digest and copies of
each; an inner node hashes the numbers, offset ranges and hashes of FAN_OUT neighbouring nodes.
Replicas agree where their roots agree; an audit reads the children of differing nodes only, down
to the ranges that differ, so a lost, changed, moved or added record is located without reading
the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.llm.common import discard, staged

FAN_OUT = 16
RANGE_BYTES = 1 << 16
ARCHIVE_RECORDS = 1024
INDEX = ["page_id", "archive", "offset", "record_bytes", "record_sha256", "copies"]


def warc_record(url: Column, html: Column) -> Column:
    """A WARC response record: header lines and the html; null url or html counts as empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def warc_records(pages: DataFrame) -> DataFrame:
    """page_id, record_sha256, record_bytes, copies of the distinct records of pages.

    Repeated rows are one record with copies > 1. Null page_ids are kept.
    """
    record = warc_record(F.col("url"), F.col("html"))
    hashed = pages.select("page_id", F.sha2(record, 256).alias("record_sha256"), F.octet_length(record).cast("long").alias("record_bytes"))
    return hashed.groupBy("page_id", "record_sha256", "record_bytes").agg(F.count("*").alias("copies"))


def number_of(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def laid_out(records: DataFrame, archives: int) -> DataFrame:
    """records with archive and offset: dealt to archives by their digest, so that a page with many
    records fills none, and written one after another in order of page_id (null first) and digest."""
    r = records.withColumn("archive", F.pmod(number_of(F.col("record_sha256")), F.lit(archives)))
    order = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_first(), "record_sha256")
    end = F.sum("record_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return r.withColumn("offset", end - F.col("record_bytes"))


def store_of(pages: DataFrame, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """The index of a sound store of pages, staged."""
    records = staged(warc_records(pages), "records")
    out = staged(laid_out(records, max(1, records.count() // archive_records)).select(*INDEX), "store")
    discard(records)
    return out


def children_hash(children: DataFrame, node: Column, order: str, shown: list[str]) -> DataFrame:
    """(archive, node, first, last, hash) over children in order; a node's children are few, by design."""
    listed = F.array_sort(F.collect_list(F.struct(order, F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in shown)).alias("shown"))))
    joined = F.array_join(F.transform(listed, lambda x: x["shown"]), ",")
    rows = children.select("archive", node.alias("node"), order, *(c for c in shown if c != order), *(c for c in ("first", "last") if c not in (order, *shown)))
    return rows.groupBy("archive", "node").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sha2(joined, 256).alias("hash"))


def levels_of(stores: list[DataFrame], range_bytes: int = RANGE_BYTES) -> int:
    """Levels above the leaves that bring the largest archive of all stores to one root."""
    top = max((s.agg(F.max("offset")).first()[0] or 0 for s in stores), default=0) // range_bytes
    levels = 0
    while top:
        top, levels = top // FAN_OUT, levels + 1
    return levels


def tree(store: DataFrame, levels: int, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """Staged levels of (archive, node, first, last, hash), the leaf ranges first, the roots last."""
    records = store.withColumn("first", F.col("offset")).withColumn("last", F.col("offset") + F.col("record_bytes"))
    out = [staged(children_hash(records, F.floor(F.col("offset") / range_bytes), "offset", ["offset", "last", "page_id", "record_sha256", "copies"]), "level-0")]
    for k in range(levels):
        below = out[-1].withColumnRenamed("node", "child")
        out.append(staged(children_hash(below, F.floor(F.col("child") / FAN_OUT), "child", ["child", "first", "last", "hash"]), f"level-{k + 1}"))
    return out


def differing(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """(archive, node) of the leaf ranges in which two trees differ, staged; found from the roots down."""
    found = None
    for x, y in zip(reversed(a), reversed(b), strict=True):
        if found is not None:
            inside = found.select(F.col("archive").alias("o_archive"), F.col("node").alias("o_node"))
            x, y = (t.join(inside, (t["archive"] == inside["o_archive"]) & (F.floor(t["node"] / FAN_OUT) == inside["o_node"]), "left_semi") for t in (x, y))
        x, y = (t.select("archive", "node", F.struct("first", "last", "hash").alias(side)) for t, side in ((x, "ours"), (y, "theirs")))
        below = staged(x.join(y, ["archive", "node"], "full").where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("archive", "node"), "differing")
        if found is not None:
            discard(found)
        found = below
    return found


def audit(store: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of store, and per record that only the replica holds.

    store and replica have the columns INDEX; others are ignored. Columns: page_id, archive,
    offset, record_bytes, record_sha256, copies, replica_sha256, status: `ok`; `copies` (another
    number of copies); `corrupt` (the replica holds something else of that page at that offset);
    `moved` (it holds the record elsewhere); `missing`; or `extra`. A record both moved and changed
    is missing and extra. Of several records at one offset of the replica the one with the least
    page and digest is compared, the rest are extra unless moved. Null page_ids are one page. Empty tables give no rows.
    """
    ours, theirs = (s.select(*INDEX) for s in (store, replica))
    levels = levels_of([ours, theirs], range_bytes)
    a, b = tree(ours, levels, range_bytes), tree(theirs, levels, range_bytes)
    bad = differing(a, b)
    for level in (*a, *b):
        discard(level)
    within = lambda s: s.withColumn("node", F.floor(F.col("offset") / range_bytes))
    whole = within(ours).join(bad, ["archive", "node"], "left_anti").select(*INDEX, F.col("record_sha256").alias("replica_sha256"), F.lit("ok").alias("status"))
    x = staged(within(ours).join(bad, ["archive", "node"], "left_semi").select(*INDEX), "ours")
    y = within(theirs).join(bad, ["archive", "node"], "left_semi").select(*(F.col(c).alias(f"y_{c}") for c in INDEX))
    # Numbered by place: only the first record of an offset can be the one that belongs there.
    place = Window.partitionBy("y_archive", "y_offset").orderBy(F.col("y_page_id").asc_nulls_first(), "y_record_sha256")
    y = staged(y.withColumn("m", F.row_number().over(place)), "theirs")
    page = x["page_id"].eqNullSafe(y["y_page_id"])
    here = (x["archive"] == y["y_archive"]) & (x["offset"] == y["y_offset"]) & (y["m"] == 1) & page
    same = F.col("record_sha256") == F.col("y_record_sha256")
    status = F.when(same & (F.col("copies") == F.col("y_copies")), "ok").when(same, "copies").otherwise("corrupt")
    at_place = x.join(y, here).select(*INDEX, F.col("y_record_sha256").alias("replica_sha256"), status.alias("status"))
    rest_x, rest_y = x.join(y, here, "left_anti"), y.join(x, here, "left_anti")
    by_record = Window.partitionBy("y_page_id", "y_record_sha256").orderBy("y_archive", "y_offset", "m")
    rest_y = rest_y.withColumn("k", F.row_number().over(by_record))
    pair = rest_x.join(rest_y, rest_x["page_id"].eqNullSafe(rest_y["y_page_id"]) & (rest_x["record_sha256"] == rest_y["y_record_sha256"]) & (rest_y["k"] == 1), "full")
    there, held = F.col("k").isNotNull(), F.col("copies").isNotNull()
    shown = [F.when(held, F.col(c)).otherwise(F.col(f"y_{c}")).alias(c) for c in INDEX if c != "record_sha256"]
    apart = pair.select(*shown, F.col("record_sha256"), F.col("y_record_sha256").alias("replica_sha256"), F.when(held & there, "moved").when(held, "missing").otherwise("extra").alias("status"))
    columns = [*INDEX, "replica_sha256", "status"]
    return reduce(DataFrame.unionByName, (d.select(*columns) for d in (whole, at_place, apart)))


def damaged_store(pages: DataFrame, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """A stand-in for a second store, staged: laid out as store_of does, with storage errors by the
    digest of a page's URL: about 1 record of 211 is lost, of 97 has another first byte of html,
    of 131 is indexed 512 bytes too far."""
    html = F.coalesce("html", F.lit(""))
    seal = number_of(F.md5(F.coalesce("url", F.lit(""))))
    sound, held = warc_record(F.col("url"), F.col("html")), warc_record(F.col("url"), F.concat(F.lit("!"), F.substring(html, 2, 1 << 30)))
    rows = pages.select("page_id", F.sha2(sound, 256).alias("record_sha256"), F.octet_length(sound).cast("long").alias("record_bytes"), seal.alias("seal"), F.when(seal % 97 == 0, F.sha2(held, 256)).alias("changed"))
    rows = staged(rows.groupBy("page_id", "record_sha256", "record_bytes").agg(F.count("*").alias("copies"), F.min("seal").alias("seal"), F.min("changed").alias("changed")), "records")
    laid = laid_out(rows, max(1, rows.count() // archive_records)).where(F.col("seal") % 211 != 0)
    moved = F.when((F.col("seal") % 131 == 0) & F.col("changed").isNull(), 512).otherwise(0)
    out = laid.select("page_id", "archive", (F.col("offset") + moved).alias("offset"), "record_bytes", F.coalesce("changed", "record_sha256").alias("record_sha256"), "copies")
    kept = staged(out, "damaged")
    discard(rows)
    return kept
