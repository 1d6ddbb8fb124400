"""Ingest of harvested records: filter, shape, merge, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.functions import text
from litfunnel.operators import core
from litfunnel.sources import records

#: How a harvested item meets a stored one.
ITEM_POLICIES = {"title": "new", "summary": "new", "published_at": "old", "updated_at": "new", "authors_raw": "list", "categories_raw": "list", "source_seen_at": "overwrite"}


def oai_page(pages: DataFrame, column: str = "xml") -> DataFrame:
    """(records array of XML, token, error) of whole OAI-PMH responses. noRecordsMatch is an empty
    page; any other error code is shown in error for the caller to raise."""
    body = F.regexp_replace(F.col(column), r"(</?)[A-Za-z_]+:", "$1")
    error = F.nullif(F.regexp_extract(body, r"<error[^>]*\bcode=\"([^\"]+)\"", 1), F.lit(""))
    return pages.select(
        "*",
        F.regexp_extract_all(body, F.lit(r"(?s)(<record\b.*?</record>)")).alias("records"),
        F.nullif(F.trim(F.regexp_extract(body, r"(?s)<resumptionToken[^>]*>([^<]*)</resumptionToken>", 1)), F.lit("")).alias("token"),
        F.when(error != "noRecordsMatch", error).alias("error"),
    )


def page_records(pages: DataFrame, column: str = "xml") -> DataFrame:
    """Parsed records of whole responses."""
    return records.oai_records(oai_page(pages, column).select(F.explode("records").alias("xml")))


def category_matches(categories: Column, allowed: Sequence[str] = config.INGESTED_CATEGORIES) -> Column:
    """Some category is allowed, or lies in an archive that is allowed as a whole. Null matches nothing."""
    archives = [a for a in allowed if "." not in a]
    return F.coalesce(F.exists(categories, lambda c: c.isin(*allowed) | F.substring_index(c, ".", 1).isin(*archives)), F.lit(False))


def categories_of(raw: Column) -> Column:
    """Categories stored as a JSON list, or as one plain word; null for null."""
    return F.when(F.startswith(F.trim(raw), F.lit("[")), F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))).otherwise(F.when(raw.isNotNull(), F.array(raw)))


def gaps_filled(stored: DataFrame, fresh: DataFrame, key: str, columns: Sequence[str], metadata: str) -> DataFrame:
    """stored with empty columns filled from fresh, never overwriting what is there, and metadata merged; fresh keys are added."""
    filled = core.merged(stored, fresh, key, dict.fromkeys(columns, "fill"))
    both = stored.select(key, F.col(metadata).alias("_old")).join(fresh.select(key, F.col(metadata).alias("_new")), key, "full")
    return filled.join(both.select(key, text.merged_json(F.col("_old"), F.col("_new")).alias(metadata)), key)


def items_of(parsed: DataFrame, seen_at: Column) -> DataFrame:
    """Items by canonical URL; records of one URL give one item, of the latest datestamp, then identifier."""
    items = parsed.select(
        "identifier", "datestamp", F.lit("arxiv").alias("source_type"), text.normal_url(F.concat(F.lit("https://arxiv.org/abs/"), "arxiv_id")).alias("canonical_url"),
        F.coalesce(F.nullif("title", F.lit("")), F.lit("(untitled)")).alias("title"), F.col("abstract").alias("summary"),
        text.utc_time(F.col("created")).alias("published_at"), text.utc_time(F.col("updated")).alias("updated_at"),
        F.col("authors").alias("authors_raw"), F.col("categories").alias("categories_raw"), seen_at.alias("source_seen_at"),
    )
    return core.latest_per_key(items, ["canonical_url"], "datestamp", "identifier")


def ingested_window(parsed: DataFrame, stored: DataFrame, window_year: int, seen_at: Column) -> tuple[DataFrame, DataFrame]:
    """(items after the merge, one row of counters) of one harvest window.

    parsed: identifier, datestamp, deleted, arxiv_id, title, abstract, categories, authors,
    created, updated. stored: canonical_url and the columns of ITEM_POLICIES. Deleted records and
    those without identifier are counted and left out; records outside the categories only count
    as seen. A record repeated in the window is a duplicate after its first.
    """
    gone = F.coalesce(F.col("deleted"), F.lit(False)) | F.col("arxiv_id").isNull()
    marked = parsed.withColumn("gone", gone).withColumn("kept", ~gone & category_matches(F.col("categories")))
    kept = marked.where("kept")
    items = items_of(kept, seen_at)
    old_year = F.coalesce(F.year(text.utc_time(F.col("created"))) < window_year, F.lit(False))
    counts = marked.agg(F.count("*").alias("seen"), F.count_if("gone").alias("deleted"), F.count_if("kept").alias("kept"), F.count_if(F.col("kept") & old_year).alias("revision"))
    fresh = items.join(stored.select("canonical_url"), "canonical_url", "left_anti").agg(F.count("*").alias("new"))
    both = counts.join(F.broadcast(fresh)).select("*", (F.col("kept") - F.col("new")).alias("dupe"))
    return core.merged(stored, items, "canonical_url", ITEM_POLICIES), both


def distinct_bitmaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """(by, bucket, bitmap): the distinct numbers of each group as bitmaps of 32,768 of them, built before the
    shuffle. Numbers are not negative; null ones are left out. Kept bitmaps of new windows are merged with
    old ones without reading the rows again."""
    n = df.where(F.col(number).isNotNull())
    return n.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n): exact distinct numbers of each group of by, any part of the columns that the bitmaps were built
    for, or none: a number that several of the merged groups hold counts once."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("n"))


def arxiv_number(arxiv_id: Column) -> Column:
    """An identifier of the form YYMM.NNNNN as a number of its own; null for any other."""
    parts = [F.regexp_extract(arxiv_id, r"^(\d{4})\.(\d{4,5})$", i).try_cast("long") for i in (1, 2)]
    # Four and five digits of one number are two identifiers.
    wide = F.when(F.length(arxiv_id) == 10, 1).otherwise(0)
    return (parts[0] * 2 + wide) * 100_000 + parts[1]


def projected_harvest(parsed: DataFrame, set_spec: str, windows: int, window_year: int) -> DataFrame:
    """What a harvest of so many windows would bring, from parsed records of the first one in every set: rows of
    each set and one of all (null set) with seen, deleted, kept, revision, unique (identifiers of arxiv_number
    across the sets), and for all projected_unique, projected_revision and projected_new.
    Identifiers of another form count as unique by their sets."""
    gone = F.coalesce(F.col("deleted"), F.lit(False)) | F.nullif("arxiv_id", F.lit("")).isNull()
    kept = ~gone & category_matches(F.col("categories"))
    old = kept & F.coalesce(F.year(text.utc_time(F.col("created"))) < window_year, F.lit(False))
    m = parsed.select(F.col(set_spec).alias("set_spec"), gone.alias("gone"), kept.alias("kept"), old.alias("old"), F.when(kept, F.col("arxiv_id")).alias("id"), F.when(kept, arxiv_number(F.col("arxiv_id"))).alias("number"))
    counters = [F.count("*").alias("seen"), F.count_if("gone").alias("deleted"), F.count_if("kept").alias("kept"), F.count_if("old").alias("revision")]
    sums = m.groupBy("set_spec").agg(*counters)
    bits = distinct_bitmaps(m, ["set_spec"], "number")
    other = m.where("id IS NOT NULL AND number IS NULL").groupBy("set_spec").agg(F.countDistinct("id").alias("other"))
    each = distinct_counts(bits, ["set_spec"]).join(other, "set_spec", "full").select("set_spec", (F.coalesce("n", F.lit(0)) + F.coalesce("other", F.lit(0))).alias("unique"))
    sets = sums.join(each, "set_spec", "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
    total = sets.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("seen", "deleted", "kept", "revision")))
    across = distinct_counts(bits, []).join(F.broadcast(other.agg(F.coalesce(F.sum("other"), F.lit(0)).alias("other"))))
    total = total.join(F.broadcast(across.select((F.col("n") + F.col("other")).alias("unique"))))
    unique = F.col("unique") * windows
    revisions = F.coalesce(F.round(unique * F.try_divide(F.col("revision"), F.col("kept"))), F.lit(0)).cast("long")
    total = total.select(F.lit(None).cast("string").alias("set_spec"), "*", unique.alias("projected_unique"), revisions.alias("projected_revision"), (unique - revisions).alias("projected_new"))
    return sets.unionByName(total, allowMissingColumns=True)
