"""Golden labels and how predictions agree with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GOLDEN = "name string, version string, task_type string, items array<struct<content_item_id long, arxiv_id string, title string, label_json struct<audiences array<string>, domain string, subdomains array<string>, organisations array<string>>, gold_label_source string>>"


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """One row per label of golden files (JSON, one set each); a set without name, version, task or items is an error."""
    sets = spark.read.schema(GOLDEN).json(path, multiLine=True)
    sound = F.col("name").isNotNull() & F.col("version").isNotNull() & F.col("task_type").isNotNull() & (F.size("items") > 0)
    items = F.when(F.coalesce(sound, F.lit(False)), F.col("items")).otherwise(F.raise_error(F.lit("a golden set needs name, version, task_type and items")))
    return sets.select("name", "version", "task_type", F.explode(items).alias("i")).select("name", "version", "task_type", "i.*")


def golden_labels(items: DataFrame, papers: DataFrame) -> DataFrame:
    """Labels of papers that exist; audience_domain items give a domain label, and an audience label where audiences aren't null."""
    known = items.join(papers.select("content_item_id").distinct(), "content_item_id", "left_semi")
    known = known.withColumn("source", F.coalesce("gold_label_source", F.lit("manual")))
    both = F.col("task_type") == "audience_domain"
    rows = [known.where(~both), known.where(both).withColumn("task_type", F.lit("domain")), known.where(both & F.col("label_json.audiences").isNotNull()).withColumn("task_type", F.lit("audience"))]
    return reduce(DataFrame.unionByName, rows).select("name", "version", "content_item_id", "task_type", "label_json", "source")


def reloaded(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """stored with the sets (name, version) of fresh replaced as a whole."""
    return stored.join(fresh.select("name", "version").distinct(), ["name", "version"], "left_anti").unionByName(fresh)


def folded(values: Column) -> Column:
    """A set of words whatever their case and order."""
    return F.array_sort(F.array_distinct(F.transform(F.coalesce(values, F.array().cast("array<string>")), F.lower)))


def agreement(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """By set and source, and by set (source null): n, missing predictions, domains compared and
    equal with accuracy, audiences compared and equal.

    labels: name, source, content_item_id, task_type, domain, audiences; predictions: the latest
    per (content_item_id, task_type), with domain and audiences. A label without a domain isn't compared.
    """
    p = predictions.select("content_item_id", "task_type", F.col("domain").alias("p_domain"), F.col("audiences").alias("p_audiences"), F.lit(True).alias("there"))
    j = labels.join(p, ["content_item_id", "task_type"], "left")
    there = F.coalesce("there", F.lit(False))
    plain = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    domain = there & (F.col("task_type") == "domain") & (plain("domain") != "")
    audience = there & (F.col("task_type") == "audience")
    j = j.select("name", "source", there.alias("there"), domain.alias("d"), (domain & (plain("domain") == plain("p_domain"))).alias("d_same"), audience.alias("a"), (audience & (folded(F.col("audiences")) == folded(F.col("p_audiences")))).alias("a_same"))
    g = j.groupingSets([["name", "source"], ["name"]], "name", "source").agg(
        F.count("*").alias("n"), F.count_if(~F.col("there")).alias("missing"), F.count_if("d").alias("domain_compared"), F.count_if("d_same").alias("domain_match"), F.count_if("a").alias("audience_compared"), F.count_if("a_same").alias("audience_exact")
    )
    return g.withColumn("domain_accuracy", F.when(F.col("domain_compared") > 0, F.round(F.col("domain_match") / F.col("domain_compared"), 4)))


def predicted_organisations(affiliations: DataFrame, organisations: DataFrame, key: str) -> DataFrame:
    """(key, organisations): the lower-case names found for each paper; raw text stands where no organisation was resolved."""
    names = affiliations.join(organisations.select("org_id", "canonical_name"), "org_id", "left").select(key, F.lower(F.coalesce("canonical_name", "raw_affiliation")).alias("name")).where("name IS NOT NULL")
    return names.groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("organisations"))
