"""Sources and sinks of the funnel."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OAI_RECORD = (
    "header struct<_status: string, identifier: string, datestamp: string>, "
    "metadata struct<arXiv: struct<id: string, created: string, updated: string, title: string, abstract: string, categories: string, doi: string, `journal-ref`: string, "
    "authors: struct<author: array<struct<keyname: string, forenames: string, affiliation: array<string>>>>>>"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oai_records(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Parsed OAI-PMH records; a deleted header or a record without metadata is deleted.
    Authors without a name are left out and take no position."""
    r = xml.select(F.from_xml(F.col(column), OAI_RECORD).alias("r"))
    m = F.col("r.metadata.arXiv")
    clean = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    name = lambda a: F.trim(F.concat_ws(" ", a["forenames"], a["keyname"]))
    named = F.filter(F.coalesce(m["authors"]["author"], F.array()), lambda a: name(a) != "")
    return r.select(
        F.col("r.header.identifier").alias("identifier"),
        F.col("r.header.datestamp").alias("datestamp"),
        (F.coalesce(F.col("r.header._status") == "deleted", F.lit(False)) | m.isNull()).alias("deleted"),
        m["id"].alias("arxiv_id"),
        m["created"].alias("created"),
        F.coalesce(F.nullif(clean(m["title"]), F.lit("")), F.lit("(untitled)")).alias("title"),
        clean(m["abstract"]).alias("abstract"),
        F.split(F.trim(m["categories"]), r"\s+").alias("categories"),
        m["doi"].alias("doi"),
        F.transform(named, lambda a: name(a)).alias("authors"),
        F.transform(named, lambda a, i: F.struct((i + 1).alias("position"), name(a).alias("name"), F.coalesce(a["affiliation"], F.array().cast("array<string>")).alias("affiliations"))).alias("authors_structured"),
    )


def read_policy(spark: SparkSession, path: str, schema: str, defaults: dict) -> DataFrame:
    """A policy or watch-list file (JSON) with this schema; fields it lacks take their defaults. A file
    that can't be read or parsed gives the defaults alone."""
    fallback = spark.createDataFrame([tuple(defaults.get(f.split()[0]) for f in schema.split(", "))], schema)
    try:
        rows = spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")
        if rows.isEmpty():
            return fallback
    except AnalysisException:
        return fallback
    return rows.select(*(F.coalesce(F.col(c), F.lit(defaults[c]).cast(kind)).alias(c) if c in defaults and not isinstance(defaults[c], list) else F.col(c) for c, kind in rows.dtypes))


def archive_manifest(df: DataFrame, path: str) -> DataFrame:
    """(path, records, sha256) of an archive: the digest covers its records in order, whatever their partitioning."""
    line = F.to_json(F.struct(*sorted(df.columns)))
    parts = df.select(F.sha2(line, 256).alias("h")).groupBy(F.substring("h", 1, 3).alias("part")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    whole = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda x: x["h"]), ""), 256)
    return parts.agg(F.lit(path).alias("path"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"), whole.alias("sha256"))


def write_rejects(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "gzip").json(path)


def write_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header; array columns as JSON."""
    kinds = dict(df.dtypes)
    df.select(*(F.to_json(c).alias(c) if kinds[c].startswith(("array", "struct", "map")) else c for c in columns)).write.mode("overwrite").csv(path, header=True, escape='"')


def write_raw(df: DataFrame, path: str, provider: str, at: str) -> None:
    """Raw responses with their digest, partitioned by provider and day."""
    df.withColumn("sha256", F.sha2("payload", 256)).withColumn("day", F.to_date(at)).write.mode("append").partitionBy(provider, "day").option("compression", "gzip").json(path)


def markdown(df: DataFrame, at_most: int = 200) -> str:
    """A table of the first rows as Markdown; only at_most rows reach the driver."""
    rows = df.limit(at_most).collect()
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(x) for x in r) + " |" for r in rows])
