"""Stored responses and daily feeds as files: the newest response of a request, feeds with missing or broken days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of stored responses: time, request, entity.
RESPONSE_NAME = r"^(\d{8}T\d{6}Z)_([0-9a-f]{16})_(.*)\.json\.gz$"
MISSING, BROKEN = "missing", "not valid JSON"


def response_name(at: Column, request: Column, entity: Column) -> Column:
    """File name of a response; at is a time in UTC, request its key, entity at most 60 characters of what it is about."""
    safe = F.substring(F.regexp_replace(entity, r"[^\p{L}\p{N}._-]", "_"), 1, 60)
    return F.concat(F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit("_"), request, F.lit("_"), safe, F.lit(".json.gz"))


def newest_responses(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """(request, entity, file, payload, error) of the newest file of each request under folder, at any depth.

    Newest by the path, which begins with day and time. wanted (column request) keeps these
    requests only. A file that is no JSON has its error instead of a payload and isn't passed over for
    an older one; files of other names aren't read as responses. The names decide before any payload is
    shuffled: one row a file goes to the aggregation, then the chosen files are joined back.
    """
    read = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").load(folder)
    name = F.col("_metadata.file_name")
    files = read.select(F.col("_metadata.file_path").alias("file"), F.regexp_extract(name, RESPONSE_NAME, 2).alias("request"), F.regexp_extract(name, RESPONSE_NAME, 3).alias("entity"), F.col("value").alias("payload")).where("request <> ''")
    if wanted is not None:
        files = files.join(wanted.select("request").distinct(), "request", "left_semi")
    newest = files.groupBy("request").agg(F.max("file").alias("file"))
    valid = F.try_parse_json("payload").isNotNull()
    chosen = files.join(newest.select("file"), "file")
    return chosen.select("request", "entity", "file", F.when(valid, F.col("payload")).alias("payload"), F.when(~valid, F.lit(BROKEN)).alias("error"))


def feed_lines(spark: SparkSession, folder: str, days: Column) -> DataFrame:
    """(day, body, error) of a feed stored as day=YYYY-MM-DD folders of lines, each a JSON list of entries.

    days is an array of dates. A day without a line gives one row with MISSING, a line that is no JSON list
    one with BROKEN; the other days and lines are as they are. Days outside aren't read.
    """
    spine = spark.range(1).select(F.explode(days).alias("day"))
    lines = spark.read.schema("value string, day date").option("basePath", folder).text(folder).where("value <> ''")
    found = spine.join(lines, "day", "left")
    valid = F.schema_of_variant(F.try_parse_json("value")).startswith("ARRAY")
    error = F.when(F.col("value").isNull(), MISSING).when(~F.coalesce(valid, F.lit(False)), BROKEN)
    return found.select("day", F.when(error.isNull(), F.col("value")).alias("body"), error.alias("error"))
