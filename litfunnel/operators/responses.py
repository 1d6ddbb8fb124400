"""Validation of model responses against what was asked for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel import config

SCALARS = "content_item_id string, " + ", ".join(f"{d} string" for d in dict.fromkeys((*config.SCREEN_DIMENSIONS, *config.RUBRIC_DIMENSIONS))) + ", so_what string, reason_not_higher string, confidence string, domain string"
LISTS = "audience_relevance string, subdomains string, application_domain string"


def json_body(text: Column) -> Column:
    """From the first { to the last }; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def entries(responses: DataFrame) -> DataFrame:
    """(batch_id, expected, place, id, e): the papers of each response; e has all fields as text."""
    papers = F.from_json(json_body(F.col("text")), f"papers array<struct<{SCALARS}, {LISTS}>>")["papers"]
    rows = responses.select("batch_id", "expected", F.posexplode(papers).alias("place", "e"))
    return rows.withColumn("id", F.when(F.trim("e.content_item_id").rlike(r"^[+-]?\d+$"), F.trim("e.content_item_id").try_cast("bigint")))


def strict_score(value: Column) -> Column:
    """0 to 10 in half points, or null."""
    x = value.try_cast("double")
    return F.when((x >= 0) & (x <= 10) & (F.abs(x * 2 - F.rint(x * 2)) <= 1e-6), F.rint(x * 2) / 2)


def snapped_score(value: Column) -> Column:
    """The nearest half point of a number of 0 to 10, or null."""
    x = value.try_cast("double")
    return F.when((x >= 0) & (x <= 10), F.rint(x * 2) / 2)


def word_list(value: Column) -> Column:
    """Lower-case words of a JSON list, or of a single word; blank ones fall out."""
    listed = F.when(F.startswith(F.trim(value), F.lit("[")), F.from_json(value, "array<string>")).otherwise(F.array(value))
    return F.filter(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def judged(responses: DataFrame, found: DataFrame, values: Mapping[str, Column], problem: Column) -> tuple[DataFrame, DataFrame]:
    """(parsed, problems): the last sound entry of each expected paper, and (batch_id, content_item_id, problem)."""
    expected = F.array_contains("expected", F.col("id"))
    checked = found.withColumn("fault", F.when(F.col("id").isNull(), "unparseable content_item_id").when(~expected, "unexpected content_item_id").otherwise(problem))
    sound = F.coalesce(expected, F.lit(False)) & (F.col("fault").isNull() | F.startswith("fault", F.lit("note: ")))
    last = Window.partitionBy("batch_id", "id").orderBy(F.desc("place"))
    parsed = checked.where(sound).withColumn("last", F.row_number().over(last)).where("last = 1").select("batch_id", F.col("id").alias("content_item_id"), *(c.alias(n) for n, c in values.items()))
    asked = responses.select("batch_id", F.explode(F.array_distinct("expected")).alias("content_item_id"))
    missing = asked.join(parsed.select("batch_id", "content_item_id"), ["batch_id", "content_item_id"], "left_anti").withColumn("problem", F.lit("missing"))
    faults = checked.where("fault IS NOT NULL").select("batch_id", F.col("id").alias("content_item_id"), F.regexp_replace("fault", "^note: ", "").alias("problem"))
    return parsed, faults.unionByName(missing)


def first_bad(dimensions: Sequence[str], valid) -> Column:
    """'invalid <dimension>' of the first dimension that isn't valid."""
    return F.coalesce(*(F.when(valid(F.col(f"e.{d}")).isNull(), f"invalid {d}") for d in dimensions))


def screened(responses: DataFrame, gate: float = config.GATE) -> tuple[DataFrame, DataFrame]:
    """Screening: (batch_id, content_item_id, dimensions, passed), problems. A paper below the gate keeps its scores.

    responses: batch_id, text, expected (array of ids). A response without JSON gives only missing papers.
    """
    values = {d: strict_score(F.col(f"e.{d}")) for d in config.SCREEN_DIMENSIONS}
    parsed, problems = judged(responses, entries(responses), values, first_bad(config.SCREEN_DIMENSIONS, strict_score))
    return parsed.withColumn("passed", F.col("ai_relevance") >= gate), problems


def rated(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quality: rubric dimensions in half points, texts and confidence (0 to 1); a missing reason is only noted."""
    reason = F.trim(F.coalesce("e.reason_not_higher", F.lit("")))
    values = {d: snapped_score(F.col(f"e.{d}")) for d in config.RUBRIC_DIMENSIONS} | {"so_what": F.trim(F.coalesce("e.so_what", F.lit(""))), "reason_not_higher": reason, "confidence": snapped_score(F.col("e.confidence")) / 10}
    return judged(responses, entries(responses), values, F.coalesce(first_bad(config.RUBRIC_DIMENSIONS, snapped_score), F.when(reason == "", "note: missing reason_not_higher")))


def vocabulary(audiences: Column, domain: Column, subdomains: Column, applications: Column) -> tuple[dict[str, Column], Column]:
    """In-vocabulary values, and what lies outside as 'kind:value'. A subdomain must belong to the
    domain; general_method excludes other applications."""
    known = F.when(domain.isin(*config.SUBDOMAINS), domain)
    of_domain = F.create_map(*(x for d, subs in config.SUBDOMAINS.items() for x in (F.lit(d), F.array(*map(F.lit, subs)))))
    allowed = F.coalesce(F.try_element_at(of_domain, known), F.array().cast("array<string>"))
    apps = F.filter(applications, lambda x: x.isin(*config.APPLICATIONS))
    values = {
        "audiences": F.filter(audiences, lambda x: x.isin(*config.AUDIENCES)),
        "domain": known,
        "subdomains": F.filter(subdomains, lambda x: F.array_contains(allowed, x)),
        "applications": F.when(F.array_contains(apps, config.GENERAL_METHOD), F.array(F.lit(config.GENERAL_METHOD))).otherwise(apps),
    }
    outside = lambda values, kind, inside: F.transform(F.filter(values, lambda x: ~inside(x)), lambda x: F.concat(F.lit(kind + ":"), x))
    oov = F.concat(
        outside(audiences, "audience", lambda x: x.isin(*config.AUDIENCES)),
        F.when((domain != "") & known.isNull(), F.array(F.concat(F.lit("domain:"), domain))).otherwise(F.array().cast("array<string>")),
        outside(subdomains, "subdomain", lambda x: F.array_contains(allowed, x)),
        outside(applications, "application_domain", lambda x: x.isin(*config.APPLICATIONS)),
    )
    return values, oov


def classified(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classification by the closed vocabularies; what lies outside is reported and left out."""
    values, oov = vocabulary(word_list(F.col("e.audience_relevance")), F.lower(F.trim(F.coalesce("e.domain", F.lit("")))), word_list(F.col("e.subdomains")), word_list(F.col("e.application_domain")))
    noted = F.when(F.size(oov) > 0, F.concat(F.lit("note: out-of-vocabulary: "), F.array_join(oov, ", ")))
    return judged(responses, entries(responses), values | {"confidence": F.col("e.confidence").try_cast("double")}, noted)


def task_rows(classified: DataFrame) -> DataFrame:
    """One row per paper and task from one classified paper."""
    tasks = [("audience", F.col("audiences")), ("domain", F.array("domain")), ("subdomain", F.col("subdomains")), ("application_domain", F.col("applications"))]
    rows = F.array(*(F.struct(F.lit(t).alias("task_type"), F.array_compact(v).alias("values")) for t, v in tasks))
    return classified.select("content_item_id", "confidence", F.explode(rows).alias("t")).select("content_item_id", "confidence", "t.*")


def in_batches(items: DataFrame, key: str, seal: Column, size: int = 15, strata: int = 4096) -> DataFrame:
    """items with a batch number; every batch but the last has exactly size items, in the order of seal
    (a seeded hash as text), then key.

    Ranks are counted inside strata of equal width in the seal's first three hexadecimal digits
    and set behind those before them, so no task ranks all rows.
    """
    stratum = F.conv(F.substring(seal, 1, 3), 16, 10).cast("int") % strata
    tagged = items.withColumn("_seal", seal).withColumn("_stratum", stratum)
    sizes = tagged.groupBy("_stratum").agg(F.count("*").alias("_n"))
    # At most strata rows.
    before = sizes.select("_stratum", F.coalesce(F.sum("_n").over(Window.orderBy("_stratum").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_seal", key))
    ranked = tagged.withColumn("_rank", rank).join(F.broadcast(before), "_stratum")
    return ranked.select(*items.columns, F.floor((F.col("_before") + F.col("_rank") - 1) / size).alias("batch"))
