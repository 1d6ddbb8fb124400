"""Current state of each paper from its latest results and its evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.functions import scoring
from litfunnel.operators import core

MEAN_DIMENSIONS = ("technical_significance", "apparent_novelty", "evidence_strength")


def evidence_weight(kind: Column) -> Column:
    """Weight of a type of evidence, whatever its case; an unknown or null one counts half."""
    weights = F.create_map(*(x for k, w in config.EVIDENCE_WEIGHTS.items() for x in (F.lit(k), F.lit(w))))
    return F.coalesce(F.try_element_at(weights, F.lower(F.trim(kind))), F.lit(config.EVIDENCE_WEIGHT_OTHER))


def adjudicated(papers: DataFrame, evidence: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    """One row per paper: scores, statuses and the adjudication document as JSON.

    papers: key, screen (struct of the three dimensions and passed; null if never screened),
    quality (struct of the rubric dimensions; null if not rated), domain, subdomains, audiences,
    applications. evidence: key, org_id, confidence, weight, standing. authors: a row per author,
    with key. A quality score needs all its dimensions, a final score the evidence strength too.
    """
    best = core.best_evidence(evidence, key, "org_id", "confidence", "weight", "standing", config.CONFIDENCE_FLOOR)
    counts = authors.groupBy(key).agg(F.count("*").alias("author_count"))
    p = core.with_evidence(papers, best, key).join(counts, key, "left").withColumn("author_count", F.coalesce("author_count", F.lit(0)))
    q = scoring.quality({d: F.col(f"quality.{d}") for d in config.QUALITY_WEIGHTS})
    final = scoring.composite(q, F.col("quality.evidence_strength"), F.col("org_boost"))
    p = p.select(
        "*",
        scoring.screen_score(*(F.col(f"screen.{d}") for d in MEAN_DIMENSIONS)).alias("screen_score"),
        F.when(final.isNotNull(), F.round(q, 1)).alias("quality_score"),
        F.round(final, 1).alias("final_score"),
    )
    gap = F.round(F.abs(F.col("quality_score") - F.col("screen_score")), 2)
    status = scoring.quality_status(F.col("quality_score"), F.coalesce("screen.passed", F.lit(False)))
    document = F.to_json(
        F.struct(
            F.col("screen").alias("screen"),
            F.col("quality").isNotNull().alias("quality_present"),
            status.alias("quality_status"),
            gap.alias("screen_quality_disagreement"),
            F.struct("org_id", "org_score", "org_boost", "considered", "status").alias("organisation"),
            F.col("author_count"),
        )
    )
    return p.select(
        key, "domain", "subdomains", "audiences", "applications", "screen_score", "quality_score", "org_id", "org_score", "org_boost", F.lit(0.0).alias("person_boost"), "final_score",
        F.when(F.col("author_count") > 0, "resolved").otherwise("no_authors").alias("author_status"),
        F.col("status").alias("affiliation_status"),
        status.alias("quality_status"),
        gap.alias("disagreement"),
        F.coalesce(gap >= config.DISAGREEMENT, F.lit(False)).alias("disagrees"),
        document.alias("adjudication"),
    )


def replaced_state(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The state after an adjudication: new rows in place of old ones with their key, the rest as before."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))
