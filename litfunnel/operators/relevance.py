"""Relevance of papers by topic patterns, categories and source."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.functions import scoring

RELEVANT, REJECTED = "RELEVANT", "REJECTED"


def required_literal(pattern: str) -> str:
    """The letters with which every match of a pattern without alternatives at its top begins; may be empty."""
    rest = pattern.removeprefix(r"\b")
    literal = re.match(r"[^\\\[\](){}?*+|.^$]*", rest).group()
    return literal[:-1] if rest[len(literal) : len(literal) + 1] in ("?", "*", "{") else literal


def matched(text: Column, pattern: str) -> Column:
    """text.rlike(pattern) for lower-case patterns; a plain search for the pattern's first letters spares most texts the regex."""
    literal = required_literal(pattern)
    return F.contains(text, F.lit(literal)) & text.rlike(pattern) if len(literal) > 1 else text.rlike(pattern)


def topic_hits(text: Column, topics: Mapping[str, Sequence[str]] = config.TOPICS) -> Column:
    """array<struct<neg, name>> of the topics with patterns in text (lower case), most patterns first, then by name."""
    n = lambda patterns: sum((matched(text, p).cast("int") for p in patterns[1:]), matched(text, patterns[0]).cast("int"))
    every = F.array(*(F.struct((-n(p)).alias("neg"), F.lit(name).alias("name")) for name, p in topics.items()))
    return F.array_sort(F.filter(every, lambda t: t["neg"] < 0))


def score_relevance(papers: DataFrame, topics: Mapping[str, Sequence[str]] = config.TOPICS, floor: float = config.RELEVANCE_FLOOR) -> DataFrame:
    """papers (title, summary, categories array, source_type) with relevance_score, topic_confidence,
    primary_topic, secondary_topics (the next three), relevance_reason and relevance_status.

    Null title, summary or categories count as empty. The text is put together once, before the
    patterns, so that each of them reads a column and not an expression.
    """
    texts = papers.withColumn("_text", F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("summary", F.lit("")))))
    found = texts.withColumn("_topics", topic_hits(F.col("_text"), topics)).drop("_text")
    hits = F.aggregate("_topics", F.lit(0), lambda n, t: n - t["neg"])
    ai = F.arrays_overlap(F.coalesce("categories", F.array().cast("array<string>")), F.array(*map(F.lit, config.AI_CATEGORIES)))
    research = F.coalesce(F.col("source_type").isin(*config.RESEARCH_SOURCES), F.lit(False))
    score = scoring.relevance(hits, ai, research)
    primary = F.get("_topics", F.lit(0))["name"]
    reasons = F.concat_ws("; ", F.when(primary.isNotNull(), F.concat(F.lit("matched topic '"), primary, F.lit("'"))), F.when(ai, "AI/ML arXiv category"), F.when(research, F.concat(F.lit("source prior="), F.col("source_type"))))
    return found.select(
        *papers.columns,
        score.alias("relevance_score"),
        F.least(F.lit(1.0), score / 10).alias("topic_confidence"),
        primary.alias("primary_topic"),
        F.transform(F.slice("_topics", 2, 3), lambda t: t["name"]).alias("secondary_topics"),
        F.coalesce(F.nullif(reasons, F.lit("")), F.lit("no strong deterministic AI signal")).alias("relevance_reason"),
        F.when(score < floor, REJECTED).otherwise(RELEVANT).alias("relevance_status"),
    )


def to_recheck(papers: DataFrame, version: str, include_rejected: bool = True) -> DataFrame:
    """Papers whose relevance was never scored, was scored by another version, or was rejected."""
    return papers.where(F.col("relevance_version").isNull() | (F.col("relevance_version") != version) | (F.lit(include_rejected) & (F.col("relevance_status") == REJECTED)))


def rejected_records(scored: DataFrame, key: str, version: str, pipeline: str) -> DataFrame:
    """The archive's record of each rejected paper."""
    r = scored.where(F.col("relevance_status") == REJECTED)
    return r.select(key, "title", F.col("summary").alias("abstract"), "categories", "relevance_score", "primary_topic", F.col("relevance_reason").alias("rejection_reason"), F.lit(version).alias("relevance_version"), F.lit(pipeline).alias("pipeline"))


def topic_rows(scored: DataFrame, topics: DataFrame, key: str) -> DataFrame:
    """(key, topic_id, is_primary, confidence) of the topics that are known by name; unknown names vanish."""
    named = F.array_compact(F.concat(F.array("primary_topic"), "secondary_topics"))
    rows = scored.select(key, "topic_confidence", F.posexplode(named).alias("place", "name"))
    return rows.join(F.broadcast(topics.select("topic_id", "name")), "name").select(key, "topic_id", (F.col("place") == 0).alias("is_primary"), F.col("topic_confidence").alias("confidence"))


def blinded(papers: DataFrame, key: str, chars: int = 2000) -> DataFrame:
    """What a judge may see of a paper: key, title, categories and the beginning of the abstract, nothing of its authors."""
    return papers.select(key, F.coalesce("title", F.lit("")).alias("title"), F.array_join(F.coalesce("categories", F.array().cast("array<string>")), ", ").alias("categories"), F.substring(F.coalesce("summary", F.lit("")), 1, chars).alias("abstract"))


def affiliation_candidates(papers: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    """Papers with authors that have affiliation lines or a DOI."""
    open_papers = papers.where((F.size("affiliation_text") > 0) | F.nullif("doi", F.lit("")).isNotNull())
    return open_papers.join(authors.select(key), key, "left_semi")


#: How a new score meets a stored one.
SCORE_POLICIES = {"ai_relevance": "overwrite", "scoring_reason": "json", "scored_at": "overwrite"}


def score_rows(scored: DataFrame, key: str, via: str, at: Column) -> DataFrame:
    """(key, ai_relevance, scoring_reason, scored_at) for the table of scores, merged there by SCORE_POLICIES: what
    other stages have noted in scoring_reason stays."""
    reason = F.to_json(F.struct("relevance_reason", F.lit(via).alias("via")))
    return scored.select(key, F.col("relevance_score").alias("ai_relevance"), reason.alias("scoring_reason"), at.alias("scored_at"))
