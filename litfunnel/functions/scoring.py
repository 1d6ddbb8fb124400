"""Score arithmetic. Scores are decimals, so that ties round half up alike everywhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from litfunnel import config


def half_points(value: Column) -> Column:
    """A score of 0 to 10 in half points from any number."""
    return (F.floor(value * 100).cast("bigint") % 21).cast("double") / 2


def as_score(c: Column) -> Column:
    return c.cast("decimal(10,4)")


def screen_score(*dimensions: Column) -> Column:
    """Rounded mean; null if any dimension is."""
    total = sum((as_score(d) for d in dimensions[1:]), as_score(dimensions[0]))
    return F.round(total / len(dimensions), 1).cast("decimal(4,1)")


def quality(dimensions: Mapping[str, Column], weights: Mapping[str, float] = config.QUALITY_WEIGHTS) -> Column:
    total = F.lit(0).cast("decimal(10,4)")
    for name, weight in weights.items():
        total = total + as_score(dimensions[name]) * F.lit(weight).cast("decimal(4,2)")
    return F.round(total, 4).cast("decimal(10,4)")


def composite(quality_score: Column, evidence: Column, org_boost: Column | None = None, person_boost: Column | None = None) -> Column:
    """min(10, quality * evidence factor + capped boosts); null without a quality or evidence score."""
    base, slope = config.EVIDENCE_FACTOR
    factor = F.lit(base).cast("decimal(4,2)") + F.lit(slope).cast("decimal(4,2)") * as_score(evidence)
    total = quality_score * factor
    for boost, cap in ((org_boost, config.ORG_BOOST_CAP), (person_boost, config.PERSON_BOOST_CAP)):
        if boost is not None:
            total = total + F.greatest(F.lit(0).cast("decimal(10,4)"), F.least(as_score(F.coalesce(boost, F.lit(0))), F.lit(cap).cast("decimal(10,4)")))
    # least() skips nulls.
    return F.when(total.isNotNull(), F.round(F.least(F.lit(10).cast("decimal(10,4)"), total), 4)).cast("decimal(10,4)")


def quality_status(score: Column, gate: Column) -> Column:
    return F.when(score.isNotNull(), "scored").when(gate, "not_selected").otherwise("skipped")


def standing(listed: Column, priority: Column, scores: Mapping[int, float] = config.STANDING) -> Column:
    known = F.lit(config.STANDING_LISTED)
    for p, s in scores.items():
        known = F.when(priority == p, s).otherwise(known)
    return F.when(listed, known).otherwise(config.STANDING_UNLISTED)


def relevance(hits: Column, ai_category: Column, research_source: Column) -> Column:
    base = F.when(hits > 0, F.least(F.lit(6.5), 3.0 + 0.7 * hits)).otherwise(0.0)
    return F.least(F.lit(10.0), F.round(base + F.when(ai_category, 2.0).otherwise(0.0) + F.when(research_source, 0.8).otherwise(0.0), 2))


def token_cost(model: Column, tokens_in: Column, tokens_out: Column, prices: Mapping[str, tuple[float, float]] = config.PRICES) -> Column:
    """USD; an unknown model costs nothing."""
    cost = F.lit(0.0)
    for name, (p_in, p_out) in prices.items():
        cost = F.when(model == name, tokens_in / 1e6 * p_in + tokens_out / 1e6 * p_out).otherwise(cost)
    return F.round(cost, 6)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, 1)).otherwise(0.0)
