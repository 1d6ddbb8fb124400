"""Which papers go on to the quality stage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.operators import core
from litfunnel.sources.staging import unused, written

#: A screened paper is ranked by the mean of these.
RANKED_BY = ("technical_significance", "apparent_novelty", "evidence_strength")


def screen_survivors(screens: DataFrame, key: str, at: str, tie: str, ranked_by: Sequence[str] = RANKED_BY, passed: str = "passed") -> DataFrame:
    """(key, mean) of papers whose newest screening passed; mean is null where one of its scores is missing."""
    newest = core.latest_per_key(screens, [key], at, tie).where(F.coalesce(F.col(passed), F.lit(False)))
    total = reduce(lambda a, b: a + b, (F.col(c).cast("double") for c in ranked_by))
    return newest.select(key, (total / len(ranked_by)).alias("mean"))


def linked_to_interest(survivors: DataFrame, links: DataFrame, entities: DataFrame, key: str, entity: str, interest: str) -> DataFrame:
    """Survivors with a link to an active entity of interest, each once."""
    chosen = entities.where(F.coalesce(F.col(interest), F.lit(False)) & F.coalesce(F.col("active"), F.lit(False))).select(entity)
    return survivors.select(key).join(links.join(chosen, entity, "left_semi").select(key), key, "left_semi")


def quality_candidates(
    screens: DataFrame, affiliations: DataFrame, organisations: DataFrame, papers_people: DataFrame, people: DataFrame, key: str = "content_item_id",
    at: str = "at", tie: str = "id", percent: float = config.PERCENTILE, ranked_by: Sequence[str] = RANKED_BY,
) -> DataFrame:
    """(key, routes): the papers of three routes, each once, with the sorted routes that led to it.

    top: the best percent of the survivors with a mean, at least one, equal means by key. org, person: all
    survivors linked to an active organisation or person of interest. screens need passed and the
    scores; affiliations and organisations organisation_id, papers_people and people person_id; organisations
    is_org_of_interest, people is_person_of_interest and both active. Without survivors there are no
    rows. The survivors are written once and read by all routes.
    """
    s = written(screen_survivors(screens, key, at, tie, ranked_by), unused("survivors"))
    return core.routed(
        {
            "top": core.percentile_slice(s.where("mean IS NOT NULL"), "mean", key, percent),
            "org": linked_to_interest(s, affiliations, organisations, key, "organisation_id", "is_org_of_interest"),
            "person": linked_to_interest(s, papers_people, people, key, "person_id", "is_person_of_interest"),
        },
        key,
    )
