"""Signals of a daily feed: entries, best entry of each paper, details, findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TECH_PRODUCT = ("practitioner", "technical_leadership", "enterprise_adoption")
SIGNAL_POLICIES = {c: "new" for c in ("upvotes", "day_rank", "featured_date", "submitter", "comments", "github_url", "github_stars", "project_url", "title")} | {"metadata": "json"}


def truthy(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def date_of(value: Column) -> Column:
    """The date in the first ten characters; null for anything else."""
    return F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd")


def feed_days(first: str, until: str, today: str, lag: int = 14) -> Column:
    """The days to read: from first to until plus lag, but no later than today."""
    day = lambda d: F.lit(d).cast("date")
    last = F.greatest(day(first), F.least(F.date_add(day(until), lag), day(today)))
    return F.sequence(day(first), last)


def ranked_entries(entries: DataFrame) -> DataFrame:
    """Entries (day, arxiv_id, upvotes, ...) with day_rank: more upvotes first, null counting as -1, then
    arxiv_id. Entries without an identifier take a rank and fall out.

    Ranks within one vote count are counted in the window; how many have more votes comes from the
    day's histogram of votes, so a day isn't ranked in one task unless all its entries tie.
    """
    votes = F.coalesce("upvotes", F.lit(-1))
    e = entries.withColumn("_votes", votes)
    sizes = e.groupBy("day", "_votes").agg(F.count("*").alias("_n"))
    more = F.coalesce(F.sum("_n").over(Window.partitionBy("day").orderBy(F.desc("_votes")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.select("day", "_votes", more.alias("_more"))
    inside = F.row_number().over(Window.partitionBy("day", "_votes").orderBy(F.coalesce(F.col("arxiv_id").cast("string"), F.lit("")), "arxiv_id"))
    ranked = e.withColumn("_inside", inside).join(before, ["day", "_votes"])
    return ranked.where("arxiv_id IS NOT NULL AND arxiv_id <> ''").select(*entries.columns, (F.col("_more") + F.col("_inside")).alias("day_rank"))


def best_entries(ranked: DataFrame) -> DataFrame:
    """One entry per arxiv_id: most upvotes (0 counts as none), then the better rank, then the earlier day."""
    w = Window.partitionBy("arxiv_id").orderBy(F.desc(F.coalesce(F.nullif("upvotes", F.lit(0)), F.lit(-1))), "day_rank", "day")
    return ranked.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def feed_entries(feed: DataFrame) -> DataFrame:
    """Flat entries of daily responses (day, body: JSON list of entries)."""
    person = "struct<name string, fullname string, user string>"
    paper = f"struct<id string, title string, upvotes long, githubRepo string, githubStars long, projectPage string, submittedOnDailyAt string, submittedOnDailyBy {person}>"
    e = feed.select("day", F.explode(F.from_json("body", f"array<struct<numComments long, publishedAt string, title string, submittedBy {person}, paper {paper}>>")).alias("e"))
    who = lambda c: truthy(F.col(f"{c}.name"), F.col(f"{c}.fullname"), F.col(f"{c}.user"))
    return e.select(
        "day", F.trim("e.paper.id").alias("arxiv_id"), F.col("e.paper.upvotes").alias("upvotes"),
        # The first source that says anything decides, even if it holds no date.
        date_of(truthy(F.col("e.paper.submittedOnDailyAt"), F.col("e.publishedAt"), F.col("day").cast("string"))).alias("featured_date"),
        F.coalesce(who("e.submittedBy"), who("e.paper.submittedOnDailyBy")).alias("submitter"), F.col("e.numComments").alias("comments"),
        F.col("e.paper.githubRepo").alias("github_url"), F.col("e.paper.githubStars").alias("github_stars"), F.col("e.paper.projectPage").alias("project_url"), truthy(F.col("e.paper.title"), F.col("e.title")).alias("title"),
    )


def with_details(entries: DataFrame, details: DataFrame) -> DataFrame:
    """Entries completed by detail rows (arxiv_id, upvotes, submittedOnDailyAt, githubRepo, githubStars, projectPage, title)."""
    d = details.select("arxiv_id", *(F.col(c).alias(f"d_{c}") for c in ("upvotes", "submittedOnDailyAt", "githubRepo", "githubStars", "projectPage", "title")))
    j = entries.join(d, "arxiv_id", "left")
    changed = {
        "upvotes": F.coalesce("d_upvotes", "upvotes"),
        "featured_date": F.when(F.nullif("d_submittedOnDailyAt", F.lit("")).isNotNull(), date_of(F.col("d_submittedOnDailyAt"))).otherwise(F.col("featured_date")),
        "github_url": truthy(F.col("d_githubRepo"), F.col("github_url")),
        "github_stars": F.coalesce("d_githubStars", "github_stars"),
        "project_url": truthy(F.col("d_projectPage"), F.col("project_url")),
        "title": truthy(F.col("d_title"), F.col("title")),
    }
    return j.select(*((changed[c].alias(c) if c in changed else F.col(c)) for c in entries.columns))


def known_papers(entries: DataFrame, papers: DataFrame, limit: int | None = None) -> DataFrame:
    """Entries of papers that are ours, in order of arxiv_id, the first limit of them."""
    found = entries.join(papers.select("arxiv_id").distinct(), "arxiv_id", "left_semi").orderBy("arxiv_id")
    return found if limit is None else found.limit(limit)


def why_high(final: Column, quality: Column, org_boost: Column, organisation: Column, audiences: Column, domain: Column) -> Column:
    """The stored components of a score as text; null, empty and zero parts are left out."""
    part = lambda label, c: F.when(c.isNotNull(), F.concat(F.lit(label + "="), c.cast("string")))
    said = F.concat_ws("; ", part("final_score", final), part("quality", quality), part("org_boost", F.nullif(org_boost, F.lit(0.0))), part("notable_org", F.nullif(organisation, F.lit(""))), F.when(F.size(audiences) > 0, F.concat(F.lit("audiences="), F.array_join(audiences, ","))), part("domain", F.nullif(domain, F.lit(""))))
    return F.coalesce(F.nullif(said, F.lit("")), F.lit("no stored score components"))


def why_low(final: Column, screen: Column, high: Column) -> Column:
    said = F.concat_ws("; ", F.lit("no final_score (not in quality/adjudication slice)"), F.when(screen.isNotNull(), F.concat(F.lit("screen_score="), screen.cast("string"))))
    return F.when(final.isNull(), said).otherwise(high)


def recommendation(n_both: Column, n_ours: Column, mean_both: Column, mean_ours: Column) -> Column:
    """Whether papers in both sets score enough above those in ours alone."""
    gap = mean_both - mean_ours
    few = n_both < F.greatest(F.lit(20), F.floor(0.15 * (n_both + n_ours)))
    unknown = (n_both == 0) | gap.isNull()
    return F.when(unknown, "weak signal").when((F.abs(gap) < 0.3) & few, "no incremental signal").when(gap >= 0.3, "HF adds useful signal").otherwise("weak signal")
