"""The organisations of a paper's authors, by tiers of evidence.

1. Names that the paper's lines state and that are known.
2. Domains of the paper's mail addresses, of groups of addresses too.
3. Registry records for the lines that are left: a few look-ups for each paper, in the order of its lines.
4. Institutions that a work index gives for this very paper, where nothing else is known.
Lines that no tier could use stay as unresolved evidence.

Look-ups are tables of stored answers. All papers go through each tier at once: what a tier learns
(organisations, aliases) is used by the tiers after it, and by the next run for the tiers before.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.functions import text
from litfunnel.operators import affiliation
from litfunnel.operators import organisations as org
from litfunnel.operators.authors import author_of_mail, author_of_name
from litfunnel.sources.staging import written

#: Confidence by kind of evidence, and what several authors take off.
EXPLICIT, MAIL_OF_AUTHOR, MAIL_OF_PAPER, UNRESOLVED, SHARED = 0.85, 0.9, 0.75, 0.5, 0.75
#: Of a work's institution: its author is known or not, the paper's words name it or not.
WORK_OF_AUTHOR, WORK_OF_PAPER = (0.85, 0.7), (0.8, 0.6)
MOST_AUTHORS, MOST_LOOKUPS, LONGEST_RAW = 50, 3, 500
#: Evidence of a paper (no author: one of its authors, nobody knows which) before it is dealt to authors.
FACT = ("paper", "author_position", "org_id", "raw_affiliation", "evidence_type", "evidence_value", "confidence", "place")


def nobody() -> Column:
    return F.lit(None).cast("int").alias("author_position")


class Affiliations(NamedTuple):
    """rows: key, author_position, org_id, raw_affiliation, scope, evidence_type, evidence_value, confidence;
    the new organisations; all aliases, those learned included."""

    rows: DataFrame
    created: DataFrame
    aliases: DataFrame


def shared_confidence(confidence: Column) -> Column:
    """A confidence that an unknown one of several authors has, to three places; a tie goes down."""
    return F.ceil(confidence * SHARED * 1000 - 0.5) / 1000


def counted_authors(authors: DataFrame) -> DataFrame:
    """paper, n_authors, positions of every paper with authors; a paper of more than MOST_AUTHORS has no positions."""
    some = F.slice(F.array_sort(F.collect_set("author_position")), 1, MOST_AUTHORS)
    n = F.count("*")
    return authors.groupBy("paper").agg(n.alias("n_authors"), F.when(n <= MOST_AUTHORS, some).alias("positions"))


def dealt(facts: DataFrame, counted: DataFrame) -> DataFrame:
    """facts as rows of authors. What is known of a paper only goes to each of its authors: several take a
    quarter off its confidence, more than MOST_AUTHORS make it too ambiguous to keep."""
    j = facts.join(counted, "paper").where(F.col("author_position").isNotNull() | F.col("positions").isNotNull())
    own, single = F.col("author_position").isNotNull(), F.col("n_authors") == 1
    scope = F.when(F.col("org_id").isNull(), "unresolved_raw").when(own | single, "author_specific").otherwise("paper_level_unassigned")
    confidence = F.when(own | single, F.col("confidence")).otherwise(shared_confidence(F.col("confidence")))
    position = F.explode(F.when(own, F.array("author_position")).otherwise(F.col("positions")))
    return j.select("paper", position.alias("author_position"), "org_id", "raw_affiliation", scope.alias("scope"), "evidence_type", "evidence_value", confidence.alias("confidence"), "place")


def known_names(lines: DataFrame, organisations: DataFrame, aliases: DataFrame) -> DataFrame:
    """line, at, candidate, org_id, value of the candidates that a known name or alias (the least organisation of it) and the line agree on."""
    pairs = lines.select("line", F.posexplode("candidates").alias("at", "candidate")).distinct()
    known = org.known_keys(organisations, aliases).where("tier >= 2").groupBy(F.col("key").alias("known")).agg(F.min(F.struct("tier", "org_id")).alias("m")).select("known", "m.org_id")
    named = pairs.join(known, F.lower(F.trim("candidate")) == F.col("known")).join(organisations.select("org_id", "canonical_name"), "org_id")
    named = named.where(text.grounded(F.col("canonical_name"), F.col("line")) | text.grounded(F.col("candidate"), F.col("line")))
    return named.select("line", "at", "candidate", "org_id", stated(F.col("candidate")).alias("value"))


def stated(name: Column) -> Column:
    """name as it stands in column line, else itself."""
    return F.coalesce(affiliation.grounding_span(name, F.col("line")), name)


def contacts(parsed: DataFrame, papers: DataFrame) -> DataFrame:
    """paper, domain, email, place of the domains in lines and then in emails: the first address of each, null where
    only groups of addresses name it. Public mail hosts say nothing."""
    given = papers.select("paper", F.posexplode("emails").alias("place", "entry")).where("entry IS NOT NULL")
    said = parsed.select("paper", F.lit(0).alias("part"), "place", "mails", "domains").unionByName(given.select("paper", F.lit(1).alias("part"), "place", text.emails(F.col("entry")).alias("mails"), text.mail_domains(F.col("entry")).alias("domains")))
    host = lambda m: F.trim(F.substring_index(m, "@", -1), F.lit("."))
    named = F.concat(F.transform("mails", lambda m: F.struct(m.alias("email"), host(m).alias("domain"))), F.transform("domains", lambda d: F.struct(F.lit(None).cast("string").alias("email"), d.alias("domain"))))
    each = said.select("paper", "part", "place", F.posexplode(named).alias("at", "x")).where(~org.public_mail(F.col("x.domain")))
    each = each.select("paper", "x.domain", "x.email", F.struct("part", "place", "at").alias("place"))
    first = F.min(F.when(F.col("email").isNotNull(), F.struct("place", "email"))).alias("m")
    return each.groupBy("paper", "domain").agg(first, F.min("place").alias("place")).select("paper", "domain", "m.email", F.coalesce("m.place", "place").alias("place"))


def by_mail(domains: DataFrame, authors: DataFrame, aliases: DataFrame) -> DataFrame:
    """Facts of the domains (see contacts) that are known."""
    hosts = domains.select("domain").distinct().withColumn("host", F.col("domain"))
    known = written(org.of_domains(hosts, aliases, "host", "domain").select("domain", "org_id"), "domains")
    found = written(domains.join(known, "domain"), "mails")
    mails = found.where("email IS NOT NULL")
    owned = mails.join(author_of_mail(mails.select("paper", "email"), authors, "paper"), ["paper", "email"], "left")
    row = lambda df, raw, confidence: df.withColumn("raw_affiliation", F.col(raw)).withColumn("evidence_type", F.lit("email_domain")).withColumn("evidence_value", F.col("domain")).withColumn("confidence", F.lit(confidence)).withColumn("place", F.struct(F.lit(2).alias("tier"), F.col("place.part").alias("a"), F.col("place.place").alias("b")))
    author = row(owned, "email", MAIL_OF_PAPER).withColumn("confidence", F.when(F.col("author_position").isNull(), MAIL_OF_PAPER).otherwise(MAIL_OF_AUTHOR))
    grouped = row(found.where("email IS NULL"), "domain", MAIL_OF_PAPER).withColumn("author_position", F.lit(None).cast(authors.schema["author_position"].dataType))
    return author.select(*FACT).unionByName(grouped.select(*FACT))


def explicit(rows: DataFrame, tier: int) -> DataFrame:
    """Facts in the paper's own words from rows (paper, place, at, line, org_id, value)."""
    return rows.select("paper", nobody(), "org_id", F.col("line").alias("raw_affiliation"), F.lit("explicit_paper_affiliation").alias("evidence_type"), F.col("value").alias("evidence_value"), F.lit(EXPLICIT).alias("confidence"), F.struct(F.lit(tier).alias("tier"), F.col("place").alias("a"), F.col("at").alias("b")).alias("place"))


def looked_up(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """paper, place, at, line, candidate and the accepted record of the lines that a registry resolves.

    A paper asks for the candidates of its lines in order, for each line until one has an accepted record,
    and MOST_LOOKUPS times in all. Which candidate of a line that is depends on the line alone, so
    the look-ups of the lines before are a running sum. registry: query, place, org_name, ror_id,
    aliases, acronyms, domains, score.
    """
    asked = lines.select("line", F.posexplode("candidates").alias("at", "candidate")).distinct()
    none = F.array().cast("array<string>")
    answers = registry.select(F.col("query").alias("candidate"), "place", "org_name", "ror_id", F.concat(F.coalesce("aliases", none), F.coalesce("acronyms", none)).alias("aliases"), "score")
    chosen = affiliation.chosen_registry_match(asked.join(answers, "candidate"), ["line", "at", "candidate"], kept=["ror_id"])
    first = written(chosen.groupBy("line").agg(F.min_by(F.struct("at", "candidate", "org_name", "ror_id", "evidence_value", "confidence"), "at").alias("x")).select("line", "x.*"), "registry")
    used = F.coalesce(F.col("at") + 1, F.size("candidates"))
    before = F.coalesce(F.sum(used).over(Window.partitionBy("paper").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(first, "line", "left").withColumn("before", before).where((F.col("before") + F.col("at") < MOST_LOOKUPS) & F.col("org_name").isNotNull()).drop("before", "candidates")


def of_works(works: DataFrame, lines: DataFrame) -> DataFrame:
    """The institutions of works that the paper's words name or that have a ROR id, with grounded and value.

    works: paper, author_name, institution_name, ror_id, openalex_id, raw_affiliations array.
    """
    said = lines.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("said"))
    none = F.array().cast("array<string>")
    j = works.where(F.trim("institution_name") != "").join(said, "paper", "left")
    supplied = F.array_join(F.concat(F.coalesce("raw_affiliations", none), F.transform(F.coalesce("said", F.array().cast("array<struct<place:int,line:string>>")), lambda x: x["line"])), " ; ")
    name = F.col("institution_name")
    j = j.withColumn("line", supplied).withColumn("grounded", text.grounded(name, F.col("line"))).where(F.col("grounded") | F.nullif(F.trim("ror_id"), F.lit("")).isNotNull())
    return j.select("paper", "author_name", "institution_name", "ror_id", "openalex_id", F.coalesce(F.get("raw_affiliations", F.lit(0)), name).alias("raw"), "grounded", F.when(F.col("grounded"), stated(name)).otherwise(name).alias("value"))


def affiliation_cascade(papers: DataFrame, authors: DataFrame, organisations: DataFrame, aliases: DataFrame, key: str, registry: DataFrame | None = None, works: DataFrame | None = None, pages: DataFrame | None = None, mode: str = "deep") -> Affiliations:
    """Evidence of the organisations of all authors of papers.

    papers: key, affiliation_text, emails (arrays of text; nulls are none); authors: key, author_position,
    normalized_name; papers without authors give no rows. registry, works (with key): see
    looked_up and of_works. pages: key, affiliation_text, emails as read elsewhere, for papers that
    have no evidence of their own. mode fast uses what is known and nothing else; deep looks up too.

    Each (author, organisation, type, value) is kept once, as it was found first. Mail domains that are known
    before any look-up keep their organisation; the others are tried again with what was learned.
    """
    if mode not in ("fast", "deep"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "fast":
        registry = works = pages = None
    people = authors.select(F.col(key).alias("paper"), F.col("author_position").cast("int").alias("author_position"), "normalized_name")
    counted = written(counted_authors(people), "authors")
    own = papers.select(F.col(key).alias("paper"), "affiliation_text", "emails").join(counted.select("paper"), "paper", "left_semi")
    parsed = written(affiliation.parsed_entries(own, "paper"), "entries")
    lines = affiliation.evidence_lines(parsed).select("paper", "place", "line", "candidates")
    domains = contacts(parsed, own)
    if pages is not None:
        some = lines.select("paper").unionByName(domains.select("paper"))
        other = pages.select(F.col(key).alias("paper"), "affiliation_text", "emails").join(counted.select("paper"), "paper", "left_semi").join(some, "paper", "left_anti")
        parsed = parsed.unionByName(written(affiliation.parsed_entries(other, "paper"), "entries"))
        lines = affiliation.evidence_lines(parsed).select("paper", "place", "line", "candidates")
        domains = contacts(parsed, own.unionByName(other))
    lines, domains = written(lines, "lines"), written(domains, "contacts")

    names = written(known_names(lines, organisations, aliases), "names")
    facts = [written(explicit(lines.join(names, "line"), 1).unionByName(by_mail(domains, people, aliases)), "facts")]
    used = lines.join(names.select("line").distinct(), "line", "left_semi").select("paper", "place")
    created = organisations.select("org_id", "canonical_name", "ror_id", "openalex_id").where("false")
    mentions = []
    mention = lambda name, ror, oa: F.md5(F.to_json(F.struct(name.alias("a"), ror.alias("b"), oa.alias("c"))))
    no_id = F.lit(None).cast("string")
    if registry is not None:
        found = written(looked_up(lines.join(used, ["paper", "place"], "left_anti"), registry).withColumn("mention", mention(F.col("org_name"), F.col("ror_id"), no_id)), "lookups")
        mentions.append(found.select("mention", F.col("org_name").alias("name"), "ror_id", no_id.alias("openalex_id")))
        used = used.unionByName(found.select("paper", "place"))
    if works is not None:
        # A paper that any fact with an organisation reaches an author of is resolved.
        reached = facts[0].select("paper", "author_position")
        if registry is not None:
            reached = reached.unionByName(found.select("paper", nobody()))
        done = reached.join(counted, "paper").where("author_position IS NOT NULL OR positions IS NOT NULL").select("paper")
        left = works.select(F.col(key).alias("paper"), "author_name", "institution_name", "ror_id", "openalex_id", "raw_affiliations").join(counted.select("paper"), "paper", "left_semi").join(done, "paper", "left_anti")
        given = written(of_works(left, lines).withColumn("mention", mention(F.col("institution_name"), F.col("ror_id"), F.col("openalex_id"))), "works")
        mentions.append(given.select("mention", F.col("institution_name").alias("name"), "ror_id", "openalex_id"))
    if mentions:
        asked = written(reduce(DataFrame.unionByName, mentions).distinct(), "mentions")
        answers = written(org.resolved(asked, organisations, aliases, "mention"), "answers")
        created = written(org.created(asked, answers, "mention"), "created")
        learned = [org.learned_aliases(asked, answers, aliases, "mention")]
        ids = answers.select("mention", "org_id")
        if registry is not None:
            found = found.join(F.broadcast(ids) if ids.limit(org.BROADCAST_ROWS + 1).count() <= org.BROADCAST_ROWS else ids, "mention")
            evidence = F.struct(F.lit(3).alias("tier"), F.col("place").alias("a"), F.col("at").alias("b"))
            facts.append(found.select("paper", nobody(), "org_id", F.col("line").alias("raw_affiliation"), F.lit("ror_canonical_match").alias("evidence_type"), "evidence_value", "confidence", evidence.alias("place")))
            facts.append(explicit(found.withColumn("value", stated(F.col("candidate"))), 3))
            records = registry.select(F.col("org_name").alias("n"), F.col("ror_id").alias("r"), "aliases", "acronyms", "domains").distinct()
            records = found.select("org_name", "ror_id", "org_id").distinct().join(records, (F.col("org_name") == F.col("n")) & F.col("ror_id").eqNullSafe(F.col("r")))
            for column, kind in (("aliases", "name"), ("acronyms", "abbreviation"), ("domains", "domain")):
                value = org.domain_alias(F.col("alias")) if kind == "domain" else F.nullif(F.trim("alias"), F.lit(""))
                learned.append(records.select("org_id", F.explode(F.col(column).cast("array<string>")).alias("alias")).select("org_id", value.alias("alias"), F.lit(kind).alias("alias_type")).where("alias IS NOT NULL"))
        if works is not None:
            given = given.join(ids, "mention")
            named = lines.select("paper", "place", "line", F.posexplode("candidates").alias("at", "candidate"))
            named = named.join(given.select("paper", "institution_name", "org_id").distinct(), "paper").where(text.grounding_key(F.col("candidate")) == text.grounding_key(F.col("institution_name")))
            facts.append(explicit(named.withColumn("value", stated(F.col("institution_name"))), 4))
            used = used.unionByName(named.select("paper", "place"))
            owner = author_of_name(given.where("author_name IS NOT NULL").select("paper", F.col("author_name").alias("name")).distinct(), people, "paper")
            told = given.join(owner.withColumnRenamed("name", "author_name"), ["paper", "author_name"], "left")
            of = lambda pair: F.when(F.col("grounded"), pair[0]).otherwise(pair[1])
            confidence = F.when(F.col("author_position").isNull(), of(WORK_OF_PAPER)).otherwise(of(WORK_OF_AUTHOR))
            place = F.struct(F.lit(4).alias("tier"), F.lit(0).alias("a"), F.lit(0).alias("b"))
            facts.append(told.select("paper", "author_position", "org_id", F.col("raw").alias("raw_affiliation"), F.lit("openalex_paper_specific").alias("evidence_type"), F.col("value").alias("evidence_value"), confidence.alias("confidence"), place.alias("place")))
        aliases = written(reduce(DataFrame.unionByName, learned).distinct(), "aliases")
        facts.append(by_mail(domains.join(org_domains(facts[0]), ["paper", "domain"], "left_anti"), people, aliases))
    # Equal facts are one before they are dealt.
    once = reduce(DataFrame.unionByName, facts).groupBy("paper", "author_position", "org_id", "evidence_type", "evidence_value").agg(F.min_by(F.struct("raw_affiliation", "confidence", "place"), F.struct("place", "raw_affiliation")).alias("x"))
    settled = written(once.select("paper", "author_position", "org_id", "evidence_type", "evidence_value", "x.*").select(*FACT), "evidence")
    unused = lines.join(used.distinct(), ["paper", "place"], "left_anti")
    reaching = settled.join(counted, "paper").where("author_position IS NOT NULL OR positions IS NOT NULL").select("paper", "org_id").distinct()
    all_names = organisations.select("org_id", "canonical_name").unionByName(created.select("org_id", "canonical_name"))
    told = unused.join(reaching, "paper").join(all_names, "org_id").where(text.grounded(F.col("canonical_name"), F.col("line"))).select("paper", "place").distinct()
    raw = F.substring(F.coalesce(F.get("candidates", F.lit(0)), F.col("line")), 1, LONGEST_RAW)
    left = unused.join(told, ["paper", "place"], "left_anti").groupBy("paper", raw.alias("evidence_value")).agg(F.min_by("line", "place").alias("raw_affiliation"), F.min("place").alias("a"))
    nowhere = F.lit(None).cast(organisations.schema["org_id"].dataType)
    left = left.select("paper", nobody(), nowhere.alias("org_id"), "raw_affiliation", F.lit("explicit_paper_affiliation").alias("evidence_type"), "evidence_value", F.lit(UNRESOLVED).alias("confidence"), F.struct(F.lit(6).alias("tier"), "a", F.lit(0).alias("b")).alias("place"))
    if works is None:
        out = dealt(settled.unionByName(left), counted)
    else:
        # An author of a work may also be one of those that another entry of the work can't tell apart. Evidence of
        # the other kinds never names an author, so that equal facts are one already.
        named = F.col("evidence_type").isin("openalex_paper_specific", "email_domain")
        once = dealt(settled.where(named), counted).groupBy("paper", "author_position", "org_id", "evidence_type", "evidence_value").agg(F.min_by(F.struct("raw_affiliation", "scope", "confidence"), F.struct("place", F.col("scope") != "author_specific")).alias("x")).select("paper", "author_position", "org_id", "evidence_type", "evidence_value", "x.*")
        out = dealt(settled.where(~named).unionByName(left), counted).drop("place").unionByName(once)
    return Affiliations(out.select(F.col("paper").alias(key), "author_position", "org_id", "raw_affiliation", "scope", "evidence_type", "evidence_value", "confidence"), created, aliases)


def org_domains(rows: DataFrame) -> DataFrame:
    """paper, domain of facts of the mail tier."""
    return rows.where("evidence_type = 'email_domain'").select("paper", F.col("evidence_value").alias("domain")).distinct()
