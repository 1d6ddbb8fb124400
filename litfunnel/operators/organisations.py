"""Resolution of organisations against what is known and against the watch-list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.functions import text
from litfunnel.operators.graph import connected_components
from litfunnel.sources import staging

#: Rows of a few short columns that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Mail hosts that say nothing about an organisation.
PUBLIC_MAIL = (
    "gmail.com", "googlemail.com", "yahoo.com", "yahoo.co.uk", "hotmail.com", "outlook.com", "live.com", "icloud.com", "me.com", "aol.com",
    "protonmail.com", "proton.me", "qq.com", "163.com", "126.com", "foxmail.com", "mail.ru", "yandex.ru", "example.com",
)


def public_mail(domain: Column) -> Column:
    return F.coalesce(F.ltrim(F.lower(F.trim(domain)), F.lit(".")).isin(*PUBLIC_MAIL), F.lit(False))


def known_keys(organisations: DataFrame, aliases: DataFrame) -> DataFrame:
    """(tier, kind, key, org_id): by ROR id, OpenAlex id, exact name, alias; the least organisation of each key.

    organisations: org_id, canonical_name, ror_id, openalex_id; aliases: org_id, alias, alias_type.
    """
    of = lambda tier, kind, column: organisations.where(F.nullif(F.trim(column), F.lit("")).isNotNull()).select(F.lit(tier).alias("tier"), F.lit(kind).alias("kind"), F.trim(column).alias("key"), "org_id")
    parts = [of(0, "ror", "ror_id"), of(1, "openalex", "openalex_id"), of(2, "name", F.lower("canonical_name")), aliases.select(F.lit(3).alias("tier"), F.lit("alias").alias("kind"), F.lower(F.trim("alias")).alias("key"), "org_id")]
    return reduce(DataFrame.unionByName, parts).groupBy("tier", "kind", "key").agg(F.min("org_id").alias("org_id"))


def _profiles(mentions: DataFrame, key: str) -> DataFrame:
    """mention, profile, ror, openalex, name of the mentions that have a name; a profile is one triple of keys."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    m = mentions.select(F.col(key).alias("mention"), blank(F.col("ror_id")).alias("ror"), blank(F.col("openalex_id")).alias("openalex"), blank(F.lower("name")).alias("name"), F.trim("name").alias("said"))
    return m.where("name IS NOT NULL").withColumn("profile", F.md5(F.to_json(F.struct("ror", "openalex", "name"))))


def _sized(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def resolved(mentions: DataFrame, organisations: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """(key, org_id, matched_by) of mentions (name, ror_id, openalex_id): the first tier that knows one.

    Mentions that no tier knows are new organisations: those that share a ROR id, an OpenAlex id or a
    name, also through others, are one. Where such a class shares a name with a mention that is
    known, or an id that its organisation lacked, it is 'linked' to the least such organisation;
    else it is 'created', with a negative id made from its least key, whatever the order of mentions.
    Names are required: rows with a blank name fall out. Rows that repeat a key are all answered.

    Equal mentions are resolved once, so one that holds most of the rows costs no more than another.
    """
    asked = _profiles(mentions, key)
    profiles = staging.written(asked.select("profile", "ror", "openalex", "name").distinct(), "profiles")
    tiers = ((0, "ror", "ror"), (1, "openalex", "openalex"), (2, "name", "name"), (3, "alias", "name"))
    keys = profiles.select("profile", F.explode(F.array(*(F.struct(F.lit(i).alias("tier"), F.lit(k).alias("kind"), F.col(c).alias("key")) for i, k, c in tiers))).alias("x")).select("profile", "x.*").where("key IS NOT NULL")
    found = keys.join(known_keys(organisations, aliases), ["tier", "kind", "key"])
    best = staging.written(found.groupBy("profile").agg(F.min(F.struct("tier", "org_id", "kind")).alias("m")).select("profile", "m.org_id", F.col("m.kind").alias("matched_by")), "known")
    nodes = keys.where("kind <> 'alias'").select("profile", "kind", F.concat("kind", F.lit(":"), "key").alias("node"))
    fresh = nodes.join(best, "profile", "left_anti")
    classes = connected_components(fresh, "profile", "node")
    # What known mentions teach: their name, and ids where their organisation has none.
    ids = organisations.select("org_id", *(F.nullif(F.trim(c), F.lit("")).isNull().alias(f"no_{k}") for k, c in (("ror", "ror_id"), ("openalex", "openalex_id"))))
    taught = nodes.join(best, "profile").join(ids, "org_id").where("kind = 'name' OR (kind = 'ror' AND no_ror) OR (kind = 'openalex' AND no_openalex)").groupBy("node").agg(F.min("org_id").alias("org_id"))
    linked = classes.join(taught, "node").groupBy("component").agg(F.min("org_id").alias("org_id"))
    new = -F.abs(F.xxhash64("component") % (1 << 62)) - 1
    others = classes.join(linked, "component", "left").select(F.col("node").alias("profile"), F.coalesce("org_id", new).alias("org_id"), F.when(F.col("org_id").isNull(), "created").otherwise("linked").alias("matched_by"))
    answers = best.unionByName(others.join(profiles.select("profile"), "profile", "left_semi"))
    return asked.select("mention", "profile").join(_sized(answers), "profile").select(F.col("mention").alias(key), "org_id", "matched_by")


def created(mentions: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """(org_id, canonical_name, ror_id, openalex_id) of the new organisations in answers, the result of resolved:
    the name of their first mention by key, and the first id of each kind that a mention has."""
    m = _profiles(mentions, key).join(answers.where("matched_by = 'created'").select(F.col(key).alias("mention"), "org_id").distinct(), "mention")
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("mention", c)))[c]
    return m.groupBy("org_id").agg(first("said").alias("canonical_name"), first("ror").alias("ror_id"), first("openalex").alias("openalex_id"))


def learned_aliases(mentions: DataFrame, answers: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """aliases (org_id, alias, alias_type) with the name of every mention for the organisation it went to, each once."""
    m = _profiles(mentions, key).join(answers.select(F.col(key).alias("mention"), "org_id").distinct(), "mention")
    new = m.select("org_id", F.col("said").alias("alias"), F.lit("name").alias("alias_type"))
    return aliases.select("org_id", "alias", "alias_type").unionByName(new).distinct()


def domain_alias(domain: Column) -> Column:
    return F.nullif(F.trim(F.ltrim(F.lower(F.trim(domain)), F.lit("@")), F.lit(".")), F.lit(""))


def seeded(watchlist: DataFrame, organisations: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """organisations and aliases with all entries of a watch-list (see watchlist_keys for its columns) in them.

    Entries that are known fill gaps in ids, others become organisations; names and aliases of entries
    become name aliases, their domains domain aliases, and interest and priority are set as in
    watched. Doing it again changes nothing. organisations: org_id, canonical_name, ror_id,
    openalex_id, priority; entries without a name fall out.
    """
    answers = staging.written(resolved(watchlist, organisations, aliases, "entry"), "entries")
    filled = enriched(organisations, answers.join(watchlist.select("entry", "ror_id", "openalex_id"), "entry"))
    new = created(watchlist, answers, "entry").withColumn("priority", F.lit(0))
    every = filled.select("org_id", "canonical_name", "ror_id", "openalex_id", "priority").unionByName(new)
    entries = watchlist.join(answers.select("entry", "org_id"), "entry")
    none = F.array().cast("array<string>")
    listed = lambda column, kind, value: entries.select("org_id", F.explode(F.coalesce(column, none)).alias("x")).select("org_id", value(F.col("x")).alias("alias"), F.lit(kind).alias("alias_type"))
    named = learned_aliases(watchlist, answers, aliases, "entry")
    more = listed("aliases", "name", lambda x: F.nullif(F.trim(x), F.lit(""))).unionByName(listed("domains", "domain", domain_alias)).where("alias IS NOT NULL")
    out = staging.written(named.unionByName(more).distinct(), "aliases")
    return watched(staging.written(every, "organisations"), out, watchlist), out


def enriched(organisations: DataFrame, found: DataFrame) -> DataFrame:
    """organisations with gaps in ror_id and openalex_id filled from found (org_id, ror_id, openalex_id), the least value of several."""
    filled = found.groupBy("org_id").agg(*(F.min(F.nullif(F.trim(c), F.lit(""))).alias(f"f_{c}") for c in ("ror_id", "openalex_id")))
    j = organisations.join(filled, "org_id", "left")
    return j.select(*(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"f_{c}")).alias(c) if c in ("ror_id", "openalex_id") else F.col(c) for c in organisations.columns))


def watchlist_keys(watchlist: DataFrame) -> DataFrame:
    """(kind, key, entry, priority): the first entry of each key. watchlist: entry (its place in the
    list), name, priority, ror_id, openalex_id, aliases array, domains array."""
    keys = F.concat(
        F.array(F.struct(F.lit("ror").alias("kind"), F.col("ror_id").alias("key")), F.struct(F.lit("openalex").alias("kind"), F.col("openalex_id").alias("key")), F.struct(F.lit("name").alias("kind"), text.name_key(F.col("name")).alias("key"))),
        F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(F.lit("name").alias("kind"), text.name_key(a).alias("key"))),
        F.transform(F.coalesce("domains", F.array().cast("array<string>")), lambda d: F.struct(F.lit("domain").alias("kind"), F.lower(d).alias("key"))),
    )
    rows = watchlist.select("entry", "priority", F.explode(keys).alias("k")).select("k.*", "entry", "priority").where("key IS NOT NULL AND key <> ''")
    return rows.groupBy("kind", "key").agg(F.min(F.struct("entry", "priority")).alias("e")).select("kind", "key", "e.*")


def watched(organisations: DataFrame, aliases: DataFrame, watchlist: DataFrame) -> DataFrame:
    """organisations with is_org_of_interest and priority raised to that of the first entry in list
    order that any of their ids, names or domains meets."""
    keys = watchlist_keys(watchlist)
    own = reduce(
        DataFrame.unionByName,
        [
            organisations.select("org_id", F.lit("ror").alias("kind"), F.col("ror_id").alias("key")),
            organisations.select("org_id", F.lit("openalex").alias("kind"), F.col("openalex_id").alias("key")),
            organisations.select("org_id", F.lit("name").alias("kind"), text.name_key(F.col("canonical_name")).alias("key")),
            aliases.select("org_id", F.when(F.col("alias_type") == "domain", "domain").otherwise("name").alias("kind"), F.when(F.col("alias_type") == "domain", F.lower("alias")).otherwise(text.name_key(F.col("alias"))).alias("key")),
        ],
    )
    first = own.join(_sized(keys), ["kind", "key"]).groupBy("org_id").agg(F.min(F.struct("entry", "priority")).alias("e"))
    j = organisations.drop("is_org_of_interest").join(first, "org_id", "left")
    kept = [c for c in organisations.columns if c not in ("priority", "is_org_of_interest")]
    return j.select(*kept, F.greatest(F.coalesce("priority", F.lit(0)), F.coalesce("e.priority", F.lit(0))).alias("priority"), F.col("e").isNotNull().alias("is_org_of_interest"))


def of_domains(domains: DataFrame, aliases: DataFrame, key: str, domain: str) -> DataFrame:
    """(key, domain, org_id): the organisation of the longest known parent domain; public mail hosts have none."""
    parents = domains.where(~public_mail(F.col(domain))).select(key, domain, F.posexplode(text.parent_domains(F.lower(F.trim(F.col(domain), F.lit("."))))).alias("level", "parent"))
    known = aliases.where("alias_type = 'domain'").groupBy(F.lower("alias").alias("parent")).agg(F.min("org_id").alias("org_id"))
    return parents.join(known, "parent").groupBy(key, domain).agg(F.min_by("org_id", "level").alias("org_id"))
