"""Organisations that a paper names: lines, phrases, evidence by tiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.functions import text

#: Fixed values of the line rules.
LABEL = r"(?i)^\s*(affiliation|affiliations|email|e-mail|emails|address|corresponding author|correspondence|institution|authors?|thanks|acknowledg\w*|keywords?|subjects?|comments?|title|abstract|cite as|doi)\s*:\s*"
DROPPED_LABELS = ("author", "authors", "keyword", "keywords", "subject", "subjects", "comment", "comments", "title", "abstract", "cite as", "doi", "email", "e-mail", "emails")
THANKS = ("thanks", "acknowledgement", "acknowledgements", "acknowledgment", "acknowledgments")
NOISE = r"(?i)^\[?\s*(submitted|revised|updated|v\d+)\b"
HEADS = r"(?iu)^(Universit(y|ies|e|é|ät|at|à|eit|y's)|Univ|Institute|Institut|Instituto|Institutes|College|Academy|Akademie|Polytechnic|Politecnico|Laboratory|Laboratories|Laboratoire|Hospital|Clinic|Observatory|Museum|Foundation|Corporation|Consortium|Hochschule|Universidad|Universidade|Universiteit|École|Ecole|Escuela)$"
JOINERS = ("of", "for", "the", "and", "de", "del", "di", "du", "des", "der", "von")
PREPOSITIONS = ("of", "for", "de", "del", "di", "du", "des", "der", "von", "in", "at")
SUBUNITS = ("department", "dept", "faculty", "division", "group", "section", "chair", "unit", "program", "programme")
ORG_WORDS = (
    "university", "universite", "université", "universität", "universitat", "universidad", "universidade", "università", "universiteit", "univ", "institute", "institution",
    "instituto", "institut", "college", "academy", "academia", "akademi", "polytechnic", "politecnico", "laboratory", "laboratories", "laboratoire", "hospital", "clinic",
    "medical center", "medical centre", "foundation", "corporation", "company", "technologies", "research center", "research centre", "research institute", "research lab",
    "research laboratory", "observatory", "museum", "ministry", "agency", "consortium", "society", "hochschule", "escuela", "ecole", "école",
)
ORG_ENDINGS = ("inc", "ltd", "llc", "plc", "gmbh", "ag", "bv", "sa", "spa", "pte", "pvt")
MAIL = r"[\w.+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def cleaned(c: Column) -> Column:
    """Without leading footnote marks and trailing punctuation, single blanks."""
    return F.trim(text.collapsed(F.regexp_replace(F.trim(c), r"^[\s\d*†‡§¶#,.;()\[\]-]+", "")), F.lit(" ,;."))


def _bare(token: Column, marks: str) -> Column:
    return F.trim(token, F.lit(marks))


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, however often f reads it: lambdas know no common subexpressions."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _leading(flags: Column) -> Column:
    """How many of the first flags are true."""
    return F.aggregate(flags, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, f: F.struct((s["n"] + (s["on"] & f).cast("int")).alias("n"), (s["on"] & f).alias("on")))["n"]


def organisation_phrases(segment: Column) -> Column:
    """Names around head nouns: up to four capitalised words before one, less the first if it belongs
    to a preposition, and after a joiner up to four words of a name. As array expressions, no UDF."""
    capital = lambda t: _bare(t, ".,;:()[]&").rlike(r"^\p{Lu}")
    joiner = lambda t: F.lower(_bare(t, ".,;:()[]&")).isin(*JOINERS)

    def phrases(words: Column) -> Column:
        word = lambda i: F.get(words, i)

        def grown(i: Column, left: Column) -> Column:
            owned = (left > 0) & F.when(i - left > 0, word(i - left - 1)["low"].isin(*PREPOSITIONS)).otherwise(False)
            more = F.coalesce(word(i + 1)["low"].isin(*JOINERS) & word(i + 2)["named"], F.lit(False))
            right = F.when(more, 1 + _leading(F.transform(F.array(*map(F.lit, (2, 3, 4, 5))), lambda k: F.coalesce(word(i + k)["named"], F.lit(False))))).otherwise(0)
            start = i - left + owned.cast("int")
            return cleaned(F.array_join(F.transform(F.slice(words, start + 1, i - start + 1 + right), lambda w: w["token"]), " "))

        def phrase(i: Column) -> Column:
            left = _leading(F.transform(F.array(*map(F.lit, (1, 2, 3, 4))), lambda k: F.when(i - k >= 0, word(i - k)["capital"]).otherwise(False)))
            return _bound(left, lambda n: grown(i, n))

        heads = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: word(i)["head"])
        return F.array_distinct(F.filter(F.transform(heads, phrase), lambda p: F.length(p) >= 4))

    told = lambda t: F.struct(t.alias("token"), F.lower(t).alias("low"), capital(t).alias("capital"), (capital(t) | joiner(t)).alias("named"), _bare(t, ".,;:()[]").rlike(HEADS).alias("head"))
    return _bound(F.transform(F.split(segment, " "), told), phrases)


def like_an_organisation(segment: Column) -> Column:
    low = F.lower(segment)
    ending = _bare(F.element_at(F.split(F.rtrim(low, F.lit(".")), " "), -1), ".")
    holds = F.lit(False)
    for w in ORG_WORDS:
        holds = holds | F.contains(low, F.lit(w))
    return ~low.rlike(f"^({'|'.join(SUBUNITS)})") & (holds | ending.isin(*ORG_ENDINGS))


def like_a_name(segment: Column) -> Column:
    """Two to six words of a proper noun, no digits, no trailing country or state code."""
    tokens = F.split(segment, " ")
    last = F.trim(F.element_at(tokens, -1), F.lit("."))
    bare = lambda t: _bare(t, ".,;:()[]&")
    capital = lambda t: bare(t).rlike(r"^\p{Lu}")
    code = (F.length(last) <= 3) & (last == F.upper(last)) & last.rlike(r"\p{Lu}")
    return F.size(tokens).between(2, 6) & ~segment.rlike(r"\d") & ~F.lower(tokens[0]).isin(*SUBUNITS) & ~code & F.forall(tokens, lambda t: capital(t) | F.lower(bare(t)).isin(*JOINERS)) & F.exists(tokens, capital)


def organisation_candidates(line: Column) -> Column:
    """Organisation names readable from a line, in order, each once whatever its case."""
    segments = F.transform(F.split(line, r"[,;|]|\s+–\s+|\s+-\s+"), cleaned)
    segments = F.filter(segments, lambda s: (F.length(s) >= 4) & ~s.rlike(MAIL))

    def names(s: Column) -> Column:
        other = F.when(like_an_organisation(s) | like_a_name(s), F.array(s)).otherwise(F.array().cast("array<string>"))
        return _bound(organisation_phrases(s), lambda p: F.when(F.size(p) > 0, p).otherwise(other))

    return _bound(F.flatten(F.transform(segments, names)), lambda found: text.first_of_each(found, F.lower))


def parsed_entries(papers: DataFrame, key: str) -> DataFrame:
    """paper, place, entry, label, line, candidates, mails, domains of every entry of affiliation_text that has any text.

    Entries repeat a lot: each different one is read once, and the readings are joined back.
    """
    entries = papers.select(F.col(key).alias("paper"), F.posexplode("affiliation_text").alias("place", "entry")).where("entry IS NOT NULL")
    read = entries.select("entry").distinct().withColumn("label", F.lower(F.regexp_extract("entry", LABEL, 1))).withColumn("line", cleaned(F.regexp_replace(F.trim("entry"), LABEL, ""))).where("line <> ''")
    read = read.select("*", organisation_candidates(F.col("line")).alias("candidates"), text.emails(F.col("line")).alias("mails"), text.mail_domains(F.col("line")).alias("domains"))
    return entries.join(read, "entry").select("paper", "place", "entry", "label", "line", "candidates", "mails", "domains")


def evidence_lines(parsed: DataFrame) -> DataFrame:
    """paper, place, line, label, candidates of the parsed entries that may name an organisation.

    Author lists, keywords and the like, mail lines, submission notes and repeated lines fall out, and so
    do thanks and contact lines without a name.
    """
    entry = F.trim("entry")
    kept = parsed.where(~F.col("label").isin(*DROPPED_LABELS) & ~F.col("line").rlike(NOISE) & ~entry.rlike(NOISE) & ~F.lower("line").isin("corresponding author", "n/a", "none"))
    first = F.min_by(F.struct("place", "line", "label", "candidates", (F.size("domains") > 0).alias("contact")), "place")
    one = kept.groupBy("paper", F.lower("line").alias("low")).agg(first.alias("x")).select("paper", "x.*")
    return one.where((F.size("candidates") > 0) | ~(F.col("contact") | F.col("label").isin(*THANKS))).drop("contact")


def affiliation_evidence(papers: DataFrame, key: str) -> DataFrame:
    """(key, place, line, label, candidates) of the lines of papers (key, affiliation_text array; null: none) that may name an organisation."""
    return evidence_lines(parsed_entries(papers, key)).withColumnRenamed("paper", key).select(key, "place", "line", "label", "candidates")


def grounding_span(name: Column, line: Column) -> Column:
    """How name stands in line, words apart by anything but letters and digits; null if it doesn't."""
    words = F.filter(F.split(text.grounding_key(name), " "), lambda w: w != "")
    pattern = F.concat(F.lit(r"(?iuU)(?<!\w)"), F.array_join(F.transform(words, lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"))), r"\W+"), F.lit(r"(?!\w)"))
    return F.when(F.size(words) > 0, F.regexp_substr(line, pattern))


def less_specific(name: Column, candidate: Column) -> Column:
    """candidate holds name as whole words and more than articles besides."""
    padded = lambda c: F.concat(F.lit(" "), text.grounding_key(c), F.lit(" "))
    count = lambda c: F.size(F.split(text.grounding_key(c), " "))
    rest = F.replace(padded(candidate), padded(name), F.lit(" "))
    extra = F.exists(F.split(F.trim(rest), " "), lambda w: (w != "") & ~w.isin("the", "a", "an"))
    return (text.grounding_key(name) != "") & (count(name) < count(candidate)) & F.contains(padded(candidate), padded(name)) & extra


def chosen_registry_match(matches: DataFrame, key: list[str], least_score: float = 0.5, kept: Sequence[str] = ()) -> DataFrame:
    """One accepted registry record for each key (and raw line): the name with the longest literal
    span in line or candidate, then the earliest; else the first record one of whose aliases stands there.

    matches: key, line, candidate, place (rank in the registry's answer), org_name, aliases, score, and columns to be kept.
    """
    m = matches.where((F.coalesce("score", F.lit(0.0)) >= least_score) & (F.nullif(F.trim("org_name"), F.lit("")).isNotNull())).where(~less_specific(F.col("org_name"), F.col("candidate")))
    span = lambda n: F.coalesce(grounding_span(n, F.col("line")), grounding_span(n, F.col("candidate")))
    by_alias = F.get(F.filter(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), span), lambda s: s.isNotNull()), F.lit(0))
    m = m.withColumn("span", span(F.col("org_name"))).withColumn("alias_span", F.when(F.col("span").isNull(), by_alias)).where("span IS NOT NULL OR alias_span IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("span").isNull(), F.desc(F.when(F.col("span").isNotNull(), F.length("span"))), "place"))
    confidence = F.when(F.col("span").isNotNull(), F.least(F.lit(0.85), 0.6 + 0.25 * F.col("score"))).otherwise(0.6)
    return m.withColumn("_rank", rank).where("_rank = 1").select(*key, "org_name", *kept, F.coalesce("span", "alias_span").alias("evidence_value"), confidence.alias("confidence"))


def registry_records(raw: DataFrame) -> DataFrame:
    """(id, name, country_code, aliases, acronyms, domains) of registry records in either format (column record, JSON)."""
    shape = "id string, name string, country struct<country_code string>, aliases array<string>, acronyms array<string>, domains array<string>, names array<struct<value string, types array<string>>>, locations array<struct<geonames_details struct<country_code string>>>"
    r = raw.select(F.from_json("record", shape).alias("r"))
    typed = lambda kind: F.transform(F.filter(F.coalesce("r.names", F.array()), lambda n: F.array_contains(n["types"], kind)), lambda n: n["value"])
    name = F.coalesce("r.name", F.get(typed("ror_display"), F.lit(0)), F.get(typed("label"), F.lit(0)))
    empty = F.array().cast("array<string>")
    return r.select(
        F.col("r.id").alias("id"), name.alias("name"), F.coalesce("r.country.country_code", F.get("r.locations", F.lit(0))["geonames_details"]["country_code"]).alias("country_code"),
        F.array_except(F.array_distinct(F.concat(F.coalesce("r.aliases", empty), typed("alias"), typed("label"))), F.array(name)).alias("aliases"),
        F.array_distinct(F.concat(F.coalesce("r.acronyms", empty), typed("acronym"))).alias("acronyms"), F.coalesce("r.domains", empty).alias("domains"),
    )
