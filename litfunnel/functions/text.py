"""Text, URL and mail expressions; all of them Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from litfunnel.config import TRACKING_PARAMS


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def name_key(c: Column) -> Column:
    """Equality key of a name: lower case, no punctuation but & and -, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.replace(c, F.lit("ß"), F.lit("ss"))), r"(?U)[^\w\s&-]", " "), r"(?U)\s+", " "))


def grounding_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.replace(c, F.lit("ß"), F.lit("ss"))), r"(?U)[^\w]+", " "))


def grounded(name: Column, text: Column) -> Column:
    """name stands in text as whole words; an empty name doesn't."""
    n, t = grounding_key(name), grounding_key(text)
    return (n != "") & F.contains(F.concat(F.lit(" "), t, F.lit(" ")), F.concat(F.lit(" "), n, F.lit(" ")))


#: Groups: host prefix, identifier, version.
_ARXIV = r"(?i)(arxiv\.org/(?:abs|html|pdf)/|arxiv:)?(\d{4}\.\d{4,5}|[a-z\-]+(?:\.[A-Z]{2})?/\d{7})(?:v(\d+))?"


def arxiv_id(text: Column) -> Column:
    """The first arXiv identifier of a link, a citation or plain text, without its version; null if none."""
    return F.nullif(F.regexp_extract(text, _ARXIV, 2), F.lit(""))


def arxiv_version(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, _ARXIV, 3), F.lit("")).try_cast("int")


def normal_url(url: Column) -> Column:
    """An arXiv link as https://arxiv.org/abs/ and its identifier; any other with lower scheme (https if
    none) and host, no www., no tracking parameters, no trailing slash, no fragment. The text of
    parameters is kept as it stands."""
    u = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    scheme = F.lower(F.coalesce(F.nullif(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit("")), F.lit("https")))
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^//([^/?]*)", 1)), r"^www\.", "")
    after = F.regexp_replace(rest, r"^//[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(after, r"^([^?]*)", 1), "/+$", "")
    path = F.when(path == "", "/").when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    query = F.regexp_extract(after, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.split(p, "=")[0]).isin(*TRACKING_PARAMS))
    kept = F.transform(kept, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    plain = F.concat(scheme, F.lit("://"), host, path, tail)
    paper = arxiv_id(url)
    return F.when(paper.isNotNull() & F.contains(F.lower(url), F.lit("arxiv.org")), F.concat(F.lit("https://arxiv.org/abs/"), paper)).otherwise(plain)


def utc_time(text: Column) -> Column:
    """A timestamp from ISO text; null for anything else."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


#: Characters of Windows-1252 beyond Latin-1 and the bytes they stand for.
_CP1252 = ("€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ", "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f")


def repaired(text: Column) -> Column:
    """Text whose UTF-8 bytes were read as Windows-1252 or Latin-1, read as UTF-8; any other as it stands."""
    bytes_as_text = F.translate(text, *_CP1252)
    one_byte = bytes_as_text.rlike(r"^[\x00-\xff]*$") & bytes_as_text.rlike(r"[\x80-\xff]")
    decoded = F.encode(F.when(one_byte, bytes_as_text), "ISO-8859-1").cast("string")
    return F.coalesce(F.try_validate_utf8(decoded), text)


def name_forms(name: Column) -> Column:
    """Keys under which a person may be found: the name, its comma-swapped form, and both after repair."""
    swapped = lambda c: F.when(F.contains(c, F.lit(",")), F.concat(F.trim(F.regexp_extract(c, r"^[^,]*,(.*)$", 1)), F.lit(" "), F.trim(F.substring_index(c, ",", 1))))
    forms = [f for c in (name, repaired(name)) for f in (c, swapped(c))]
    return F.array_distinct(F.filter(F.transform(F.array(*forms), name_key), lambda x: x.isNotNull() & (x != "")))


def surname_key(name: Column) -> Column:
    """Surname and first initial, as 'surname i'; null for a single word."""
    c = repaired(name)
    key = name_key(F.when(F.contains(c, F.lit(",")), F.concat(F.regexp_extract(c, r"^[^,]*,(.*)$", 1), F.lit(" "), F.substring_index(c, ",", 1))).otherwise(c))
    words = F.split(key, " ")
    return F.when(F.size(words) > 1, F.concat(F.element_at(words, -1), F.lit(" "), F.substring(words[0], 1, 1)))


def affiliation_lines(authors: Column) -> Column:
    """'Affiliation: ...' lines of array<struct<affiliations array<string>>>, each once whatever its case, in order."""
    lines = F.filter(F.transform(F.flatten(F.transform(F.coalesce(authors, F.array()), lambda a: F.coalesce(a["affiliations"], F.array()))), collapsed), lambda x: x != "")
    return F.transform(first_of_each(lines, F.lower), lambda x: F.concat(F.lit("Affiliation: "), x))


def first_of_each(values: Column, key: Callable[[Column], Column]) -> Column:
    """Values whose key did not occur before them, in order."""
    keyed = F.transform(values, lambda x: F.struct(key(x).alias("key"), x.alias("value")))
    first = lambda seen, x: F.when(F.exists(seen, lambda y: y["key"] == x["key"]), seen).otherwise(F.concat(seen, F.array(x)))
    return F.transform(F.aggregate(keyed, F.array().cast("array<struct<key: string, value: string>>"), first), lambda x: x["value"])


def emails(text: Column) -> Column:
    """Distinct lower-case addresses in order of appearance; a group like {a, b}@x.org gives none, see mail_domains."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})")), lambda e: F.rtrim(F.lower(e))))


def mail_domains(text: Column) -> Column:
    """Distinct lower-case domains of addresses and of groups of addresses, in order of appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?:[A-Za-z0-9._%+-]|\})\s*@\s*([A-Za-z0-9.-]+\.[A-Za-z]{2,})")), lambda d: F.trim(F.lower(d), F.lit("."))))


def parent_domains(domain: Column) -> Column:
    """domain and its parents of two labels or more, longest first."""
    parts = F.split(domain, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def merged_json(old: Column, new: Column) -> Column:
    """Shallow merge of two JSON objects; the new one wins, values keep their types, null and what is no object
    count as empty. Keys come in order."""
    read = lambda c: F.coalesce(F.from_json(c, "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))
    kept = F.map_filter(read(old), lambda k, _: ~F.map_contains_key(read(new), k))
    both = F.map_concat(kept, read(new))
    return F.to_json(F.map_from_arrays(F.array_sort(F.map_keys(both)), F.transform(F.array_sort(F.map_keys(both)), lambda k: both[k])))
