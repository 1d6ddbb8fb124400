"""Author lists of any shape, and the authors that other sources mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.functions import text
from litfunnel.sources.staging import written


def author_names(raw: Column) -> Column:
    """Names in a JSON list of strings or objects (name, else fullname, else raw_name), or in a bare
    string; blanks and anything else fall out, nothing raises."""
    v = F.try_parse_json(raw)
    listed = F.from_json(F.when(F.schema_of_variant(v).startswith("ARRAY"), raw), "array<variant>")
    field = lambda x, k: F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit(""))
    name = lambda x: F.when(F.schema_of_variant(x) == "STRING", x.try_cast("string")).when(F.schema_of_variant(x).startswith("OBJECT"), F.coalesce(field(x, "name"), field(x, "fullname"), field(x, "raw_name")))
    single = F.when(v.isNull(), raw).when(F.schema_of_variant(v) == "STRING", v.try_cast("string"))
    names = F.coalesce(F.transform(listed, name), F.array(single))
    return F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def text_values(raw: Column, fields: tuple[str, ...] = ("affiliation", "text", "name", "value", "email")) -> Column:
    """Texts in a JSON list of strings or objects (the first of fields that holds any), or in a bare string; blanks fall out."""
    v = F.try_parse_json(raw)
    listed = F.from_json(F.when(F.schema_of_variant(v).startswith("ARRAY"), raw), "array<variant>")
    field = lambda x, k: F.when(F.trim(F.try_variant_get(x, f"$.{k}", "string")) != "", F.try_variant_get(x, f"$.{k}", "string"))
    one = lambda x: F.when(F.schema_of_variant(x) == "STRING", x.try_cast("string")).when(F.schema_of_variant(x).startswith("OBJECT"), F.coalesce(*(field(x, k) for k in fields)))
    single = F.when(v.isNull(), raw).when(F.schema_of_variant(v) == "STRING", v.try_cast("string"))
    return F.filter(F.coalesce(F.transform(listed, one), F.array(single)), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))


def structured_first(enrichment: Column, raw: Column) -> Column:
    """The enriched author array unless it is null or empty, else the raw one."""
    return F.when(F.size(enrichment) > 0, enrichment).otherwise(raw)


def author_rows(papers: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, author_position from 1, raw_name, normalized_name) in order."""
    rows = papers.select(key, F.posexplode(author_names(F.col(raw))).alias("i", "raw_name"))
    return rows.select(key, (F.col("i") + 1).alias("author_position"), "raw_name", text.collapsed(F.col("raw_name")).alias("normalized_name"))


def author_of_mail(mails: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    """(key, email, author_position) where all words of three letters or more in the local part are
    words of the author's name; the first such author, null if none."""
    local = F.lower(F.substring_index("email", "@", 1))
    words = F.filter(F.split(local, r"[._\-+0-9]+"), lambda w: F.length(w) > 2)
    asked = authors.join(mails.select(key).distinct(), key, "left_semi")
    named = asked.select(key, "author_position", F.split(text.grounding_key(F.col("normalized_name")), " ").alias("name_words"))
    pairs = mails.withColumn("words", words).where(F.size("words") > 0).join(named, key).where(F.size(F.array_except("words", "name_words")) == 0)
    best = pairs.groupBy(key, "email").agg(F.min("author_position").alias("author_position"))
    return mails.select(key, "email").join(best, [key, "email"], "left")


def author_of_name(names: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    """(key, name, author_position): the first author that shares a spelling of the name, else the only
    one with its surname and initial; null if none."""
    asked = names.select(key).distinct()
    mine = authors.join(asked, key, "left_semi").select(key, "author_position", F.col("normalized_name").alias("name"))
    mine, names = written(mine, "authors-asked"), written(names.select(key, "name"), "names-asked")
    # Names repeat a lot: each different one is read once, and the readings are joined back.
    every = mine.select("name").unionByName(names.select("name")).where("name IS NOT NULL").distinct()
    read = written(every.select("name", text.name_forms(F.col("name")).alias("forms"), text.surname_key(F.col("name")).alias("surname")), "names-read")
    of_names, of_authors = names.join(read, "name"), mine.join(read, "name")
    forms = lambda df, *kept: df.select(key, *kept, F.explode("forms").alias("form"))
    same = forms(of_names, "name").join(forms(of_authors, "author_position"), [key, "form"])
    by_form = same.groupBy(key, "name").agg(F.min("author_position").alias("by_form"))
    surname = lambda df, *kept: df.where("surname IS NOT NULL").select(key, *kept, "surname")
    near = surname(of_names, "name").join(surname(of_authors, "author_position"), [key, "surname"])
    by_surname = near.groupBy(key, "name").agg(F.countDistinct("author_position").alias("n"), F.min("author_position").alias("by_surname")).where("n = 1")
    found = names.join(by_form, [key, "name"], "left").join(by_surname.drop("n"), [key, "name"], "left")
    return found.select(key, "name", F.coalesce("by_form", "by_surname").alias("author_position"))
