"""Registered queries of the funnel's stages, each beside the SQL it must agree with.

Inputs are shaped from the driver tables inside each query: titles, responses, author lists and
the like are written from columns by simple rules that the SQL repeats in its own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.functions import text
from litfunnel.operators import adjudication, affiliation, affiliation_stage, authors, core, golden, ingest, ledger, organisations, quality, relevance, responses, signals
from litfunnel.plans.queries import EVIDENCE, HALF, Q_SQL, RUBRIC, SCREEN_SQL, WIDE, evidence, log, query, wide
from litfunnel.sources import html_contacts, paged, raw_files
from litfunnel.sources.keyed_table import KeyedTable
from litfunnel.sources.records import archive_manifest as manifest_of
from litfunnel.sources.records import table
from litfunnel.sources.staging import shared_folder, unused


def by_rest(c: str, n: int, *values: str | None) -> Column:
    """values by the remainder of a number."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(F.col(c) % n == i, F.lit(v)).otherwise(out)
    return out


def rest_sql(c: str, n: int, *values: str | None) -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"(CASE {c} % {n} " + " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values)) + " END)"


# Relevance

TITLES = ("A Transformer agent benchmark", "Retrieval-augmented LLMs and prompt injection", None, "Notes on partial differential equations", "Multimodal training and inference with mixture of experts", "An A/B test of human-AI product management", "Neural network quantization for evals")
CATEGORIES = ("cs.LG", "math.NA", "cs.DB", None)
SOURCES = ("arxiv", "blog", None)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    categories = F.when(by_rest("doc_id", 4, *CATEGORIES).isNotNull(), F.array(by_rest("doc_id", 4, *CATEGORIES), F.lit("x.Y")))
    return d.select("doc_id", by_rest("doc_id", 7, *TITLES).alias("title"), F.col("text").alias("summary"), categories.alias("categories"), by_rest("doc_id", 3, *SOURCES).alias("source_type"))


def pattern_sql(p: str, column: str = "t") -> str:
    """A pattern for RE2, whose word bounds know ASCII letters only."""
    word = r"[^\p{L}\p{N}_]"
    p = p.replace("'", "''")
    p = f"(^|{word})" + p[2:] if p.startswith(r"\b") else p
    p = p[:-2] + f"($|{word})" if p.endswith(r"\b") else p
    return f"CAST(regexp_matches({column}, '{p}') AS INT)"


TOPIC_SQL = "[" + ", ".join("{'neg': -(" + " + ".join(map(pattern_sql, ps)) + "), 'name': '" + name + "'}" for name, ps in config.TOPICS.items()) + "]"
AI_SQL = "coalesce(cat IN ('cs.AI', 'cs.CL', 'cs.CV', 'cs.LG', 'cs.MA', 'cs.RO', 'stat.ML'), false)"
RESEARCH_SQL = "coalesce(source_type IN ('arxiv', 'research_paper', 'company_research'), false)"
RELEVANCE = f"""(SELECT *, least(10.0, round((CASE WHEN len(topics) > 0 THEN least(6.5, 3.0 + 0.7 * list_sum([-x.neg FOR x IN topics])) ELSE 0.0 END)::DOUBLE + CASE WHEN {AI_SQL} THEN 2.0 ELSE 0.0 END + CASE WHEN {RESEARCH_SQL} THEN 0.8 ELSE 0.0 END, 2)) AS score
  FROM (SELECT doc_id, cat, source_type, list_sort([x FOR x IN {TOPIC_SQL} IF x.neg < 0]) AS topics FROM
  (SELECT doc_id, lower(coalesce({rest_sql("doc_id", 7, *TITLES)}, '') || chr(10) || coalesce(text, '')) AS t, {rest_sql("doc_id", 4, *CATEGORIES)} AS cat, {rest_sql("doc_id", 3, *SOURCES)} AS source_type FROM documents)))"""


@query(f"SELECT doc_id, CAST(score AS DOUBLE) AS relevance_score, CAST(least(1.0, score / 10) AS DOUBLE) AS topic_confidence, topics[1].name AS primary_topic, array_to_string([x.name FOR x IN topics[2:4]], '|') AS secondary, coalesce(nullif(concat_ws('; ', 'matched topic ''' || topics[1].name || '''', CASE WHEN {AI_SQL} THEN 'AI/ML arXiv category' END, CASE WHEN {RESEARCH_SQL} THEN 'source prior=' || source_type END), ''), 'no strong deterministic AI signal') AS relevance_reason, CASE WHEN score < 5 THEN 'REJECTED' ELSE 'RELEVANT' END AS relevance_status FROM {RELEVANCE}")
def relevance_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = relevance.score_relevance(papers(spark, sf_dir))
    return s.select("doc_id", "relevance_score", "topic_confidence", "primary_topic", F.array_join("secondary_topics", "|").alias("secondary"), "relevance_reason", "relevance_status")


@query(f"SELECT topics[1].name AS primary_topic, count(*) AS n, CAST(min(score) AS DOUBLE) AS least_score FROM {RELEVANCE} WHERE score < 5 GROUP BY 1")
def rejected_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relevance.rejected_records(relevance.score_relevance(papers(spark, sf_dir)), "doc_id", "v1", "funnel")
    return r.groupBy("primary_topic").agg(F.count("*").alias("n"), F.min("relevance_score").alias("least_score"))


@query("SELECT doc_id FROM documents WHERE doc_id % 5 = 0 OR doc_id % 5 IN (1, 3) OR doc_id % 2 = 1")
def relevance_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", by_rest("doc_id", 5, None, "v0", "v1", "v0", "v1").alias("relevance_version"), by_rest("doc_id", 2, "RELEVANT", "REJECTED").alias("relevance_status"))
    return relevance.to_recheck(d, "v1").select("doc_id")


# Responses

def asked(spark: SparkSession, sf_dir: str, fields: str) -> DataFrame:
    """Responses to batches of ten events: an entry is missing, unexpected or repeated by the number of its event."""
    e = log(spark, sf_dir).withColumn("batch_id", F.floor(F.col("event_id") / 10))
    shown = F.when(F.col("event_id") % 13 == 0, F.col("event_id") + 1_000_000_000).otherwise(F.col("event_id"))
    entry = F.concat(F.lit('{"content_item_id": '), shown.cast("string"), F.lit(", "), F.expr(fields), F.lit("}"))
    g = e.groupBy("batch_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("event_id") % 11 != 0, F.struct("event_id", entry.alias("entry"))))), lambda x: x["entry"]), ", ").alias("body"), F.collect_list("event_id").alias("expected"))
    return g.select("batch_id", F.concat(F.lit('Sure:\n```json\n{"papers": ['), "body", F.lit("]}\n```\nDone.")).alias("text"), "expected")


SCREEN_FIELDS = "concat('\"ai_relevance\": ', CASE WHEN event_id % 17 = 0 THEN '11' WHEN event_id % 7 = 0 THEN '6.3' ELSE CAST(score AS STRING) END, ', \"technical_significance\": \"5.5\", \"apparent_novelty\": ', CASE WHEN event_id % 19 = 0 THEN 'null' ELSE '7' END, ', \"evidence_strength\": 4.0')"


@query(f"SELECT event_id AS content_item_id, {HALF} AS ai_relevance, 5.5::DOUBLE AS technical_significance, {HALF} >= 5 AS passed FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 7 <> 0 AND event_id % 19 <> 0")
def screen_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = responses.screened(asked(spark, sf_dir, SCREEN_FIELDS))
    return parsed.select("content_item_id", "ai_relevance", "technical_significance", "passed")


@query("""SELECT problem, count(*) AS n FROM (
  SELECT unnest(CASE WHEN event_id % 11 = 0 THEN ['missing'] WHEN event_id % 13 = 0 THEN ['missing', 'unexpected content_item_id'] WHEN event_id % 17 = 0 OR event_id % 7 = 0 THEN ['missing', 'invalid ai_relevance'] WHEN event_id % 19 = 0 THEN ['missing', 'invalid apparent_novelty'] ELSE [] END) AS problem FROM events) GROUP BY 1""")
def screen_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, problems = responses.screened(asked(spark, sf_dir, SCREEN_FIELDS))
    return problems.groupBy("problem").agg(F.count("*").alias("n"))


QUALITY_FIELDS = "concat('\"technical_significance\": ', CAST(CAST(event_id % 100 AS DOUBLE) / 10 AS STRING), ', \"apparent_novelty\": 1, \"practical_applicability\": 2, \"potential_value\": 3, \"longevity\": 4.26, \"evidence_strength\": 5, \"so_what\": \" x \", \"reason_not_higher\": ', CASE WHEN event_id % 4 = 0 THEN '\"\"' ELSE '\"why\"' END, ', \"confidence\": 8')"


@query("SELECT event_id AS content_item_id, round_even((event_id % 100)::DOUBLE / 10 * 2, 0) / 2 AS technical_significance, 4.5::DOUBLE AS longevity, 'x' AS so_what, CASE WHEN event_id % 4 = 0 THEN '' ELSE 'why' END AS reason_not_higher, 0.8::DOUBLE AS confidence FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0")
def quality_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = responses.rated(asked(spark, sf_dir, QUALITY_FIELDS))
    return parsed.select("content_item_id", "technical_significance", "longevity", "so_what", "reason_not_higher", "confidence")


CLASS_FIELDS = "concat('\"audience_relevance\": ', CASE event_id % 3 WHEN 0 THEN '[\"Practitioner\", \"wizards\"]' WHEN 1 THEN '\" student \"' ELSE 'null' END, ', \"domain\": ', CASE event_id % 4 WHEN 0 THEN '\"computer_vision\"' WHEN 1 THEN '\"quantum_telepathy\"' WHEN 2 THEN '\"Natural_Language_Processing \"' ELSE 'null' END, ', \"subdomains\": [\"3d_vision\", \"retrieval\"], \"application_domain\": ', CASE WHEN event_id % 5 = 0 THEN '[\"general_method\", \"education\"]' ELSE '[\"education\", \"magic\"]' END)"
CLASSED = "(SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'practitioner' WHEN 1 THEN 'student' ELSE '' END AS audiences, CASE event_id % 4 WHEN 0 THEN 'computer_vision' WHEN 2 THEN 'natural_language_processing' END AS domain, CASE event_id % 4 WHEN 0 THEN '3d_vision' WHEN 2 THEN 'retrieval' ELSE '' END AS subdomains, CASE WHEN event_id % 5 = 0 THEN 'general_method' ELSE 'education' END AS applications FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0)"


@query(f"SELECT event_id AS content_item_id, audiences, domain, subdomains, applications FROM {CLASSED}")
def classify_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = responses.classified(asked(spark, sf_dir, CLASS_FIELDS))
    joined = lambda c: F.array_join(c, ",").alias(c)
    return parsed.select("content_item_id", joined("audiences"), "domain", joined("subdomains"), joined("applications"))


@query("""SELECT problem, count(*) AS n FROM (SELECT 'out-of-vocabulary: ' || array_to_string(list_filter([
    CASE WHEN event_id % 3 = 0 THEN 'audience:wizards' END, CASE WHEN event_id % 4 = 1 THEN 'domain:quantum_telepathy' END, CASE WHEN event_id % 4 <> 0 THEN 'subdomain:3d_vision' END,
    CASE WHEN event_id % 4 <> 2 THEN 'subdomain:retrieval' END, CASE WHEN event_id % 5 <> 0 THEN 'application_domain:magic' END], lambda x: x IS NOT NULL), ', ') AS problem
  FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0) GROUP BY 1""")
def classify_out_of_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, problems = responses.classified(asked(spark, sf_dir, CLASS_FIELDS))
    return problems.where(F.startswith("problem", F.lit("out-of"))).groupBy("problem").agg(F.count("*").alias("n"))


@query(f"""SELECT task_type, "values", count(*) AS n FROM (SELECT unnest(['audience', 'domain', 'subdomain', 'application_domain']) AS task_type, unnest([audiences, coalesce(domain, ''), subdomains, applications]) AS "values" FROM {CLASSED}) GROUP BY 1, 2""")
def classify_task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = responses.classified(asked(spark, sf_dir, CLASS_FIELDS))
    return responses.task_rows(parsed).groupBy("task_type", F.array_join("values", ",").alias("values")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1) // 15 AS BIGINT) AS batch FROM orders")
def random_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return responses.in_batches(orders, "o_orderkey", F.md5(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string"))))


# Adjudication

BEST = f"""(SELECT l_orderkey, org_id, considered, org_score, CASE WHEN org_id IS NULL THEN 0.0 ELSE CAST(round(least(0.5, CAST(org_score AS DECIMAL(6,1)) * CAST(strength AS DECIMAL(8,3)) * CAST(0.05 AS DECIMAL(3,2))), 4) AS DOUBLE) END AS org_boost, CASE WHEN org_id IS NULL THEN 'unresolved' ELSE 'resolved' END AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY strong DESC, s DESC, standing DESC, l_suppkey) AS k, count(*) FILTER (WHERE strong) OVER (PARTITION BY l_orderkey) AS considered,
    CASE WHEN strong THEN l_suppkey END AS org_id, CASE WHEN strong THEN round(standing, 1) ELSE 0.0 END AS org_score, round(s, 3) AS strength
  FROM (SELECT *, CAST(weight * least(1.0, confidence) AS DECIMAL(10,6)) AS s, confidence >= 0.6 AND l_suppkey IS NOT NULL AS strong FROM {EVIDENCE})) WHERE k = 1)"""
STATE = f"""(SELECT w.user_id, coalesce(s.domain, 'none') AS domain, round({SCREEN_SQL}, 1) AS screen_score, {Q_SQL} AS q, b.org_id, coalesce(b.considered, 0) AS considered, coalesce(b.org_score, 0.0) AS org_score, coalesce(b.org_boost, 0.0) AS org_boost, coalesce(b.status, 'no_evidence_supplied') AS affiliation_status,
  click, view, coalesce(a.n, 0) AS author_count FROM {WIDE} w LEFT JOIN (SELECT c_custkey, c_mktsegment AS domain FROM customer) s ON s.c_custkey = w.user_id LEFT JOIN {BEST} b ON b.l_orderkey = w.user_id LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) a ON a.l_orderkey = w.user_id)"""
ADJUDICATED = f"""(SELECT *, CASE WHEN final IS NOT NULL THEN round(q, 1) END AS quality_score FROM (SELECT *, CASE WHEN total > 10 THEN 10 ELSE total END AS final FROM (SELECT *, round(q * (CAST(0.70 AS DECIMAL(4,2)) + CAST(0.03 AS DECIMAL(4,2)) * CAST(click AS DECIMAL(10,4))) + least(CAST(org_boost AS DECIMAL(10,4)), CAST(0.5 AS DECIMAL(10,4))), 4) AS total FROM {STATE})))"""


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of wide(): click is the evidence strength, the rubric as in RUBRIC, the screen from click, view and signup."""
    w = wide(spark, sf_dir)
    screen = F.struct(F.col("click").alias("technical_significance"), F.col("view").alias("apparent_novelty"), F.col("signup").alias("evidence_strength"), (F.col("view") >= config.GATE).alias("passed"))
    quality = F.struct(*(F.col(t).alias(d) for d, t in RUBRIC.items()), F.col("click").alias("evidence_strength"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("domain"))
    none = F.array().cast("array<string>")
    p = w.join(c, "user_id", "left").select("user_id", screen.alias("screen"), quality.alias("quality"), F.coalesce("domain", F.lit("none")).alias("domain"), none.alias("subdomains"), none.alias("audiences"), none.alias("applications"))
    e = evidence(spark, sf_dir).select(F.col("l_orderkey").alias("user_id"), F.col("l_suppkey").alias("org_id"), "confidence", "weight", "standing")
    return adjudication.adjudicated(p, e, e.select("user_id"), "user_id")


@query(f"""SELECT user_id, domain, CAST(screen_score AS DOUBLE) AS screen_score, CAST(quality_score AS DOUBLE) AS quality_score, CAST(round(final, 1) AS DOUBLE) AS final_score, org_id, org_score, org_boost, affiliation_status,
  CASE WHEN author_count > 0 THEN 'resolved' ELSE 'no_authors' END AS author_status, CASE WHEN quality_score IS NOT NULL THEN 'scored' WHEN view >= 5 THEN 'not_selected' ELSE 'skipped' END AS quality_status,
  CAST(round(abs(quality_score - screen_score), 2) AS DOUBLE) AS disagreement, coalesce(abs(quality_score - screen_score) >= 3, false) AS disagrees FROM {ADJUDICATED}""")
def adjudicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    double = lambda c: F.col(c).cast("double").alias(c)
    return state(spark, sf_dir).select("user_id", "domain", *map(double, ("screen_score", "quality_score", "final_score")), "org_id", "org_score", "org_boost", "affiliation_status", "author_status", "quality_status", double("disagreement"), "disagrees")


@query(f"SELECT user_id, affiliation_status AS status, considered, author_count FROM {ADJUDICATED}")
def adjudication_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = lambda path, kind: F.try_variant_get(F.parse_json("adjudication"), f"$.{path}", kind)
    return state(spark, sf_dir).select("user_id", field("organisation.status", "string").alias("status"), field("organisation.considered", "bigint").alias("considered"), field("author_count", "bigint").alias("author_count"))


@query("SELECT DISTINCT kind, w FROM (SELECT l_returnflag AS kind, CASE l_returnflag WHEN 'A' THEN 1.0::DOUBLE WHEN 'N' THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS w FROM lineitem)")
def evidence_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", " Email_Domain ").when(F.col("l_returnflag") == "N", "ror_match").otherwise(F.lit("hearsay"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), adjudication.evidence_weight(kind).alias("w")).distinct()


# Ingest

def harvested(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    paper = F.concat(F.lit("2601."), F.lpad((n % 9000).cast("string"), 5, "0"), F.when(n % 3 == 0, F.lit("v2")).otherwise(F.lit("")))
    categories = F.when(n % 4 == 0, F.array(F.lit("math.NA"))).when(n % 4 == 1, F.array(F.lit("math.NA"), F.lit("stat.ML"))).when(n % 4 == 2, F.array(F.lit("cs.XX")))
    return p.select(
        n.cast("string").alias("identifier"), F.lit("2026-01-06").alias("datestamp"), (n % 10 == 0).alias("deleted"), F.when(n % 23 != 0, paper).alias("arxiv_id"), F.when(n % 5 != 0, F.col("url")).otherwise("").alias("title"), F.lit("text").alias("abstract"),
        categories.alias("categories"), F.array(F.lit("A B")).alias("authors"), by_rest("page_id", 3, "2025-12-30", "2026-01-05T10:00:00Z", "soon").alias("created"), F.lit(None).cast("string").alias("updated"),
    )


def stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = harvested(spark, sf_dir).where("CAST(identifier AS LONG) % 2 = 0 AND arxiv_id IS NOT NULL").withColumn("title", F.lit("old title")).withColumn("created", F.lit("2020-01-01"))
    return ingest.items_of(old, F.lit("2026-01-01").cast("timestamp")).select("canonical_url", *ingest.ITEM_POLICIES)


def window(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ingest.ingested_window(harvested(spark, sf_dir), stored_items(spark, sf_dir), 2026, F.lit("2026-02-02").cast("timestamp"))


HARVEST = """(SELECT page_id AS n, 'https://arxiv.org/abs/2601.' || lpad(CAST(page_id % 9000 AS VARCHAR), 5, '0') AS canonical_url, page_id % 10 = 0 OR page_id % 23 = 0 AS gone, page_id % 4 IN (1, 2) AS matched, CASE WHEN page_id % 5 <> 0 AND url <> '' THEN url ELSE '(untitled)' END AS title FROM pages)"""


@query(f"""WITH h AS (SELECT *, NOT gone AND matched AS kept FROM {HARVEST}), fresh AS (SELECT count(DISTINCT canonical_url) AS k FROM h WHERE kept AND canonical_url NOT IN (SELECT canonical_url FROM h WHERE n % 2 = 0 AND n % 23 <> 0))
  SELECT count(*) AS seen, count(*) FILTER (WHERE gone) AS deleted, count(*) FILTER (WHERE kept) AS kept, count(*) FILTER (WHERE kept AND n % 3 = 0) AS revision, any_value(k) AS new, count(*) FILTER (WHERE kept) - any_value(k) AS dupe FROM h, fresh""")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window(spark, sf_dir)[1]


@query(f"""WITH h AS (SELECT *, NOT gone AND matched AS kept FROM {HARVEST}), new AS (SELECT canonical_url, arg_max(title, CAST(n AS VARCHAR)) AS title, arg_max(CASE n % 3 WHEN 0 THEN '2025-12-30' WHEN 1 THEN '2026-01-05' END, CAST(n AS VARCHAR)) AS a, max(CAST(n AS VARCHAR)) AS top, count(*) AS k FROM h WHERE kept GROUP BY 1),
  latest AS (SELECT canonical_url, title, CASE CAST(top AS BIGINT) % 3 WHEN 0 THEN '2025-12-30' WHEN 1 THEN '2026-01-05' END AS day FROM new), old AS (SELECT DISTINCT canonical_url FROM h WHERE n % 2 = 0 AND n % 23 <> 0)
  SELECT coalesce(l.canonical_url, o.canonical_url) AS canonical_url, coalesce(l.title, 'old title') AS title, CASE WHEN o.canonical_url IS NULL THEN l.day ELSE '2020-01-01' END AS published, o.canonical_url IS NULL AS is_new FROM latest l FULL JOIN old o ON l.canonical_url = o.canonical_url""")
def ingest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window(spark, sf_dir)[0].select("canonical_url", "title", F.date_format("published_at", "yyyy-MM-dd").alias("published"), "is_new")


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN '2601.' || lpad(CAST(page_id % 9000 AS VARCHAR), 5, '0') WHEN 1 THEN 'hep-th/' || lpad(CAST(page_id % 9000 AS VARCHAR), 7, '0') WHEN 2 THEN '2601.' || lpad(CAST(page_id % 9000 AS VARCHAR), 5, '0') WHEN 3 THEN 'math.NA/0101001' END AS arxiv_id,
  CASE page_id % 5 WHEN 0 THEN 3 WHEN 2 THEN 12 END AS version FROM pages""")
def arxiv_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    digits = lambda k: F.lpad((n % 9000).cast("string"), k, "0")
    said = F.when(n % 5 == 0, F.concat(F.lit("https://arxiv.org/pdf/2601."), digits(5), F.lit("v3"))).when(n % 5 == 1, F.concat(F.lit("see arXiv:hep-th/"), digits(7))).when(n % 5 == 2, F.concat(F.lit("http://arxiv.org/html/2601."), digits(5), F.lit("V12")))
    said = said.when(n % 5 == 3, F.lit("math.NA/0101001")).otherwise(F.lit("no paper here"))
    return table(spark, sf_dir, "pages").select("page_id", text.arxiv_id(said).alias("arxiv_id"), text.arxiv_version(said).alias("version"))


# Authors

def author_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, name = F.col("c_custkey") % 6, F.col("c_name")
    raw = F.when(n == 0, F.lit("[]")).when(n == 1, F.concat(F.lit("   "), name, F.lit(" "))).when(n == 2, F.concat(F.lit('["'), name, F.lit('", null, "  ", 7, "José\\tMaría"]')))
    raw = raw.when(n == 3, F.concat(F.lit('[{"name": "", "fullname": "'), name, F.lit('"}, {"raw_name": "张  伟"}, {"other": 1}]'))).when(n == 4, F.concat(F.lit('"'), name, F.lit('"')))
    return table(spark, sf_dir, "customer").select("c_custkey", raw.alias("authors_raw"))


@query("""SELECT c_custkey, author_position, normalized_name FROM (SELECT c_custkey, unnest(CASE c_custkey % 6 WHEN 1 THEN [c_name] WHEN 2 THEN [c_name, 'José María'] WHEN 3 THEN [c_name, '张 伟'] WHEN 4 THEN [c_name] ELSE [] END) AS normalized_name,
  CAST(unnest(CASE c_custkey % 6 WHEN 1 THEN [1] WHEN 2 THEN [1, 2] WHEN 3 THEN [1, 2] WHEN 4 THEN [1] ELSE [] END) AS INT) AS author_position FROM customer)""")
def normalize_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return authors.author_rows(author_lists(spark, sf_dir), "c_custkey", "authors_raw").select("c_custkey", "author_position", "normalized_name")


def supplier_authors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    names = F.array(F.lit("Ada Maria Jones"), F.lit("Bob Stone"), F.concat(F.lit("Nat"), F.col("s_nationkey").cast("string"), F.lit(" Pekár")))
    return s, s.select("s_suppkey", F.posexplode(names).alias("i", "normalized_name")).select("s_suppkey", (F.col("i") + 1).alias("author_position"), "normalized_name")


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'jones.ada77@x.org' WHEN 1 THEN 'b.stone@x.org' WHEN 2 THEN 'al@x.org' ELSE 'ada.stone@x.org' END AS email, CASE s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS author_position FROM supplier")
def author_of_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, own = supplier_authors(spark, sf_dir)
    return authors.author_of_mail(s.select("s_suppkey", by_rest("s_suppkey", 4, "jones.ada77@x.org", "b.stone@x.org", "al@x.org", "ada.stone@x.org").alias("email")), own, "s_suppkey")


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Jones, Ada Maria' WHEN 1 THEN 'B. Stone' WHEN 2 THEN 'nobody here' ELSE 'PekÃ¡r, Nat' || s_nationkey END AS name, CASE s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 3 THEN 3 END AS author_position FROM supplier")
def author_of_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, own = supplier_authors(spark, sf_dir)
    name = F.coalesce(by_rest("s_suppkey", 4, "Jones, Ada Maria", "B. Stone", "nobody here"), F.concat(F.lit("PekÃ¡r, Nat"), F.col("s_nationkey").cast("string")))
    return authors.author_of_name(s.select("s_suppkey", name.alias("name")), own, "s_suppkey")


# Signals

FEED = "(SELECT CAST(ts AS DATE) AS day, CASE WHEN user_id % 29 <> 0 THEN '26.' || user_id END AS arxiv_id, max(CASE WHEN user_id % 7 <> 0 THEN CAST(floor(value) AS BIGINT) END) AS upvotes, max(event_id) AS top FROM events GROUP BY CAST(ts AS DATE), user_id)"
FEED_RANKED = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY coalesce(upvotes, -1) DESC, coalesce(arxiv_id, ''), top) AS day_rank FROM {FEED}) WHERE arxiv_id IS NOT NULL)"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily responses as the feed gives them, read back by the operator."""
    e = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(F.max(F.when(F.col("user_id") % 7 != 0, F.floor("value"))).alias("upvotes"))
    paper = F.struct(F.when(F.col("user_id") % 29 != 0, F.concat(F.lit("26."), F.col("user_id").cast("string"))).alias("id"), F.col("upvotes"), F.when(F.col("user_id") % 3 == 0, "bad date").when(F.col("user_id") % 3 == 1, "2024-01-09T08:00:00Z").alias("submittedOnDailyAt"))
    one = F.to_json(F.array(F.struct(paper.alias("paper"), F.struct(F.lit("").alias("name"), F.lit("al").alias("user")).alias("submittedBy"))))
    return signals.feed_entries(e.select("day", one.alias("body")))


@query(f"SELECT arxiv_id, CAST(day AS VARCHAR) AS day, upvotes, day_rank, CASE CAST(substr(arxiv_id, 4) AS BIGINT) % 3 WHEN 1 THEN '2024-01-09' WHEN 2 THEN CAST(day AS VARCHAR) END AS featured, 'al' AS submitter FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY coalesce(nullif(upvotes, 0), -1) DESC, day_rank, day) AS k FROM {FEED_RANKED}) WHERE k = 1")
def signal_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = signals.best_entries(signals.ranked_entries(feed(spark, sf_dir)))
    return best.select("arxiv_id", F.col("day").cast("string").alias("day"), "upvotes", "day_rank", F.col("featured_date").cast("string").alias("featured"), "submitter")


BEST_FEED = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY coalesce(nullif(upvotes, 0), -1) DESC, day_rank, day) AS k FROM {FEED_RANKED}) WHERE k = 1)"


@query(f"SELECT coalesce(o.arxiv_id, f.arxiv_id) AS arxiv_id, coalesce(f.upvotes, o.upvotes) AS upvotes, coalesce(f.stars, o.stars) AS github_stars, o.arxiv_id IS NULL AS is_new FROM (SELECT '26.' || c_custkey AS arxiv_id, c_custkey % 50 AS upvotes, CAST(1 AS BIGINT) AS stars FROM customer WHERE c_custkey % 3 = 0) o FULL JOIN (SELECT arxiv_id, coalesce(CASE WHEN CAST(substr(arxiv_id, 4) AS BIGINT) % 2 = 0 THEN 99 END, upvotes) AS upvotes, CASE WHEN CAST(substr(arxiv_id, 4) AS BIGINT) % 2 = 0 THEN 5 END AS stars FROM {BEST_FEED} WHERE CAST(substr(arxiv_id, 4) AS BIGINT) IN (SELECT c_custkey FROM customer)) f ON o.arxiv_id = f.arxiv_id")
def signal_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details completed, papers of ours kept, merged into the stored signals."""
    best = signals.best_entries(signals.ranked_entries(feed(spark, sf_dir)))
    even = best.where("CAST(substr(arxiv_id, 4) AS LONG) % 2 = 0").select("arxiv_id", F.lit(99).cast("bigint").alias("upvotes"), F.lit("").alias("submittedOnDailyAt"), F.lit(None).cast("string").alias("githubRepo"), F.lit(5).cast("bigint").alias("githubStars"), F.lit("").alias("projectPage"), F.lit("").alias("title"))
    ours = table(spark, sf_dir, "customer").select(F.concat(F.lit("26."), F.col("c_custkey").cast("string")).alias("arxiv_id"), "c_custkey")
    old = ours.where("c_custkey % 3 = 0").select("arxiv_id", (F.col("c_custkey") % 50).alias("upvotes"), F.lit(1).cast("bigint").alias("github_stars"))
    new = signals.with_details(best, even).join(ours.select("arxiv_id"), "arxiv_id", "left_semi")
    return core.merged(old, new, "arxiv_id", {c: signals.SIGNAL_POLICIES[c] for c in ("upvotes", "github_stars")})


@query("""WITH e AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events), d AS (SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), max(day) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM e)
  SELECT CAST(day AS VARCHAR) AS day, count(user_id) FILTER (WHERE user_id % 31 <> 0) AS entries, count(user_id) FILTER (WHERE user_id % 31 = 0) AS broken, count(user_id) = 0 AS missing FROM d LEFT JOIN (SELECT * FROM e WHERE day(day) % 5 <> 0) USING (day) GROUP BY 1""")
def feed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored feed read over its days and those after them: each fifth day of a month was never stored, some lines are cut."""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "user_id").distinct()
    line = F.when(F.col("user_id") % 31 == 0, '[{"paper": {"id"').otherwise(F.format_string('[{"paper": {"id": "26.%d"}}]', "user_id"))
    folder = f"{shared_folder(spark)}/feeds/{unused('days')}"
    e.where(F.day("day") % 5 != 0).select("day", line.alias("value")).repartition("day").write.partitionBy("day").text(folder)
    first, last = e.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    lines = raw_files.feed_lines(spark, folder, signals.feed_days(first, last, F.date_add(F.lit(last).cast("date"), 3)))
    counted = lines.groupBy("day").agg(F.count("body").alias("n"), F.count_if(F.col("error") == raw_files.BROKEN).alias("broken"), F.max(F.col("error") == raw_files.MISSING).alias("m"))
    entries = signals.feed_entries(lines.where("body IS NOT NULL").select("day", "body")).groupBy("day").agg(F.count("arxiv_id").alias("entries"))
    return counted.join(entries, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("entries", F.lit(0)).alias("entries"), "broken", F.coalesce("m", F.lit(False)).alias("missing"))


@query("SELECT c_custkey, coalesce(nullif(concat_ws('; ', CASE WHEN c_custkey % 4 <> 0 THEN 'final_score=' || (c_custkey % 10) END, CASE WHEN c_custkey % 5 = 0 THEN 'org_boost=0.5' END, CASE WHEN c_custkey % 3 = 0 THEN 'notable_org=' || c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN 'audiences=a,b' END), ''), 'no stored score components') AS why, CASE WHEN c_custkey % 4 = 0 THEN 'no final_score (not in quality/adjudication slice)' || CASE WHEN c_custkey % 8 = 0 THEN '; screen_score=' || (c_custkey % 7) ELSE '' END END AS why_not FROM customer")
def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    final, screen = F.when(n % 4 != 0, n % 10), F.when(n % 8 == 0, n % 7)
    high = signals.why_high(final, F.lit(None).cast("int"), F.when(n % 5 == 0, 0.5).otherwise(0.0), F.when(n % 3 == 0, F.col("c_mktsegment")).otherwise(""), F.when(n % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")), F.lit(None).cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", high.alias("why"), F.when(final.isNull(), signals.why_low(final, screen, high)).alias("why_not"))


@query("SELECT c_nationkey, CASE WHEN both_n = 0 OR gap IS NULL THEN 'weak signal' WHEN abs(gap) < 0.3 AND both_n < greatest(20, floor(0.15 * (both_n + ours_n))) THEN 'no incremental signal' WHEN gap >= 0.3 THEN 'HF adds useful signal' ELSE 'weak signal' END AS recommendation FROM (SELECT c_nationkey, count(*) FILTER (WHERE c_custkey % 3 = 0) AS both_n, count(*) FILTER (WHERE c_custkey % 3 <> 0) AS ours_n, round(avg(c_acctbal / 1000) FILTER (WHERE c_custkey % 3 = 0), 3) - round(avg(c_acctbal / 1000) FILTER (WHERE c_custkey % 3 <> 0), 3) AS gap FROM customer GROUP BY 1)")
def signal_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.col("c_custkey") % 3 == 0
    g = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count_if(both).alias("b"), F.count_if(~both).alias("o"), F.round(F.avg(F.when(both, F.col("c_acctbal") / 1000)), 3).alias("mb"), F.round(F.avg(F.when(~both, F.col("c_acctbal") / 1000)), 3).alias("mo"))
    return g.select("c_nationkey", signals.recommendation(F.col("b"), F.col("o"), F.col("mb"), F.col("mo")).alias("recommendation"))


# Golden labels

@query("""WITH l AS (SELECT l.doc_id, 's' || (l.doc_id % 2) AS name, CASE WHEN l.doc_id % 3 = 0 THEN 'llm' ELSE 'manual' END AS source, CASE WHEN l.doc_id % 7 = 0 THEN '' ELSE d.lang END AS domain, d.source AS src FROM labels l JOIN documents d USING (doc_id)),
  r AS (SELECT name, source, domain, doc_id % 5 = 0 AS gone, true AS is_domain, doc_id % 4 = 1 AS other, doc_id FROM l UNION ALL SELECT name, source, domain, doc_id % 11 = 0, false, doc_id % 6 = 1, doc_id FROM l WHERE doc_id % 2 = 0)
  SELECT name, source, count(*) AS n, count(*) FILTER (WHERE gone) AS missing, count(*) FILTER (WHERE NOT gone AND is_domain AND domain <> '') AS domain_compared, count(*) FILTER (WHERE NOT gone AND is_domain AND domain <> '' AND NOT other) AS domain_match,
    count(*) FILTER (WHERE NOT gone AND NOT is_domain) AS audience_compared, count(*) FILTER (WHERE NOT gone AND NOT is_domain AND NOT other) AS audience_exact,
    round(count(*) FILTER (WHERE NOT gone AND is_domain AND domain <> '' AND NOT other) / nullif(count(*) FILTER (WHERE NOT gone AND is_domain AND domain <> ''), 0), 4) AS domain_accuracy
  FROM r GROUP BY GROUPING SETS ((name, source), (name))""")
def golden_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    l, n = table(spark, sf_dir, "labels").select("doc_id").join(d, "doc_id"), F.col("doc_id")  # noqa: E741
    label = F.struct(F.when(n % 2 == 0, F.array(F.lit("B"), F.lit("a"))).alias("audiences"), F.when(n % 7 == 0, "").otherwise(F.col("lang")).alias("domain"))
    items = l.select(F.concat(F.lit("s"), (n % 2).cast("string")).alias("name"), F.lit("v1").alias("version"), F.lit("audience_domain").alias("task_type"), n.alias("content_item_id"), label.alias("label_json"), F.when(n % 3 == 0, "llm").alias("gold_label_source"))
    labels = golden.golden_labels(items, d.select(n.alias("content_item_id"))).select("*", F.col("label_json.domain").alias("domain"), F.col("label_json.audiences").alias("audiences"))
    pred = lambda keep, task, domain, audiences: d.where(keep).select(n.alias("content_item_id"), F.lit(task).alias("task_type"), domain.alias("domain"), audiences.alias("audiences"))
    domains = pred(n % 5 != 0, "domain", F.when(n % 4 == 1, "zz").otherwise(F.upper("lang")), F.lit(None).cast("array<string>"))
    audiences = pred(n % 11 != 0, "audience", F.lit(None).cast("string"), F.when(n % 6 == 1, F.array(F.lit("c"))).otherwise(F.array(F.lit("A"), F.lit("b"))))
    return golden.agreement(labels, domains.unionByName(audiences))


@query(f"SELECT l_orderkey, string_agg(DISTINCT name, ',' ORDER BY name) AS organisations FROM (SELECT l_orderkey, lower(coalesce(CASE WHEN l_suppkey % 3 <> 0 THEN s_name END, 'Raw ' || l_returnflag)) AS name FROM {EVIDENCE}) GROUP BY 1")
def predicted_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence(spark, sf_dir).select("l_orderkey", F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("org_id"), F.concat(F.lit("Raw "), "l_returnflag").alias("raw_affiliation"))
    o = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("org_id"), F.col("s_name").alias("canonical_name"))
    return golden.predicted_organisations(e, o, "l_orderkey").select("l_orderkey", F.array_join("organisations", ",").alias("organisations"))


# Organisations

def known(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as organisations: some with a ROR or OpenAlex id, aliases by nation, domains by key."""
    s, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    o = s.select(n.alias("org_id"), F.col("s_name").alias("canonical_name"), F.when(n % 4 == 0, F.concat(F.lit("r"), n.cast("string"))).alias("ror_id"), F.when(n % 4 == 1, F.concat(F.lit("o"), n.cast("string"))).alias("openalex_id"), F.lit(0).alias("priority"))
    alias = F.array(F.struct(F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("alias"), F.lit("name").alias("alias_type")), F.struct(F.concat(F.lit("S"), n.cast("string"), F.lit(".edu")).alias("alias"), F.lit("domain").alias("alias_type")))
    return o, s.select(n.alias("org_id"), F.explode(alias).alias("a")).select("org_id", "a.*")


@query("""WITH m AS (SELECT c_custkey, c_custkey % 5 AS k, c_custkey % (SELECT max(s_suppkey) + 20 FROM supplier) AS s, c_nationkey AS nat FROM customer), f AS (
    SELECT c_custkey, 0 AS tier, s_suppkey AS org_id, 'ror' AS how FROM m JOIN supplier ON k = 0 AND s_suppkey = s AND s_suppkey % 4 = 0
    UNION ALL SELECT c_custkey, 1, s_suppkey, 'openalex' FROM m JOIN supplier ON k = 1 AND s_suppkey = s AND s_suppkey % 4 = 1
    UNION ALL SELECT c_custkey, 2, s_suppkey, 'name' FROM m JOIN supplier ON k <= 2 AND s_suppkey = s
    UNION ALL SELECT c_custkey, 3, min(s_suppkey), 'alias' FROM m JOIN supplier ON k = 3 AND s_nationkey = nat GROUP BY c_custkey)
  SELECT m.c_custkey, org_id, coalesce(how, 'created') AS matched_by FROM m LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY tier, org_id) AS r FROM f) WHERE r = 1) USING (c_custkey)""")
def organisation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, aliases = known(spark, sf_dir)
    top = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey").alias("top"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(top)).withColumn("s", F.col("c_custkey") % (F.col("top") + 20)).withColumn("k", F.col("c_custkey") % 5)
    pad = F.lpad(F.col("s").cast("string"), 9, "0")
    name = F.when(F.col("k") <= 2, F.concat(F.lit(" supplier#"), pad)).when(F.col("k") == 3, F.concat(F.lit("NATION "), F.col("c_nationkey").cast("string"))).otherwise(F.lit("An Unknown Institute"))
    m = c.select("c_custkey", name.alias("name"), F.when(F.col("k") == 0, F.concat(F.lit("r"), F.col("s").cast("string"))).alias("ror_id"), F.when(F.col("k") == 1, F.concat(F.lit("o"), F.col("s").cast("string"))).alias("openalex_id"))
    found = organisations.resolved(m, o, aliases, "c_custkey")
    return found.select("c_custkey", F.when(F.col("matched_by") != "created", F.col("org_id")).alias("org_id"), "matched_by")


#: Customers as mentions: chains of shared ROR ids, OpenAlex ids and names inside each dozen, some of which name a supplier.
MENTIONS = """(SELECT c_custkey, CASE WHEN c_custkey % 12 NOT IN (0, 7) AND c_custkey % 2 = 0 THEN 'q' || (c_custkey // 4) END AS ror, CASE WHEN c_custkey % 12 NOT IN (0, 7) AND c_custkey % 3 = 0 THEN 'w' || (c_custkey // 6) END AS oa,
  CASE c_custkey % 60 WHEN 5 THEN 'supplier#' || lpad(CAST(c_custkey % 7 + 1 AS VARCHAR), 9, '0') WHEN 10 THEN 'supplier#' || lpad(CAST(c_custkey % 5 + 1 AS VARCHAR), 9, '0') ELSE 'lab ' || (c_custkey // 12) || '-' || (c_custkey % 12 // 3) END AS name FROM customer)"""


def mentioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    some = ~(n % 12).isin(0, 7)
    part = lambda by: F.floor(n / by).cast("string")
    supplier = lambda by: F.concat(F.lit("Supplier#"), F.lpad((n % by + 1).cast("string"), 9, "0"))
    name = F.when(n % 60 == 5, supplier(7)).when(n % 60 == 10, supplier(5)).otherwise(F.concat(F.lit(" Lab "), part(12), F.lit("-"), F.floor(n % 12 / 3).cast("string")))
    return table(spark, sf_dir, "customer").select(n, name.alias("name"), F.when(some & (n % 2 == 0), F.concat(F.lit("q"), part(4))).alias("ror_id"), F.when(some & (n % 3 == 0), F.concat(F.lit("w"), part(6))).alias("openalex_id"))


@query(f"""WITH RECURSIVE m AS MATERIALIZED {MENTIONS},
  direct AS (SELECT c_custkey, s_suppkey AS org_id, s_suppkey % 4 <> 0 AS no_ror, s_suppkey % 4 <> 1 AS no_oa FROM m JOIN supplier ON name = lower(s_name)),
  keys AS (SELECT c_custkey, 'r' || ror AS k, 'ror' AS kind FROM m WHERE ror IS NOT NULL UNION ALL SELECT c_custkey, 'o' || oa, 'oa' FROM m WHERE oa IS NOT NULL UNION ALL SELECT c_custkey, 'n' || name, 'name' FROM m),
  fresh AS MATERIALIZED (SELECT * FROM keys WHERE c_custkey NOT IN (SELECT c_custkey FROM direct)),
  link AS MATERIALIZED (SELECT DISTINCT a.c_custkey AS a, b.c_custkey AS b FROM fresh a JOIN fresh b USING (k)),
  reach AS (SELECT DISTINCT c_custkey AS a, c_custkey AS b FROM fresh UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
  class AS (SELECT a AS c_custkey, min(b) AS first FROM reach GROUP BY a),
  taught AS (SELECT k, min(org_id) AS org_id FROM keys JOIN direct USING (c_custkey) WHERE kind = 'name' OR (kind = 'ror' AND no_ror) OR (kind = 'oa' AND no_oa) GROUP BY k),
  linked AS (SELECT first, min(org_id) AS org_id FROM class JOIN fresh USING (c_custkey) JOIN taught USING (k) GROUP BY first)
  SELECT c_custkey, org_id, 'name' AS matched_by, CAST(NULL AS BIGINT) AS first_mention FROM direct
  UNION ALL SELECT c_custkey, org_id, CASE WHEN org_id IS NULL THEN 'created' ELSE 'linked' END, CASE WHEN org_id IS NULL THEN first END FROM class LEFT JOIN linked USING (first)""")
def organisation_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New organisations are told by their first mention: their ids are hashes."""
    o, aliases = known(spark, sf_dir)
    found = organisations.resolved(mentioned(spark, sf_dir), o, aliases, "c_custkey")
    new = F.col("matched_by") == "created"
    first = found.where(new).groupBy("org_id").agg(F.min("c_custkey").alias("first_mention"))
    return found.join(first, "org_id", "left").select("c_custkey", F.when(~new, F.col("org_id")).alias("org_id"), "matched_by", "first_mention")


@query(f"""WITH w AS (SELECT c_nationkey AS entry, 'Nation Body ' || c_nationkey AS name, c_nationkey % 4 AS priority, 'nb' || c_nationkey || '.org' AS domain FROM customer GROUP BY ALL),
  k AS (SELECT entry, CASE WHEN entry % 5 = 0 THEN (SELECT min(s_suppkey) FROM supplier WHERE s_suppkey % 4 = 0 AND s_suppkey > entry) END AS org_id, name, priority, domain FROM w),
  listed AS (SELECT org_id, arg_min(priority, entry) AS priority FROM k WHERE org_id IS NOT NULL GROUP BY org_id)
  SELECT s_name AS canonical_name, coalesce(priority, 0) AS priority, priority IS NOT NULL AS is_org_of_interest, 2 + coalesce((SELECT 3 * count(*) FROM k WHERE k.org_id = s_suppkey), 0) AS n_aliases FROM supplier LEFT JOIN listed ON listed.org_id = s_suppkey
  UNION ALL SELECT name, priority, true, 3 FROM k WHERE org_id IS NULL""")
def seeded_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth nation's body is known by the ROR id of a supplier; the others are new organisations."""
    o, aliases = known(spark, sf_dir)
    n = F.col("c_nationkey")
    rors = o.where("ror_id IS NOT NULL").select("org_id", F.col("ror_id").alias("r"))
    w = table(spark, sf_dir, "customer").select(n.cast("int").alias("entry")).distinct()
    first = w.where("entry % 5 = 0").join(rors, F.col("org_id") > F.col("entry")).groupBy("entry").agg(F.min_by("r", "org_id").alias("ror_id"))
    entry = F.col("entry").cast("string")
    w = w.join(first, "entry", "left").select("entry", F.concat(F.lit("Nation Body "), entry).alias("name"), (F.col("entry") % 4).alias("priority"), "ror_id", F.lit(None).cast("string").alias("openalex_id"), F.array(F.concat(F.lit("Body of "), entry)).alias("aliases"), F.array(F.concat(F.lit("@NB"), entry, F.lit(".org."))).alias("domains"))
    orgs, names = organisations.seeded(w, o, aliases)
    return orgs.join(names.groupBy("org_id").agg(F.count("*").alias("n_aliases")), "org_id").select("canonical_name", "priority", "is_org_of_interest", "n_aliases")


@query("""SELECT s_suppkey AS org_id, CASE WHEN s_suppkey = 8 THEN 1 WHEN s_suppkey = 5 THEN 3 WHEN s_nationkey = 3 THEN 2 WHEN s_suppkey = 7 THEN 1 ELSE 0 END AS priority, s_suppkey IN (8, 5, 7) OR s_nationkey = 3 AS is_org_of_interest FROM supplier""")
def watched_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, aliases = known(spark, sf_dir)
    w = spark.sql("SELECT * FROM VALUES (0, 'x', 1, 'r8', NULL, array(), array()), (1, 'y', 3, NULL, 'o5', NULL, array('S8.edu')), (2, 'z', 2, NULL, NULL, array('nation  3', 'Nation 3!'), array()), (3, 'z', 1, '', NULL, array(), array('s7.EDU')) AS w(entry, name, priority, ror_id, openalex_id, aliases, domains)")
    return organisations.watched(o, aliases, w).select("org_id", "priority", "is_org_of_interest")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'cs.s' || (c_custkey % 9 + 1) || '.edu' WHEN 2 THEN 's' || (c_custkey % 9 + 1) || '.edu' END AS domain, CAST(c_custkey % 9 + 1 AS BIGINT) AS org_id FROM customer WHERE c_custkey % 4 IN (0, 2)")
def organisation_of_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, aliases = known(spark, sf_dir)
    n = F.col("c_custkey")
    own = F.concat(F.lit("s"), (n % 9 + 1).cast("string"), F.lit(".edu"))
    domain = F.when(n % 4 == 0, F.concat(F.lit("cs."), own)).when(n % 4 == 1, "gmail.com").when(n % 4 == 2, own).otherwise("nowhere.example")
    return organisations.of_domains(table(spark, sf_dir, "customer").select(n, domain.alias("domain")), aliases, "c_custkey", "domain")


# Ledger

@query("SELECT event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS attempt FROM events")
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.attempts(table(spark, sf_dir, "events"), "event_type", "user_id", "ts", "event_id").select("event_id", "attempt")


@query("SELECT user_id, event_type AS last_type, epoch_us(ts) // 1000 - epoch_us(first) // 1000 AS duration_ms FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, min(ts) OVER (PARTITION BY user_id) AS first FROM events) WHERE k = 1")
def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.run_state(table(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", F.col("event_type").alias("last_type"), "duration_ms")


@query("""SELECT event_type, count(*) AS calls, CAST(sum(event_id % 100) AS BIGINT) AS tokens_in, round(sum((event_id % 7) / 100.0), 6) AS cost, CAST(sum(event_id % 15) AS BIGINT) AS ok, CAST(sum(CASE WHEN event_type = 'view' THEN 0 WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CASE WHEN event_type = 'view' OR count(*) FILTER (WHERE event_id % 50 = 0) = 0 THEN 'succeeded' ELSE 'partial' END AS status, CAST(least(20, count(*) FILTER (WHERE event_id % 50 = 0)) AS INT) AS errors_shown FROM events GROUP BY 1""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    failed = F.when(F.col("event_type") == "view", 0).when(n % 50 == 0, 1).otherwise(0).cast("bigint")
    b = table(spark, sf_dir, "events").select("event_type", n.alias("batch"), F.lit(1).cast("bigint").alias("calls"), (n % 100).alias("tokens_in"), (n % 10).alias("tokens_out"), ((n % 7) / 100).alias("cost"), (n % 15).alias("ok"), failed.alias("failed"), F.when(n % 50 == 0, F.concat(F.lit("e"), n.cast("string"))).alias("error"))
    return ledger.run_totals(b, "event_type").select("event_type", "calls", "tokens_in", "cost", "ok", "failed", "status", F.size("errors").alias("errors_shown"))


@query("SELECT 'o_orderstatus' AS name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2")
def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.histogram(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT papers, calls, CAST(body + calls * 500 AS BIGINT) AS tokens_in, papers * 40 AS tokens_out, round((body + calls * 500) / 1e6 * 0.15 + papers * 40 / 1e6 * 0.5, 6) AS cost FROM (SELECT count(*) AS papers, CAST(ceil(count(*) / 15) AS BIGINT) AS calls, CAST(sum(length(coalesce(text, '')) // 4) AS BIGINT) AS body FROM documents)")
def projected_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.projected_cost(table(spark, sf_dir, "documents"), "text", 15, 2000, 40, 0.15, 0.5)


@query("SELECT CAST(o_orderkey AS BIGINT) AS id FROM orders o WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0) AND o_orderkey % 4 <> 3")
def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows not complete: the last event of a window decides."""
    o, n = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    w = o.where(n % 4 != 3).select(F.lit("arxiv").alias("source"), F.lit("cs").alias("set_spec"), n.cast("string").alias("window_from"), n.cast("string").alias("window_until"), n.alias("id"))
    done = w.where(F.col("id") % 3 == 0).withColumn("status", F.lit("COMPLETE")).withColumn("at", F.lit(1))
    again = w.where(F.col("id") % 5 == 0).withColumn("status", F.lit("RUNNING")).withColumn("at", F.lit(2))
    return ledger.open_windows(w, done.unionByName(again)).select("id")


# Affiliations

PLACES = ("Affiliation: Department of Tides Westmark University, Port Ellen, QX", "Email: {a, b}@s3.edu", "Authors: Ada Jones", "Thanks: the kind people we met", "Institute of Applied Things for Everyone; Blue Heron", "Submitted on 3 May", "corresponding author")


@query("""SELECT c_custkey, line, candidates FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'Department of Tides Westmark University, Port Ellen, QX' WHEN 4 THEN 'Institute of Applied Things for Everyone; Blue Heron' END AS line,
  CASE c_custkey % 7 WHEN 0 THEN 'Westmark University|Port Ellen' WHEN 4 THEN 'Institute of Applied Things for Everyone|Blue Heron' END AS candidates FROM customer) WHERE line IS NOT NULL""")
def affiliation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = by_rest("c_custkey", 7, *PLACES)
    p = table(spark, sf_dir, "customer").select("c_custkey", F.array(line, F.upper(line)).alias("affiliation_text"))
    return affiliation.affiliation_evidence(p, "c_custkey").select("c_custkey", "line", F.array_join("candidates", "|").alias("candidates"))


#: Confidence and scope of paper-level evidence: a quarter off for several authors, ties in the third place going down.
def _paper_level(one: str, several: str) -> str:
    return f"CASE n WHEN 1 THEN {one} ELSE {several} END::DOUBLE AS confidence, CASE n WHEN 1 THEN 'author_specific' ELSE 'paper_level_unassigned' END AS scope"


@query(f"""WITH a AS (SELECT l_orderkey, count(*) AS n, bool_or(l_linenumber = 1) AS has_one FROM lineitem GROUP BY 1),
  p AS (SELECT o_orderkey, CAST(o_orderkey % 9 + 1 AS BIGINT) AS s, CAST(o_orderkey % 7 + 1 AS BIGINT) AS t, n, has_one FROM orders JOIN a ON l_orderkey = o_orderkey),
  e AS (
    SELECT o_orderkey, s AS org_id, 'explicit_paper_affiliation' AS evidence_type, 'Supplier#' || lpad(CAST(s AS VARCHAR), 9, '0') || ' Company' AS evidence_value, {_paper_level("0.85", "0.637")} FROM p WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, s, 'email_domain', CASE o_orderkey % 3 WHEN 0 THEN 'cs.s' ELSE 's' END || s || '.edu', {_paper_level("0.75", "0.562")} FROM p WHERE o_orderkey % 3 = 1 OR (o_orderkey % 3 = 0 AND NOT has_one)
    UNION ALL SELECT o_orderkey, t, 'email_domain', 's' || t || '.edu', {_paper_level("0.75", "0.562")} FROM p WHERE o_orderkey % 2 = 0 AND NOT (o_orderkey % 3 = 1 AND s = t)
    UNION ALL SELECT o_orderkey, NULL, 'explicit_paper_affiliation', 'Northern Institute of Quiet Studies', CASE n WHEN 1 THEN 0.5 ELSE 0.375 END, 'unresolved_raw' FROM p WHERE o_orderkey % 4 = 1)
  SELECT o_orderkey, l_linenumber AS author_position, org_id, evidence_type, evidence_value, confidence, scope FROM e JOIN lineitem ON l_orderkey = o_orderkey
  UNION SELECT o_orderkey, 1, s, 'email_domain', 'cs.s' || s || '.edu', 0.9, 'author_specific' FROM p WHERE o_orderkey % 3 = 0 AND has_one""")
def affiliation_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known names, two mails of one domain (the first decides), groups of addresses, lines that nobody knows."""
    o, aliases = known(spark, sf_dir)
    n = F.col("o_orderkey")
    s, t = ((n % k + 1).cast("string") for k in (9, 7))
    line = F.concat(F.lit("Affiliation: Dept. 7 | Supplier#"), F.lpad(s, 9, "0"), F.lit(" Company"))
    lines = F.when(n % 2 == 0, F.array(line, F.concat(F.lit("E-mail: {a, b}@s"), t, F.lit(".edu")))).when(n % 4 == 1, F.array(F.lit("Northern Institute of Quiet Studies"), F.lit("northern institute of quiet studies")))
    at = lambda name: F.concat(F.lit(name), s, F.lit(".edu"))
    mails = F.when(n % 3 == 0, F.array(at("line.one@cs.s"), at("else.where@cs.s"))).when(n % 3 == 1, F.array(at("x@s"))).otherwise(F.array(F.lit("ada@gmail.com")))
    p = table(spark, sf_dir, "orders").select(n, lines.alias("affiliation_text"), mails.alias("emails"))
    found = affiliation_stage.affiliation_cascade(p, line_authors(spark, sf_dir), o, with_company(o, aliases), "o_orderkey", mode="fast")
    return found.rows.select("o_orderkey", "author_position", "org_id", "evidence_type", "evidence_value", "confidence", "scope")


def with_company(o: DataFrame, aliases: DataFrame) -> DataFrame:
    return aliases.unionByName(o.select("org_id", F.concat("canonical_name", F.lit(" Company")).alias("alias"), F.lit("name").alias("alias_type")))


def line_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem")
    return a.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("author_position"), F.when(F.col("l_linenumber") == 1, "Line One").otherwise("Else Where").alias("normalized_name"))


@query(f"""WITH a AS (SELECT l_orderkey, count(*) AS n, bool_or(l_linenumber = 1) AS has_one FROM lineitem GROUP BY 1),
  p AS (SELECT o_orderkey, n, has_one, o_orderkey % 4 AS k, o_orderkey % 8 = 0 AS early FROM orders JOIN a ON l_orderkey = o_orderkey),
  e AS (
    SELECT o_orderkey, 'Beta Institute of Rivers' AS organisation, 'ror_canonical_match' AS evidence_type, 'Beta Institute of Rivers' AS evidence_value, {_paper_level("0.8", "0.6")} FROM p WHERE k = 0
    UNION ALL SELECT o_orderkey, 'Beta Institute of Rivers', 'explicit_paper_affiliation', 'Beta Institute of Rivers', {_paper_level("0.85", "0.637")} FROM p WHERE k = 0
    UNION ALL SELECT o_orderkey, 'Beta Institute of Rivers', 'email_domain', 'beta.example.org', {_paper_level("0.75", "0.562")} FROM p WHERE k = 0 AND o_orderkey % 16 = 0
    UNION ALL SELECT o_orderkey, 'Delta College of Lakes', 'ror_canonical_match', 'Delta College of Lakes', {_paper_level("0.85", "0.637")} FROM p WHERE k = 0 AND early
    UNION ALL SELECT o_orderkey, 'Delta College of Lakes', 'explicit_paper_affiliation', 'Delta College of Lakes', {_paper_level("0.85", "0.637")} FROM p WHERE k = 0 AND early
    UNION ALL SELECT o_orderkey, NULL, 'explicit_paper_affiliation', 'Gamma College of Lakes', CASE n WHEN 1 THEN 0.5 ELSE 0.375 END, 'unresolved_raw' FROM p WHERE k = 0 AND NOT early
    UNION ALL SELECT o_orderkey, 'Works University', 'openalex_paper_specific', 'Works University', {_paper_level("0.8", "0.6")} FROM p WHERE k = 1 AND o_orderkey % 8 = 1 AND NOT has_one
    UNION ALL SELECT o_orderkey, 'Works University', 'openalex_paper_specific', 'Works University', {_paper_level("0.6", "0.45")} FROM p WHERE k = 1 AND o_orderkey % 8 = 5
    UNION ALL SELECT o_orderkey, 'Supplier#000000003', 'explicit_paper_affiliation', 'Supplier#000000003 Company', {_paper_level("0.85", "0.637")} FROM p WHERE k = 2)
  SELECT o_orderkey, l_linenumber AS author_position, organisation, evidence_type, evidence_value, confidence, scope FROM e JOIN lineitem ON l_orderkey = o_orderkey
  UNION SELECT o_orderkey, 1, 'Works University', 'openalex_paper_specific', 'Works University', 0.85, 'author_specific' FROM p WHERE k = 1 AND o_orderkey % 8 = 1 AND has_one""")
def affiliation_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tiers: at most three look-ups a paper, works where nothing else is known, domains that a look-up taught."""
    o, aliases = known(spark, sf_dir)
    n = F.col("o_orderkey")
    first = F.when(n % 8 == 0, "Beta Institute of Rivers; Alpha Institute of Rivers").otherwise("Alpha Institute of Rivers; Beta Institute of Rivers")
    lines = F.when(n % 4 == 0, F.array(first, F.lit("Gamma College of Lakes; Delta College of Lakes"))).when(n % 4 == 2, F.array(F.lit("Supplier#000000003 Company")))
    mails = F.when(n % 16 == 0, F.array(F.lit("x@beta.example.org")))
    orders = table(spark, sf_dir, "orders")
    p = orders.select(n, lines.alias("affiliation_text"), mails.alias("emails"))
    registry = spark.sql("""SELECT * FROM VALUES ('Beta Institute of Rivers', 0, 'Gamma', 'z90', array(), array(), array(), 0.9D), ('Beta Institute of Rivers', 1, 'Beta Institute of Rivers', 'z91', array('BIR'), array(), array('beta.example.org'), 0.8D),
      ('Delta College of Lakes', 0, 'Delta College of Lakes', 'z92', array(), array(), array(), 1.0D), ('Gamma College of Lakes', 0, 'Gamma College of Lakes', 'z93', array(), array(), array(), 0.4D)
      AS r(query, place, org_name, ror_id, aliases, acronyms, domains, score)""")
    known_author, none = n % 8 == 1, F.array().cast("array<string>")
    works = orders.where(n % 4 != 0).select(n, F.when(known_author, "One, Line").otherwise("Nobody Atall").alias("author_name"), F.lit("Works University").alias("institution_name"), F.when(n % 4 == 1, "w1").alias("ror_id"), F.lit(None).cast("string").alias("openalex_id"), F.when(known_author, F.array(F.lit("Dept, Works University"))).otherwise(none).alias("raw_affiliations"))
    found = affiliation_stage.affiliation_cascade(p, line_authors(spark, sf_dir), o, with_company(o, aliases), "o_orderkey", registry, works)
    names = o.select("org_id", "canonical_name").unionByName(found.created.select("org_id", "canonical_name")).withColumnRenamed("canonical_name", "organisation")
    return found.rows.join(F.broadcast(names), "org_id", "left").select("o_orderkey", "author_position", "organisation", "evidence_type", "evidence_value", "confidence", "scope")


@query("SELECT s_suppkey, CAST(org_id AS BIGINT) AS org_id FROM (SELECT s_suppkey, s_nationkey FROM supplier) s JOIN (SELECT s_nationkey, min(s_suppkey) AS org_id FROM supplier GROUP BY 1) USING (s_nationkey)")
def alias_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, aliases = known(spark, sf_dir)
    names = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("nAtIoN "), F.col("s_nationkey").cast("string")).alias("name"))
    return core.alias_matches(names, aliases, "s_suppkey", "name", "name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 7 END ELSE c_nationkey END AS upvotes, c_mktsegment AS segment FROM customer")
def propagated_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("upvotes"), F.col("c_mktsegment").alias("segment"))
    return core.propagated(c, c.where("c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, 7).alias("upvotes")), "c_custkey", ["upvotes"])


@query(f"SELECT doc_id, CAST(strpos(names, t.name) AS BIGINT) > 0 AND t.name = topics[1].name AS is_primary, t.topic_id, CAST(least(1.0, score / 10) AS DOUBLE) AS confidence FROM (SELECT *, array_to_string([x.name FOR x IN topics[1:4]], '|') AS names FROM {RELEVANCE}) JOIN (SELECT 1 AS topic_id, 'AI agents' AS name UNION ALL SELECT 2, 'AI evaluation' UNION ALL SELECT 3, 'Retrieval / RAG') t ON list_contains([x.name FOR x IN topics[1:4]], t.name)")
def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = spark.sql("SELECT * FROM VALUES (1, 'AI agents'), (2, 'AI evaluation'), (3, 'Retrieval / RAG') AS t(topic_id, name)")
    return relevance.topic_rows(relevance.score_relevance(papers(spark, sf_dir)), topics, "doc_id")


@query(f"SELECT doc_id, coalesce({rest_sql('doc_id', 7, *TITLES)}, '') AS title, coalesce({rest_sql('doc_id', 4, *CATEGORIES)} || ', x.Y', '') AS categories, left(coalesce(text, ''), 2000) AS abstract FROM documents")
def blinded_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relevance.blinded(papers(spark, sf_dir), "doc_id")


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey % 4 = 0 OR o_orderkey % 5 = 0) AND o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def affiliation_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    p = table(spark, sf_dir, "orders").select(n, F.when(n % 4 == 0, F.array(F.lit("Affiliation: X"))).when(n % 4 == 1, F.array().cast("array<string>")).alias("affiliation_text"), F.when(n % 5 == 0, "10.1/x").when(n % 5 == 1, "").alias("doi"))
    return relevance.affiliation_candidates(p, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey")


@query("SELECT event_type AS request, props AS payload FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, props DESC) AS k FROM events) WHERE k = 1")
def newest_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("request"), "ts", F.col("props").alias("payload"))
    return ledger.newest_responses(e, "request", "ts").select("request", "payload")


@query("SELECT event_id, substr(sha256('{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}'), 1, 16) AS request_key, upper(event_type) || '_' || event_id || '.json' AS file FROM events")
def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    return table(spark, sf_dir, "events").select("event_id", ledger.request_key(request).alias("request_key"), ledger.file_name(F.concat(F.upper("event_type"), F.lit(" / "), F.col("event_id").cast("string"), F.lit(".json"))).alias("file"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '2026-02-0' || (o_orderkey % 9 + 1) END AS day FROM orders")
def dirty_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    said = F.when(n % 6 == 0, "").when(n % 6 == 3, "not yet").otherwise(F.concat(F.lit(" 2026-02-0"), (n % 9 + 1).cast("string"), F.lit("T01:02:03Z")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(text.utc_time(said), "yyyy-MM-dd").alias("day"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Pekár ' || c_custkey WHEN 1 THEN 'naïve – ' || c_custkey ELSE '张伟 ' || c_custkey END AS name FROM customer")
def repaired_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.concat(by_rest("c_custkey", 3, "PekÃ¡r ", "naÃ¯ve â€“ ", "张伟 "), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.repaired(broken).alias("name"))


@query("SELECT '26.' || c_custkey AS arxiv_id FROM customer WHERE c_custkey % 3 = 0 ORDER BY '26.' || c_custkey LIMIT 40")
def known_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("26."), F.col("c_custkey").cast("string")).alias("arxiv_id"), "c_custkey")
    return signals.known_papers(c.select("arxiv_id"), c.where("c_custkey % 3 = 0"), 40)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS first_author FROM customer")
def structured_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, none = F.col("c_custkey"), F.array().cast("array<string>")
    rich = F.when(n % 3 == 0, F.array("c_name")).when(n % 3 == 1, none)
    raw = F.when(n % 2 == 0, F.array("c_mktsegment")).otherwise(none)
    return table(spark, sf_dir, "customer").select("c_custkey", F.get(authors.structured_first(rich, raw), F.lit(0)).alias("first_author"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || '|x@y.z' WHEN 1 THEN c_name WHEN 2 THEN '' ELSE 'é' END AS said FROM customer")
def text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, name = F.col("c_custkey") % 4, F.col("c_name")
    raw = F.when(n == 0, F.concat(F.lit('[{"affiliation": " ", "text": "'), name, F.lit('"}, 3, null, {"email": "x@y.z"}, {"z": "q"}]'))).when(n == 1, name).when(n == 2, "[]").otherwise('"é"')
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(authors.text_values(raw), "|").alias("said"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'cs.AI|cs.LG' WHEN 1 THEN 'cs.CL' END AS categories FROM customer")
def category_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(ingest.categories_of(by_rest("c_custkey", 3, '["cs.AI", "cs.LG"]', "cs.CL", None)), "|").alias("categories"))


@query("""WITH o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'doi' || c_custkey END AS doi, c_custkey % 5 AS a FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, 'new' || c_custkey AS doi, c_custkey % 7 AS b FROM customer WHERE c_custkey % 4 <> 0)
  SELECT coalesce(o.k, n.k) AS k, coalesce(nullif(o.doi, ''), n.doi) AS doi, '{' || concat_ws(',', CASE WHEN o.k IS NOT NULL THEN '"a":"' || a || '"' END, CASE WHEN n.k IS NOT NULL THEN '"b":"' || b || '"' WHEN o.k IS NOT NULL THEN '"b":"old"' END) || '}' AS meta FROM o FULL JOIN n ON o.k = n.k""")
def metadata_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    meta = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)).alias("meta")
    old = c.where(k % 3 != 0).select(k.alias("k"), F.when(k % 2 == 0, "").otherwise(F.concat(F.lit("doi"), k.cast("string"))).alias("doi"), meta('{"a": "', k % 5, '", "b": "old"}'))
    new = c.where(k % 4 != 0).select(k.alias("k"), F.concat(F.lit("new"), k.cast("string")).alias("doi"), meta('{"b": "', k % 7, '"}'))
    return ingest.gaps_filled(old, new, "k", ["doi"], "meta").select("k", "doi", "meta")


@query(f"SELECT 'rejects' AS path, count(*) FILTER (WHERE score < 5) AS records FROM {RELEVANCE}")
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relevance.rejected_records(relevance.score_relevance(papers(spark, sf_dir)), "doc_id", "v1", "funnel")
    return manifest_of(r, "rejects").select("path", "records")


@query("SELECT 's' || (doc_id % 3) AS name, CASE WHEN doc_id % 3 = 1 THEN doc_id + 1000000 ELSE doc_id END AS label FROM labels WHERE doc_id % 3 <> 1 OR doc_id % 2 = 0")
def golden_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "labels").select(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")).alias("name"), F.lit("v1").alias("version"), F.col("doc_id").alias("label"))
    new = old.where("name = 's1' AND label % 2 = 0").withColumn("label", F.col("label") + 1_000_000)
    return golden.reloaded(old, new).select("name", "label")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE 'old' END AS v FROM customer WHERE c_custkey % 8 <> 7")
def replaced_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").where("c_custkey % 8 <> 7 AND c_custkey % 16 <> 0").select("c_custkey", F.lit("old").alias("v"))
    new = table(spark, sf_dir, "customer").where("c_custkey % 4 = 0").select("c_custkey", F.lit("new").alias("v"))
    return adjudication.replaced_state(old, new, "c_custkey")


@query("SELECT s_suppkey AS org_id, CASE WHEN s_suppkey % 4 = 0 THEN 'r' || s_suppkey WHEN s_suppkey % 2 = 0 THEN 'x' || s_suppkey END AS ror_id FROM supplier")
def enriched_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, _ = known(spark, sf_dir)
    found = o.where("org_id % 2 = 0").select("org_id", F.concat(F.lit("x"), F.col("org_id").cast("string")).alias("ror_id"), F.lit("").alias("openalex_id"))
    return organisations.enriched(o, found.unionByName(found.withColumn("ror_id", F.lit(" ")))).select("org_id", "ror_id")


# Paged harvests and versioned tables

PAGE_SIZE = 10


@query(f"""WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS set_spec, DATE '2024-01-01' + CAST(7 * (doc_id % 4) AS INT) AS first FROM documents),
  s AS (SELECT set_spec, first, count(*) AS n, count(*) FILTER (WHERE doc_id % 9 = 0) AS n_deleted, sum(doc_id) AS ids FROM d GROUP BY ALL),
  w AS (SELECT *, first = DATE '2024-01-22' AND n > {PAGE_SIZE} AND set_spec = 'de' AS bad FROM (SELECT set_spec, CAST(x AS DATE) AS first FROM (SELECT DISTINCT set_spec FROM d), (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-29', INTERVAL 7 DAY)) AS x)) LEFT JOIN s USING (set_spec, first))
  SELECT set_spec, CAST(first AS VARCHAR) AS window_from, CASE WHEN bad THEN 0 ELSE CAST(ceil(n / {PAGE_SIZE}) AS BIGINT) END AS n_pages, CASE WHEN bad THEN 0 ELSE n END AS n_records, CASE WHEN bad THEN 0 ELSE n_deleted END AS n_deleted, CASE WHEN NOT bad THEN CAST(ids AS BIGINT) END AS ids, CASE WHEN bad THEN 'error code=badResumptionToken message=expired' END AS failure FROM w WHERE bad OR n IS NOT NULL""")
def paged_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of a set for each language, harvested page by page in windows of a week. The last
    week is empty; the token of one window has expired, which leaves the others as they are."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("set_spec"), F.date_add(F.lit("2024-01-01").cast("date"), (7 * (F.col("doc_id") % 4)).cast("int")).alias("first"))
    gone = F.when(F.col("doc_id") % 9 == 0, ' status="deleted"').otherwise("")
    xml = F.format_string('<record><header%s><identifier>oai:x:%d</identifier></header><metadata><arXiv><id>%d</id><title>a</title></arXiv></metadata></record>', gone, "doc_id", "doc_id")
    pages = paged.pages_of(d.select("*", F.date_add("first", 6).alias("last"), xml.alias("record")), "set_spec", ("first", "last"), "doc_id", "record", PAGE_SIZE)
    sets = sorted(r[0] for r in d.select("set_spec").distinct().limit(1000).collect())
    last = paged.first_page(F.col("set_spec"), F.lit("2024-01-29"), F.lit("2024-02-04"))
    empty = d.select("set_spec").distinct().select(last.alias("name"), F.lit(f'<OAI-PMH><error code="{paged.NO_RECORDS}">none</error></OAI-PMH>').alias("xml"))
    expired = paged.next_page(F.lit("de|2024-01-22|2024-01-28|1"))
    pages = pages.withColumn("xml", F.when(F.col("name") == expired, '<OAI-PMH><error code="badResumptionToken">expired</error></OAI-PMH>').otherwise(F.col("xml")))
    folder = f"{shared_folder(spark)}/pages/{unused('harvest')}"
    paged.store_pages(pages.unionByName(empty), folder)
    paged.register(spark)
    found = spark.read.format(paged.FORMAT).options(path=folder, sets=",".join(sets), until="2024-02-04", failures="keep", **{"from": "2024-01-01"}).load()
    own = [F.col("set_spec"), F.col("window_from").cast("string").alias("window_from")]
    records = ingest.oai_page(found).select(*own, "page", "failure", F.explode_outer("records").alias("xml"))
    parsed = records.select("set_spec", "window_from", "page", "failure", F.col("xml").isNotNull().alias("is_record"), F.coalesce(F.contains("xml", F.lit('status="deleted"')), F.lit(False)).alias("gone"), F.regexp_extract("xml", r"<identifier>oai:x:(\d+)<", 1).try_cast("long").alias("id"))
    return parsed.groupBy("set_spec", "window_from").agg(F.countDistinct("page").alias("n_pages"), F.count_if("is_record").alias("n_records"), F.count_if("gone").alias("n_deleted"), F.sum("id").alias("ids"), F.max("failure").alias("failure"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS priority, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS status, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderkey % 4 <> 1),
  n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN 'fresh' END AS priority, o_orderstatus AS status, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DOUBLE) + 1 END AS price FROM orders WHERE o_orderkey % 4 IN (0, 1))
  SELECT coalesce(o.k, n.k) AS k, coalesce(n.priority, o.priority) AS priority, CASE WHEN n.k IS NULL THEN o.status ELSE coalesce(nullif(o.status, ''), n.status) END AS status, CASE WHEN n.k IS NULL THEN o.price ELSE n.price END AS price FROM o FULL JOIN n ON o.k = n.k""")
def table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table and a harvest that meets a part of it, merged twice: the second merge changes nothing."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    price = F.col("o_totalprice").cast("double")
    kept = KeyedTable.create(spark, f"{shared_folder(spark)}/tables/{unused('orders')}", "k long, priority string, status string, price double", ["k"])
    kept.replace(o.where("o_orderkey % 4 <> 1").select(k.alias("k"), F.col("o_orderpriority").alias("priority"), F.when(k % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("status"), price.alias("price")))
    new = o.where("o_orderkey % 4 IN (0, 1)").select(k.alias("k"), F.when(k % 5 != 0, "fresh").alias("priority"), F.col("o_orderstatus").alias("status"), F.when(k % 7 != 0, price + 1).alias("price"))
    policies = {"priority": "new", "status": "fill", "price": "overwrite"}
    version = kept.upsert(new, policies)
    if kept.upsert(new, policies) != version:
        raise AssertionError("an upsert that ran again changed the table")
    return kept.read(version)


MAIL_SQL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"


@query(f"""SELECT page_id, array_to_string(list_distinct_in_order, ',') AS emails, CASE WHEN page_id % 4 = 0 THEN 'Lab A & ' || page_id ELSE 'Lab A & ' || page_id || '|' || 'Host of ' || page_id % 10 END AS affiliations,
  'Ana ' || page_id || ':1,2:Lab A & ' || page_id || CASE WHEN page_id % 4 = 0 THEN '' ELSE '/Host of ' || page_id % 10 END || '|Bo:2:' || CASE WHEN page_id % 4 = 0 THEN '' ELSE 'Host of ' || page_id % 10 END AS authors
  FROM (SELECT page_id, list_filter(m, lambda x, i: list_position(m, x) = i) AS list_distinct_in_order FROM (SELECT page_id, list_concat(CASE WHEN page_id % 3 = 0 THEN ['ana@h' || page_id || '.edu', 'bo@h' || page_id || '.edu'] ELSE [] END, regexp_extract_all(html, '{MAIL_SQL}')) AS m FROM pages))""")
def contacts_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page behind a block of two authors: marks, notes that are left open, a group of mail addresses."""
    k = F.col("page_id").cast("string")
    mails = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<span class="ltx_note"><sup class="ltx_note_mark">*</sup>Equal contribution. Email: {ana, bo}@h'), k, F.lit(".edu</span>"))).otherwise("")
    second = F.when(F.col("page_id") % 4 == 0, "Corresponding author").otherwise(F.concat(F.lit("Host of "), (F.col("page_id") % 10).cast("string")))
    block = F.concat(
        F.lit('<div><span class="ltx_personname">Ana '), k, F.lit('<sup>1,2</sup><span class="ltx_personname">Bo<sup>2</sup></div><p><span class="ltx_note"><sup class="ltx_note_mark">1</sup>Lab A &amp; '), k,
        F.lit('</p><span class="ltx_note"><sup class="ltx_note_mark">2</sup>'), second, F.lit("</span>"), mails,
    )
    c = table(spark, sf_dir, "pages").select("page_id", html_contacts.html_contacts(F.concat(block, "html")).alias("c"))
    one = lambda a: F.concat_ws(":", a["name"], F.array_join(a["markers"], ","), F.array_join(a["affiliations"], "/"))
    return c.select("page_id", F.array_join("c.emails", ",").alias("emails"), F.array_join("c.affiliations", "|").alias("affiliations"), F.array_join(F.transform("c.authors", one), "|").alias("authors"))


@query("""WITH f AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, max(ts) AS newest FROM events GROUP BY ALL)
  SELECT event_type AS entity, substr(sha256(event_type), 1, 16) AS request, CASE WHEN n % 3 <> 0 THEN n END AS n, CASE WHEN n % 3 = 0 THEN 'not valid JSON' END AS error FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY newest DESC) AS k FROM f) WHERE k = 1""")
def newest_response_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored response a day for each event type; the newest file counts, broken or not."""
    e = table(spark, sf_dir, "events")
    f = e.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"), F.max("ts").alias("at"))
    body = F.when(F.col("n") % 3 == 0, '{"n": ').otherwise(F.format_string('{"n": %d}', "n"))
    folder = f"{shared_folder(spark)}/responses/{unused('raw')}"
    paged.store_pages(f.select(raw_files.response_name(F.col("at"), F.substring(F.sha2("event_type", 256), 1, 16), F.col("event_type")).alias("name"), body.alias("xml")), folder)
    return raw_files.newest_responses(spark, folder).select("entity", "request", F.try_variant_get(F.try_parse_json("payload"), "$.n", "bigint").alias("n"), "error")


@query(f"""WITH r AS (SELECT doc_id, lang AS set_spec FROM documents UNION ALL SELECT doc_id, 'all' FROM documents WHERE doc_id % 3 = 0),
  m AS (SELECT coalesce(set_spec, 'none') AS set_spec, doc_id // 2 AS id, doc_id % 11 = 0 AS gone, doc_id % 11 <> 0 AND doc_id % 4 IN (0, 2) AS kept, doc_id % 11 <> 0 AND doc_id % 4 IN (0, 2) AND doc_id % 5 = 0 AS old FROM r),
  s AS (SELECT set_spec, count(*) AS seen, count(*) FILTER (WHERE gone) AS deleted, count(*) FILTER (WHERE kept) AS kept, count(*) FILTER (WHERE old) AS revision, count(DISTINCT id) FILTER (WHERE kept) AS "unique" FROM m GROUP BY GROUPING SETS ((set_spec), ()))
  SELECT *, CASE WHEN set_spec IS NULL THEN 26 * "unique" END AS projected_unique, CASE WHEN set_spec IS NULL THEN CAST(coalesce(round(26 * "unique" * (revision / nullif(kept, 0))), 0) AS BIGINT) END AS projected_revision, CASE WHEN set_spec IS NULL THEN 26 * "unique" - CAST(coalesce(round(26 * "unique" * (revision / nullif(kept, 0))), 0) AS BIGINT) END AS projected_new FROM s""")
def projected_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first window in all sets: some records stand in two, and each identifier has two records."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("set_spec"))
    n = F.col("doc_id")
    half = F.floor(n / 2)
    name = F.format_string("%04d.%05d", (F.lit(2401) + F.floor(half / 100_000)).cast("int"), (half % 100_000).cast("int"))
    r = d.unionByName(d.where(n % 3 == 0).withColumn("set_spec", F.lit("all")))
    r = r.select("set_spec", name.alias("arxiv_id"), (n % 11 == 0).alias("deleted"), F.array(by_rest("doc_id", 4, *CATEGORIES)).alias("categories"), F.when(n % 5 == 0, "2023-06-01").otherwise("2024-01-02").alias("created"))
    return ingest.projected_harvest(r, "set_spec", 26, 2024)


@query(f"""WITH l AS (SELECT user_id, floor(value) % 10 AS a, CASE WHEN event_id % 9 <> 0 THEN floor(value * 10) % 10 END AS b, event_id % 10 AS c, event_id % 3 <> 0 AS passed FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1),
  s AS (SELECT user_id, CAST(a + b + c AS DOUBLE) / 3 AS mean FROM l WHERE passed),
  top AS (SELECT user_id FROM (SELECT user_id, row_number() OVER (ORDER BY mean DESC, user_id) AS k, count(*) OVER () AS n FROM s WHERE mean IS NOT NULL) WHERE k <= greatest(1, round_even(n * {config.PERCENTILE} / 100, 0))),
  r AS (SELECT user_id, 'top' AS route FROM top
    UNION SELECT user_id, 'org' FROM s JOIN lineitem ON l_orderkey = user_id WHERE l_suppkey % 17 = 0 AND l_suppkey % 2 = 0
    UNION SELECT user_id, 'person' FROM s JOIN orders ON o_orderkey = user_id WHERE o_custkey % 23 = 0)
  SELECT user_id, string_agg(route, ',' ORDER BY route) AS routes FROM r GROUP BY 1""")
def quality_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screenings of users, affiliations by line items, people by orders."""
    n, v = F.col("event_id"), F.col("value")
    screens = table(spark, sf_dir, "events").select("user_id", "ts", n.alias("id"), (F.floor(v) % 10).alias("technical_significance"), F.when(n % 9 != 0, F.floor(v * 10) % 10).alias("apparent_novelty"), (n % 10).alias("evidence_strength"), (n % 3 != 0).alias("passed"))
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("user_id"), F.col("l_suppkey").alias("organisation_id"))
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    listed = table(spark, sf_dir, "supplier").select(k.alias("organisation_id"), (k % 17 == 0).alias("is_org_of_interest"), F.when(k % 2 == 0, F.lit(True)).alias("active"))
    wrote = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("user_id"), F.col("o_custkey").alias("person_id"))
    people = table(spark, sf_dir, "customer").select(c.alias("person_id"), (c % 23 == 0).alias("is_person_of_interest"), F.lit(True).alias("active"))
    return quality.quality_candidates(screens, links, listed, wrote, people, "user_id", "ts")
