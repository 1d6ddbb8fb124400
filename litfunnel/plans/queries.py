"""The registered queries of the scoring operators, each beside the SQL it must agree with.

events stand for the result log (user_id the item, event_type the task, value the raw score),
orders for papers, lineitem for affiliation evidence, supplier for organisations, labels for
golden labels, documents and pages for texts and URLs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litfunnel import config
from litfunnel.functions import scoring, text
from litfunnel.operators import core, organisations, relevance
from litfunnel.sources.records import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TASKS = ("click", "error", "purchase", "signup", "view")
HALF = "(CAST(CAST(floor(value * 100) AS BIGINT) % 21 AS DOUBLE) / 2)"
#: Latest log row of each item and task, in SQL.
LATEST = f"(SELECT * FROM (SELECT *, {HALF} AS score, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"
WIDE = "(SELECT user_id, " + ", ".join(f"max(score) FILTER (WHERE event_type = '{t}') AS {t}" for t in TASKS) + f" FROM {LATEST} GROUP BY user_id)"


def query(sql: str | None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("score", scoring.half_points(F.col("value")))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.latest_per_key(log(spark, sf_dir), ["user_id", "event_type"], "ts", "event_id")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).groupBy("user_id").pivot("event_type", list(TASKS)).agg(F.max("score"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affiliation evidence: weight by return flag, confidence by discount, standing by supplier."""
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", F.round(1 - 5 * F.col("l_discount"), 4).alias("confidence"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", (F.col("s_acctbal") > 5000).alias("listed"), (F.floor("s_acctbal").cast("long") % 4).alias("priority"))
    weight = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 0.9).otherwise(0.5)
    return e.join(s, "l_suppkey", "left").withColumn("weight", weight).withColumn("standing", scoring.standing(F.col("listed"), F.col("priority")))


EVIDENCE = """(SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, s_name, round(1 - 5 * l_discount, 4) AS confidence, s_acctbal > 5000 AS listed,
  CASE l_returnflag WHEN 'A' THEN 1.0::DOUBLE WHEN 'N' THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS weight,
  CASE WHEN s_acctbal > 5000 THEN CASE CAST(floor(s_acctbal) AS BIGINT) % 4 WHEN 3 THEN 10.0::DOUBLE WHEN 2 THEN 8.0::DOUBLE WHEN 1 THEN 6.0::DOUBLE ELSE 6.0::DOUBLE END ELSE 3.0::DOUBLE END AS standing
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)"""

RUBRIC = {"technical_significance": "click", "apparent_novelty": "view", "practical_applicability": "purchase", "potential_value": "signup", "longevity": "error"}
Q_SQL = "round(" + " + ".join(f"CAST({RUBRIC[d]} AS DECIMAL(10,4)) * CAST({w} AS DECIMAL(4,2))" for d, w in config.QUALITY_WEIGHTS.items()) + ", 4)"
FINAL_SQL = f"round({Q_SQL} * (CAST(0.70 AS DECIMAL(4,2)) + CAST(0.03 AS DECIMAL(4,2)) * CAST(click AS DECIMAL(10,4))), 4)"
#: least() skips nulls.
FINAL_SQL = f"(CASE WHEN {FINAL_SQL} > 10 THEN 10 ELSE {FINAL_SQL} END)"


def quality_of(w: DataFrame) -> DataFrame:
    q = scoring.quality({d: F.col(t) for d, t in RUBRIC.items()})
    return w.withColumn("quality", q).withColumn("final", scoring.composite(q, F.col("click")))


@query(f"SELECT user_id, CAST(quality AS DOUBLE) AS quality, CAST(final AS DOUBLE) AS final FROM (SELECT user_id, {Q_SQL} AS quality, {FINAL_SQL} AS final FROM {WIDE}) ORDER BY final DESC NULLS LAST, user_id LIMIT 20")
def flagship_current_state_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_of(wide(spark, sf_dir)).orderBy(F.desc_nulls_last("final"), "user_id").limit(20)
    return q.select("user_id", F.col("quality").cast("double").alias("quality"), F.col("final").cast("double").alias("final"))


@query(f"SELECT user_id, event_type, event_id, score FROM {LATEST}")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select("user_id", "event_type", "event_id", "score")


@query(f"SELECT user_id, event_id, score FROM {LATEST} WHERE event_type = 'view'")
def latest_single_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = log(spark, sf_dir).where("event_type = 'view'")
    return core.latest_per_key(one, ["user_id"], "ts", "event_id").select("user_id", "event_id", "score")


def done_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey"), "event_type", version.alias("version"))


DONE = "(SELECT user_id, event_type, CASE WHEN event_id % 5 <> 0 THEN 'v' || (event_id % 3) END AS version FROM events)"


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM {DONE} d WHERE d.user_id = o_custkey AND event_type = 'error' AND version = 'v1')")
def version_aware_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return core.pending(orders, done_log(spark, sf_dir), "o_custkey", {"event_type": "error", "version": "v1"}).select("o_orderkey", "o_custkey")


@query(f"SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM {DONE} d WHERE d.user_id = o_custkey AND event_type = 'error' AND version = 'v1')")
def done_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return core.finished(orders, done_log(spark, sf_dir), "o_custkey", {"event_type": "error", "version": "v1"}).select("o_orderkey")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01' GROUP BY 1")
def day_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.in_days(table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1996-01-31").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09' AND event_type IN ('click', 'view')")
def half_open_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = core.in_days(table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-09", inclusive=False)
    return e.where(F.col("event_type").isin("click", "view")).agg(F.count("*").alias("n"))


@query("SELECT d.doc_id, coalesce(nullif(d.lang, 'en'), 'default') AS lang, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.source IN ('src1', 'src2')")
def fetch_with_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where(F.col("source").isin("src1", "src2"))
    j = d.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.nullif("lang", F.lit("en")), F.lit("default")).alias("lang"), F.coalesce("quality", F.lit(-1)).alias("quality"))


@query(f"SELECT user_id, event_type, score, score >= 5.0 AS passed FROM {LATEST}")
def gate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select("user_id", "event_type", "score", (F.col("score") >= config.GATE).alias("passed"))


@query(f"SELECT event_type, count(*) FILTER (WHERE score >= 5.0) AS passed, count(*) FILTER (WHERE NOT score >= 5.0) AS failed, count(DISTINCT user_id) AS items FROM {LATEST} GROUP BY 1")
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.col("score") >= config.GATE
    return latest(spark, sf_dir).groupBy("event_type").agg(F.count_if(g).alias("passed"), F.count_if(~g).alias("failed"), F.countDistinct("user_id").alias("items"))


SURVIVORS = f"(SELECT user_id, score FROM {LATEST} WHERE event_type = 'view' AND score >= 5.0)"
TOP_SLICE = f"(SELECT user_id, score FROM (SELECT *, row_number() OVER (ORDER BY score DESC, user_id) AS r, count(*) OVER () AS n FROM {SURVIVORS}) WHERE r <= greatest(1, round_even(n * 15 / 100.0, 0)))"


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).where((F.col("event_type") == "view") & (F.col("score") >= config.GATE)).select("user_id", "score")


@query(f"SELECT user_id, score FROM {TOP_SLICE}")
def percentile_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.percentile_slice(survivors(spark, sf_dir), "score", "user_id", config.PERCENTILE)


def notable_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence(spark, sf_dir).where(F.col("listed") & (F.coalesce("confidence", F.lit(1.0)) >= config.CONFIDENCE_FLOOR))
    return e.select(F.col("l_orderkey").alias("user_id")).distinct()


@query(f"""WITH r AS (SELECT user_id, 'top' AS route FROM {TOP_SLICE} UNION ALL
  SELECT DISTINCT s.user_id, 'org' FROM {SURVIVORS} s WHERE EXISTS (SELECT 1 FROM {EVIDENCE} e WHERE e.l_orderkey = s.user_id AND listed AND confidence >= 0.6))
  SELECT user_id, string_agg(route, ',' ORDER BY route) AS routes FROM r GROUP BY 1""")
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = survivors(spark, sf_dir)
    return core.routed({"top": core.percentile_slice(s, "score", "user_id", config.PERCENTILE), "org": s.join(notable_items(spark, sf_dir), "user_id", "left_semi")}, "user_id")


@query(f"SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM {EVIDENCE} e WHERE e.l_orderkey = o_orderkey AND listed AND confidence >= 0.6)")
def notable_org_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey").join(notable_items(spark, sf_dir), F.col("o_orderkey") == F.col("user_id"), "left_semi")


@query(f"""WITH r AS (SELECT *, CAST(weight * least(1.0, confidence) AS DECIMAL(10,6)) AS strength, confidence >= 0.6 AND l_suppkey IS NOT NULL AS strong FROM {EVIDENCE}),
  b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY strong DESC, strength DESC, standing DESC, l_suppkey) AS k, count(*) FILTER (WHERE strong) OVER (PARTITION BY l_orderkey) AS considered FROM r)
  SELECT l_orderkey, CASE WHEN strong THEN l_suppkey END AS org_id, considered, CASE WHEN strong THEN round(standing, 1) ELSE 0.0 END AS org_score, CAST(CASE WHEN strong THEN round(least(0.5, CAST(standing AS DECIMAL(6,1)) * CAST(round(strength, 3) AS DECIMAL(8,3)) * CAST(0.05 AS DECIMAL(3,2))), 4) ELSE 0.0 END AS DOUBLE) AS org_boost,
  CASE WHEN strong THEN 'resolved' ELSE 'unresolved' END AS status FROM b WHERE k = 1""")
def evidence_argmax_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.best_evidence(evidence(spark, sf_dir), "l_orderkey", "l_suppkey", "confidence", "weight", "standing", config.CONFIDENCE_FLOOR)


@query(f"SELECT user_id, CAST({Q_SQL} AS DOUBLE) AS quality, CAST({FINAL_SQL} AS DOUBLE) AS final FROM {WIDE}")
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_of(wide(spark, sf_dir)).select("user_id", F.col("quality").cast("double").alias("quality"), F.col("final").cast("double").alias("final"))


SCREEN_SQL = "round((CAST(click AS DECIMAL(10,4)) + CAST(view AS DECIMAL(10,4)) + CAST(signup AS DECIMAL(10,4))) / 3, 1)"


@query(f"SELECT user_id, CAST({SCREEN_SQL} AS DOUBLE) AS screen_score FROM {WIDE}")
def screen_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir).select("user_id", scoring.screen_score(F.col("click"), F.col("view"), F.col("signup")).cast("double").alias("screen_score"))


@query(f"SELECT user_id, CAST(round(abs(q - s), 2) AS DOUBLE) AS gap, round(abs(q - s), 2) >= 3.0 AS disagrees FROM (SELECT user_id, {Q_SQL} AS q, CAST({SCREEN_SQL} AS DECIMAL(4,1)) AS s FROM {WIDE})")
def disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_of(wide(spark, sf_dir))
    gap = F.round(F.abs(F.col("quality") - scoring.screen_score(F.col("click"), F.col("view"), F.col("signup"))), 2)
    return q.select("user_id", gap.cast("double").alias("gap"), (gap >= config.DISAGREEMENT).alias("disagrees"))


@query(f"SELECT user_id, CASE WHEN purchase >= 8 THEN 'scored' WHEN view >= 5.0 THEN 'not_selected' ELSE 'skipped' END AS quality_status FROM {WIDE}")
def quality_status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir).select("user_id", scoring.quality_status(F.when(F.col("purchase") >= 8, F.col("purchase")), F.col("view") >= config.GATE).alias("quality_status"))


@query("SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, count(*) FILTER (WHERE o_totalprice > 200000) AS large, round(avg(o_totalprice), 2) AS mean_price, max(o_totalprice) AS top_price FROM orders GROUP BY 1")
def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.col("o_totalprice") > 200000
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"), F.count_if(large).alias("large"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"), F.max("o_totalprice").alias("top_price"))


@query("SELECT event_type, count(*) AS results, count(DISTINCT user_id) AS items, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1")
def stage_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("results"), F.countDistinct("user_id").alias("items"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(f"SELECT l_suppkey, s_name, count(DISTINCT l_orderkey) AS papers, round(avg(confidence), 4) AS mean_confidence FROM {EVIDENCE} WHERE confidence >= 0.6 GROUP BY 1, 2 ORDER BY papers DESC, l_suppkey LIMIT 25")
def org_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence(spark, sf_dir).where(F.col("confidence") >= config.CONFIDENCE_FLOOR)
    g = e.groupBy("l_suppkey", "s_name").agg(F.countDistinct("l_orderkey").alias("papers"), F.round(F.avg("confidence"), 4).alias("mean_confidence"))
    return g.orderBy(F.desc("papers"), "l_suppkey").limit(25)


@query("SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def domain_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("""SELECT coalesce(model, 'total') AS model, count(*) AS calls, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, round(sum(cost), 4) AS cost FROM
  (SELECT split_part(CASE event_id % 3 WHEN 0 THEN 'z-ai/glm-5.3-flash:screen' WHEN 1 THEN 'openai/gpt-5.6-sol:quality' ELSE 'other:x' END, ':', 1) AS model, event_id % 5000 AS tokens_in,
   round(CASE event_id % 3 WHEN 0 THEN (event_id % 5000) / 1e6 * 0.15 + (event_id % 700) / 1e6 * 0.5 WHEN 1 THEN (event_id % 5000) / 1e6 * 1.25 + (event_id % 700) / 1e6 * 10 ELSE 0 END, 6) AS cost FROM events)
  GROUP BY ROLLUP (model)""")
def cost_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    endpoint = F.when(k == 0, "z-ai/glm-5.3-flash:screen").when(k == 1, "openai/gpt-5.6-sol:quality").otherwise("other:x")
    e = table(spark, sf_dir, "events").select(F.split_part(endpoint, F.lit(":"), F.lit(1)).alias("model"), (F.col("event_id") % 5000).alias("tokens_in"), (F.col("event_id") % 700).alias("tokens_out"))
    e = e.withColumn("cost", scoring.token_cost(F.col("model"), F.col("tokens_in"), F.col("tokens_out")))
    r = e.rollup("model").agg(F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.round(F.sum("cost"), 4).alias("cost"))
    return r.select(F.coalesce("model", F.lit("total")).alias("model"), "calls", "tokens_in", "cost")


TAGS = "(SELECT user_id, CAST(ts AS DATE) AS day, list(DISTINCT event_type) AS tags, max(value) AS top FROM events GROUP BY 1, 2)"
BUSINESS = "(list_contains(tags, 'purchase') OR len(list_filter(tags, lambda t: t NOT IN ('click', 'view', 'signup'))) > 0)"
TECH = f"(list_has_any(tags, ['click', 'view']) AND NOT {BUSINESS})"


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.collect_set("event_type").alias("tags"), F.max("value").alias("top"))


def business() -> Column:
    return F.array_contains("tags", "purchase") | F.coalesce(F.exists("tags", lambda t: ~t.isin("click", "view", "signup")), F.lit(False))


def tech() -> Column:
    return F.arrays_overlap("tags", F.array(F.lit("click"), F.lit("view"))) & ~business()


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, top FROM {TAGS} WHERE {TECH} ORDER BY top DESC NULLS LAST, user_id, day LIMIT 50")
def pool_tech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).where(tech()).orderBy(F.desc_nulls_last("top"), "user_id", "day").limit(50).select("user_id", F.col("day").cast("string").alias("day"), "top")


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, top FROM {TAGS} WHERE {BUSINESS} ORDER BY top DESC NULLS LAST, user_id, day LIMIT 50")
def pool_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).where(business()).orderBy(F.desc_nulls_last("top"), "user_id", "day").limit(50).select("user_id", F.col("day").cast("string").alias("day"), "top")


@query(f"SELECT count(*) AS n, count(*) FILTER (WHERE {TECH}) AS tech, count(*) FILTER (WHERE {BUSINESS}) AS business, count(*) FILTER (WHERE {TECH} AND {BUSINESS}) AS in_both, round(100.0 * count(*) FILTER (WHERE {BUSINESS}) / count(*), 1) AS pct_business, 100.0 * count(*) FILTER (WHERE {BUSINESS}) / count(*) >= 15 AS sendable FROM {TAGS}")
def pool_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tagged(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(tech()).alias("tech"), F.count_if(business()).alias("business"), F.count_if(tech() & business()).alias("in_both"))
    return c.select("*", scoring.share(F.col("business"), F.col("n")).alias("pct_business"), (100.0 * F.col("business") / F.col("n") >= 15).alias("sendable"))


@query(f"SELECT l_orderkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS orgs FROM {EVIDENCE} WHERE confidence >= 0.6 GROUP BY 1")
def all_orgs_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence(spark, sf_dir).where(F.col("confidence") >= config.CONFIDENCE_FLOOR)
    return e.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("s_name")), ", ").alias("orgs"))


@query(f"SELECT l_orderkey, s_name AS best_org FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY standing DESC, l_suppkey, l_linenumber) AS k FROM {EVIDENCE}) WHERE k = 1")
def best_org_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct(F.col("standing"), (-F.col("l_suppkey")).alias("neg"), (-F.col("l_linenumber")).alias("line"))
    return evidence(spark, sf_dir).groupBy("l_orderkey").agg(F.max_by("s_name", order).alias("best_org"))


DAILY = "(SELECT user_id, CAST(ts AS DATE) AS day, CAST(floor(max(value)) AS BIGINT) AS upvotes FROM events GROUP BY 1, 2)"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.floor(F.max("value")).alias("upvotes"))


def day_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = daily(spark, sf_dir).groupBy("day", "upvotes").agg(F.count("*").alias("n"))
    # A day's ranks: inside one vote count, plus those with more votes.
    more = Window.partitionBy("day").orderBy(F.desc(F.coalesce("upvotes", F.lit(-1)))).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("day", "upvotes", F.coalesce(F.sum("n").over(more), F.lit(0)).alias("before"))
    inside = daily(spark, sf_dir).withColumn("k", F.row_number().over(Window.partitionBy("day", "upvotes").orderBy("user_id")))
    same = inside["day"].eqNullSafe(before["day"]) & inside["upvotes"].eqNullSafe(before["upvotes"])
    return inside.join(before, same).select("user_id", inside["day"], inside["upvotes"], (F.col("before") + F.col("k")).alias("day_rank"))


RANKED = f"(SELECT *, row_number() OVER (PARTITION BY day ORDER BY coalesce(upvotes, -1) DESC, user_id) AS day_rank FROM {DAILY})"


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, upvotes, day_rank FROM {RANKED}")
def daily_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_ranked(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), "upvotes", "day_rank")


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, upvotes, day_rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(nullif(upvotes, 0), -1) DESC, day_rank, day) AS k FROM {RANKED}) WHERE k = 1")
def cross_day_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(F.desc(F.coalesce(F.nullif("upvotes", F.lit(0)), F.lit(-1))), "day_rank", "day")
    b = day_ranked(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k = 1")
    return b.select("user_id", F.col("day").cast("string").alias("day"), "upvotes", "day_rank")


@query(f"SELECT user_id, CAST(row_number() OVER (ORDER BY final DESC, coalesce(quality, 0) DESC, user_id) AS BIGINT) AS our_rank FROM (SELECT user_id, {Q_SQL} AS quality, {FINAL_SQL} AS final FROM {WIDE}) WHERE final IS NOT NULL")
def global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_of(wide(spark, sf_dir)).where("final IS NOT NULL").select("user_id", "final", F.coalesce("quality", F.lit(0)).alias("q"))
    return core.numbered(q, [F.desc("final"), F.desc("q"), F.col("user_id")], "our_rank").select("user_id", "our_rank")


A_SET, B_SET = "(SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 20)", "(SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 18)"


def two_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events")
    return tuple(e.where((F.col("event_type") == t) & (F.col("value") > v)).select("user_id").distinct() for t, v in (("error", 20), ("signup", 18)))


@query(f"SELECT n_a, n_b, n_both, n_a - n_both AS only_a, n_b - n_both AS only_b, CASE WHEN n_a > 0 THEN round(100.0 * n_both / n_a, 1) ELSE 0 END AS pct_a, CASE WHEN n_b > 0 THEN round(100.0 * n_both / n_b, 1) ELSE 0 END AS pct_b FROM (SELECT count(a.user_id) AS n_a, count(b.user_id) AS n_b, count(*) FILTER (WHERE a.user_id = b.user_id) AS n_both FROM {A_SET} a FULL JOIN {B_SET} b ON a.user_id = b.user_id)")
def overlap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.overlap_stats(*two_sets(spark, sf_dir), "user_id")


COHORTS = f"(SELECT w.user_id, CASE WHEN a.user_id IS NOT NULL AND b.user_id IS NOT NULL THEN 'BOTH' WHEN a.user_id IS NOT NULL THEN 'OURS_ONLY' WHEN b.user_id IS NOT NULL THEN 'HF_ONLY' END AS cohort, {FINAL_SQL} AS final, purchase FROM {WIDE} w LEFT JOIN {A_SET} a ON a.user_id = w.user_id LEFT JOIN {B_SET} b ON b.user_id = w.user_id)"


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = two_sets(spark, sf_dir)
    q = quality_of(wide(spark, sf_dir)).join(a.withColumn("in_a", F.lit(True)), "user_id", "left").join(b.withColumn("in_b", F.lit(True)), "user_id", "left")
    return q.withColumn("cohort", core.cohort(F.col("in_a").isNotNull(), F.col("in_b").isNotNull()))


@query(f"SELECT user_id, cohort FROM {COHORTS}")
def cohort_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts(spark, sf_dir).select("user_id", "cohort")


@query(f"SELECT cohort, count(*) AS n, round(avg(CAST(final AS DOUBLE)), 4) AS mean_final, round(median(CAST(final AS DOUBLE)), 4) AS median_final, round(avg(purchase), 4) AS mean_upvotes, round(100.0 * count(*) FILTER (WHERE final >= 4) / count(*), 1) AS pct_high FROM {COHORTS} WHERE cohort IS NOT NULL GROUP BY 1")
def cohort_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, final = cohorts(spark, sf_dir).where("cohort IS NOT NULL"), F.col("final").cast("double")
    return c.groupBy("cohort").agg(F.count("*").alias("n"), F.round(F.avg(final), 4).alias("mean_final"), F.round(F.median(final), 4).alias("median_final"), F.round(F.avg("purchase"), 4).alias("mean_upvotes"), F.round(100.0 * F.count_if(final >= 4) / F.count("*"), 1).alias("pct_high"))


@query(f"SELECT cohort, user_id, k AS sample_rank FROM (SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY final DESC NULLS LAST, user_id) AS k FROM {COHORTS} WHERE cohort IS NOT NULL) WHERE k <= 5")
def top_n_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("cohort").orderBy(F.desc_nulls_last("final"), "user_id")
    return cohorts(spark, sf_dir).where("cohort IS NOT NULL").withColumn("sample_rank", F.row_number().over(w)).where("sample_rank <= 5").select("cohort", "user_id", "sample_rank")


@query(f"SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM {TAGS}) GROUP BY 1 ORDER BY n DESC, tag LIMIT 20")
def tag_histogram_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").limit(20)


@query("SELECT source, count(*) AS compared, count(*) FILTER (WHERE (n_chars > 1500) = (quality = 1)) AS matched, round(100.0 * count(*) FILTER (WHERE (n_chars > 1500) = (quality = 1)) / count(*), 1) AS accuracy FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def golden_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id")
    hit = F.count_if((F.col("n_chars") > 1500) == (F.col("quality") == 1))
    return j.groupBy("source").agg(F.count("*").alias("compared"), hit.alias("matched"), F.round(100.0 * hit / F.count("*"), 1).alias("accuracy"))


@query(f"SELECT count(*) AS n, count(*) FILTER (WHERE list_has_any(a, b)) AS any_overlap, count(*) FILTER (WHERE list_sort(a) = list_sort(b)) AS exact FROM (SELECT user_id, list(DISTINCT event_type) FILTER (WHERE event_id % 2 = 0) AS a, list(DISTINCT event_type) FILTER (WHERE event_id % 2 = 1) AS b FROM events GROUP BY 1) WHERE a IS NOT NULL AND b IS NOT NULL")
def setwise_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_set(F.when(even, F.col("event_type")))).alias("a"), F.array_sort(F.collect_set(F.when(~even, F.col("event_type")))).alias("b"))
    g = g.where((F.size("a") > 0) & (F.size("b") > 0))
    return g.agg(F.count("*").alias("n"), F.count_if(F.arrays_overlap("a", "b")).alias("any_overlap"), F.count_if(F.col("a") == F.col("b")).alias("exact"))


#: Patterns that occur in the synthetic prose, beside two real topics.
PROSE_TOPICS = {"the": [r"\bthe\b", r"\bthat\b"], "and": [r"\band\b", r"tion\b", r"ing\b"], "AI evaluation": config.TOPICS["AI evaluation"], "LLMs": config.TOPICS["LLMs / foundation models"]}


def _hits_sql(patterns: list[str]) -> str:
    # RE2's word bounds know ASCII letters only.
    word = r"[^\p{L}\p{N}_]"
    bounded = [(f"(^|{word})" + p[2:] if p.startswith(r"\b") else p) for p in patterns]
    bounded = [(p[:-2] + f"($|{word})" if p.endswith(r"\b") else p) for p in bounded]
    return " + ".join(f"CAST(regexp_matches(lower(text), '{p}') AS INT)" for p in bounded)


def hits(patterns: list[str]) -> Column:
    """Patterns in the column text, which is lower-cased already."""
    return sum((relevance.matched(F.col("text"), p).cast("int") for p in patterns[1:]), relevance.matched(F.col("text"), patterns[0]).cast("int"))


def _relevance_sql(total: str) -> str:
    return f"least(10.0, round((CASE WHEN {total} > 0 THEN least(6.5, 3.0 + 0.7 * ({total})) ELSE 0.0 END)::DOUBLE + CASE WHEN source IN ('src1', 'src2') THEN 2.0 ELSE 0.0 END + CASE WHEN lang = 'en' THEN 0.8 ELSE 0.0 END, 2))"


@query(f"SELECT doc_id, CAST({_relevance_sql('(' + ' + '.join('(' + _hits_sql(p) + ')' for p in PROSE_TOPICS.values()) + ')')} AS DOUBLE) AS relevance FROM documents")
def topic_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = sum((hits(p) for p in list(PROSE_TOPICS.values())[1:]), hits(PROSE_TOPICS["the"]))
    d = table(spark, sf_dir, "documents").withColumn("text", F.lower("text"))
    return d.select("doc_id", scoring.relevance(total, F.col("source").isin("src1", "src2"), F.col("lang") == "en").alias("relevance"))


@query("SELECT doc_id, t[1].name AS primary_topic, array_to_string([x.name FOR x IN t[2:4]], ',') AS secondary FROM (SELECT doc_id, list_sort([x FOR x IN [" + ", ".join(f"{{'neg': -({_hits_sql(p)}), 'name': '{n}'}}" for n, p in PROSE_TOPICS.items()) + "] IF x.neg < 0]) AS t FROM documents)")
def topic_primary_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_topics = F.array(*(F.struct((-hits(p)).alias("neg"), F.lit(n).alias("name")) for n, p in PROSE_TOPICS.items()))
    t = table(spark, sf_dir, "documents").withColumn("text", F.lower("text")).select("doc_id", F.array_sort(F.filter(all_topics, lambda x: x["neg"] < 0)).alias("t"))
    return t.select("doc_id", F.get("t", F.lit(0))["name"].alias("primary_topic"), F.array_join(F.transform(F.slice("t", 2, 3), lambda x: x["name"]), ",").alias("secondary"))


@query(r"SELECT s_suppkey, trim(regexp_replace(regexp_replace(lower(s_name), '[^0-9a-z_\s&-]', ' ', 'g'), '\s+', ' ', 'g')) AS name_key FROM supplier")
def normalise_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.name_key(F.col("s_name")).alias("name_key"))


_GROUND = r"trim(regexp_replace(lower(replace({}, 'ß', 'ss')), '[^\p{{L}}\p{{N}}\p{{M}}_]+', ' ', 'g'))"


@query(f"SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON {_GROUND.format('b.text')} <> '' AND contains(' ' || {_GROUND.format('d.text')} || ' ', ' ' || {_GROUND.format('b.text')} || ' ')")
def grounding_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of any length in whole texts, by an equi-join on their first words instead of a nested loop."""
    return core.grounded_pairs(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


@query(r"""WITH u AS (SELECT page_id, url, regexp_replace(trim(url), '#.*$', '') AS u FROM pages), p AS (SELECT page_id, url, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
  regexp_replace(lower(regexp_extract(u, '^[^:]+://([^/?]*)', 1)), '^www\.', '') AS host, regexp_replace(regexp_extract(u, '^[^:]+://[^/?]*([^?]*)', 1), '/+$', '') AS path,
  [CASE WHEN contains(x, '=') THEN x ELSE x || '=' END FOR x IN string_split(regexp_extract(u, '\?(.*)$', 1), '&') IF x <> '' AND lower(split_part(x, '=', 1)) NOT IN ('utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid','mc_cid','mc_eid')] AS q FROM u)
  SELECT page_id, scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM p""")
def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.normal_url(F.col("url")).alias("url"))


@query(r"SELECT d AS domain, count(*) AS n FROM (SELECT unnest(list_distinct([lower(e) FOR e IN regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})')])) AS e FROM documents), LATERAL (SELECT split_part(e, '@', 2) AS d) WHERE d NOT IN " + str(organisations.PUBLIC_MAIL) + " GROUP BY 1")
def email_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("@"))).select(F.explode(text.emails(F.col("text"))).alias("e"))
    return d.select(F.substring_index("e", "@", -1).alias("domain")).where(~organisations.public_mail(F.col("domain"))).groupBy("domain").agg(F.count("*").alias("n"))


@query(r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS host FROM pages), k AS (SELECT 'example.com' AS domain, 1 AS org UNION ALL SELECT 'example.org', 2 UNION ALL SELECT 'm.example.net', 3 UNION ALL SELECT 'example.net', 4)
  SELECT page_id, org FROM (SELECT page_id, org, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC) AS r FROM h JOIN k ON host = domain OR ends_with(host, '.' || domain)) WHERE r = 1""")
def domain_suffix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest known parent domain of each host, as an equi-join on exploded parents."""
    host = F.lower(F.regexp_extract("url", r"^[^:]+://([^/?#]*)", 1))
    p = table(spark, sf_dir, "pages").select("page_id", F.posexplode(text.parent_domains(host)).alias("level", "domain"))
    known = spark.sql("SELECT * FROM VALUES ('example.com', 1), ('example.org', 2), ('m.example.net', 3), ('example.net', 4) AS k(domain, org)")
    return p.join(F.broadcast(known), "domain").groupBy("page_id").agg(F.min_by("org", "level").alias("org"))


@query("SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations WHERE role <> 'system'")
def author_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").where("role <> 'system'").select("conv_id", "role", F.row_number().over(w).alias("position"))


@query("""WITH m AS (SELECT s_suppkey, 0 AS tier, n_nationkey AS nation, 'id' AS matched_by FROM supplier JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 10
  UNION ALL SELECT s_suppkey, 1, c_nationkey, 'name' FROM supplier JOIN customer ON replace(lower(s_name), 'supplier', 'customer') = lower(c_name) AND c_acctbal > 2000)
  SELECT s.s_suppkey, nation, matched_by FROM supplier s LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY tier, nation) AS k FROM m) WHERE k = 1) USING (s_suppkey)""")
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.replace(F.lower("s_name"), F.lit("supplier"), F.lit("customer")).alias("name"))
    by_id = table(spark, sf_dir, "nation").where("n_nationkey < 10").select(F.col("n_nationkey").alias("key"), F.col("n_nationkey").alias("nation"))
    by_name = table(spark, sf_dir, "customer").where("c_acctbal > 2000").select(F.lower("c_name").alias("key"), F.col("c_nationkey").alias("nation"))
    return core.first_match(s, [(by_id, "s_nationkey", "id"), (by_name, "name", "name")], "s_suppkey", "nation")


@query("""WITH w AS (SELECT 0 AS ord, 'brand' AS kind, 'Brand#2' AS key UNION ALL SELECT 1, 'type', 'ECONOMY' UNION ALL SELECT 2, 'brand', 'Brand#17' UNION ALL SELECT 3, 'type', 'PROMO')
  SELECT p_partkey, min(ord) AS entry FROM part JOIN w ON (kind = 'brand' AND key = p_brand) OR (kind = 'type' AND key = p_type) GROUP BY 1""")
def watchlist_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first list entry, in list order, that matches on any kind of key."""
    w = spark.sql("SELECT * FROM VALUES (0, 'brand', 'Brand#2'), (1, 'type', 'ECONOMY'), (2, 'brand', 'Brand#17'), (3, 'type', 'PROMO') AS w(ord, kind, key)")
    keys = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(F.struct(F.lit("brand").alias("kind"), F.col("p_brand").alias("key")), F.struct(F.lit("type").alias("kind"), F.col("p_type").alias("key")))).alias("x")).select("p_partkey", "x.*")
    return keys.join(F.broadcast(w), ["kind", "key"]).groupBy("p_partkey").agg(F.min("ord").alias("entry"))


@query("SELECT a.l_orderkey, a.l_linenumber, b.l_suppkey FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey JOIN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) <= 5) c ON c.l_orderkey = a.l_orderkey WHERE b.l_returnflag = 'R'")
def fanout_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paper-level evidence for each author of papers with few authors."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    few = li.groupBy("l_orderkey").count().where("count <= 5").select("l_orderkey")
    a = li.select("l_orderkey", "l_linenumber").join(few, "l_orderkey")
    return a.join(li.where("l_returnflag = 'R'").select("l_orderkey", "l_suppkey"), "l_orderkey").select("l_orderkey", "l_linenumber", "l_suppkey")


def old_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).otherwise("").alias("priority"), F.col("o_totalprice").alias("price"))
    return o.where("k % 3 <> 0"), o.where("k % 2 = 0").withColumn("status", F.lower("status")).withColumn("price", F.when(F.col("k") % 7 != 0, F.col("price") + 1))


OLD_NEW = "o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE '' END AS priority, o_totalprice AS price FROM orders), old AS (SELECT * FROM o WHERE k % 3 <> 0), new AS (SELECT k, lower(status) AS status, priority, CASE WHEN k % 7 <> 0 THEN price + 1 END AS price FROM o WHERE k % 2 = 0)"


@query(f"WITH {OLD_NEW} SELECT coalesce(old.k, new.k) AS k, coalesce(new.status, old.status) AS status, coalesce(old.priority, new.priority) AS priority, CASE WHEN new.k IS NOT NULL THEN new.price ELSE old.price END AS price, old.k IS NULL AS is_new FROM old FULL JOIN new ON old.k = new.k")
def merge_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.merged(*old_new(spark, sf_dir), "k", {"status": "new", "priority": "old", "price": "overwrite"})


@query(f"WITH {OLD_NEW} SELECT coalesce(old.k, new.k) AS k, coalesce(nullif(old.status, ''), new.status) AS status, coalesce(nullif(old.priority, ''), new.priority) AS priority, old.k IS NULL AS is_new FROM old FULL JOIN new ON old.k = new.k")
def merge_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.merged(*old_new(spark, sf_dir), "k", {"status": "fill", "priority": "fill"})


@query(f"WITH {OLD_NEW} SELECT status, priority, count(*) AS n FROM (SELECT status, priority FROM old UNION ALL (SELECT DISTINCT status, priority FROM new n WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.status IS NOT DISTINCT FROM n.status AND old.priority IS NOT DISTINCT FROM n.priority))) GROUP BY 1, 2")
def dedup_append_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (d.select("status", "priority") for d in old_new(spark, sf_dir))
    return core.appended_null_safe(old, new, ["status", "priority"]).groupBy("status", "priority").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 = 0 THEN upper(f) || '!' ELSE f END AS name, l_partkey FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS f, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2) WHERE l_orderkey % 10 <> 0 OR l_linenumber <= 2")
def positional_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names for every tenth order, fewer than before; the part stays with its position."""
    old = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    old = old.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("name"), F.min("l_partkey").alias("l_partkey"))
    new = old.where("l_orderkey % 10 = 0 AND l_linenumber <= 2").select("l_orderkey", "l_linenumber", F.concat(F.upper("name"), F.lit("!")).alias("name"))
    emptied = old.where("l_orderkey % 10 = 0").select("l_orderkey").distinct()
    return core.replaced_positions(old, new, "l_orderkey", "l_linenumber", ["l_partkey"], emptied)


@query(f"SELECT user_id, task, score FROM (SELECT user_id, unnest(['click', 'view', 'signup']) AS task, unnest([click, view, signup]) AS score FROM {WIDE}) WHERE score IS NOT NULL")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir).select("user_id", F.expr("stack(3, 'click', click, 'view', view, 'signup', signup) AS (task, score)")).where("score IS NOT NULL")


@query(f"SELECT * FROM {WIDE}")
def long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir)


@query(f"SELECT user_id, CAST(day AS VARCHAR) AS day, array_to_string(list_sort([t FOR t IN tags IF t IN ('click', 'view')]), ',') AS known, array_to_string(list_sort(['tag:' || t FOR t IN tags IF t NOT IN ('click', 'view')]), ',') AS unknown FROM {TAGS}")
def vocab_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ["click", "view"]
    return tagged(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), F.array_join(F.array_sort(core.in_vocabulary(F.col("tags"), words)), ",").alias("known"), F.array_join(F.array_sort(core.out_of_vocabulary(F.col("tags"), words, "tag")), ",").alias("unknown"))


@query(f"SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'no JSON object' WHEN event_id % 7 = 0 THEN 'missing score' WHEN value * 2 <> floor(value * 2) THEN 'not a half point' WHEN value > 10 THEN 'out of range' END AS problem FROM events")
def llm_response_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers: fences are stripped, the outermost object is parsed, scores are checked."""
    e = table(spark, sf_dir, "events")
    body = F.concat(F.lit("Sure.\n```json\n{\"id\": "), F.col("event_id").cast("string"), F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(", \"score\": "), F.col("value").cast("string"))), F.lit("}\n```"))
    answer = F.when(F.col("event_id") % 9 == 0, F.lit("I can't.")).otherwise(body)
    v = F.try_parse_json(F.nullif(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), F.lit("")))
    s = F.try_variant_get(v, "$.score", "double")
    problem = F.when(v.isNull(), "no JSON object").when(s.isNull(), "missing score").when(s * 2 != F.floor(s * 2), "not a half point").when((s > 10) | (s < 0), "out of range")
    return e.select("event_id", problem.alias("problem"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id % 10 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 2 = 1 THEN event_id % 10 END AS j FROM events")
def json_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shallow merge of two objects; the right one wins."""
    left, right = F.from_json("props", "map<string,bigint>"), F.create_map(F.when(F.col("event_id") % 2 == 0, "k").otherwise("j"), (F.col("event_id") % 10).cast("bigint"))
    both = F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(both, F.lit("k")).alias("k"), F.try_element_at(both, F.lit("j")).alias("j"))


@query("SELECT CAST(CAST(s AS DATE) AS VARCHAR) AS first_day, CAST(CAST(least(s + INTERVAL 6 DAY, TIMESTAMP '1997-03-20') AS DATE) AS VARCHAR) AS last_day, date_diff('day', CAST(s AS DATE), CAST(least(s + INTERVAL 6 DAY, TIMESTAMP '1997-03-20') AS DATE)) + 1 AS days, count(o_orderkey) AS n FROM generate_series(TIMESTAMP '1997-02-03', TIMESTAMP '1997-03-20', INTERVAL 7 DAY) AS g(s) LEFT JOIN orders ON o_orderdate >= s AND o_orderdate < least(s + INTERVAL 6 DAY, TIMESTAMP '1997-03-20') + INTERVAL 1 DAY GROUP BY s")
def harvest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-day windows from the first day, the last clipped; rows are bucketed by arithmetic, not by a range join."""
    spine = spark.sql("SELECT explode(sequence(DATE'1997-02-03', DATE'1997-03-20', INTERVAL 7 DAYS)) AS first")
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf_dir, "orders").where((day >= F.lit("1997-02-03").cast("date")) & (day <= F.lit("1997-03-20").cast("date")))
    first = F.date_add(F.lit("1997-02-03").cast("date"), (F.floor(F.datediff(day, F.lit("1997-02-03").cast("date")) / 7) * 7).cast("int"))
    n = o.groupBy(first.alias("first")).agg(F.count("*").alias("n"))
    last = F.least(F.date_add("first", 6), F.lit("1997-03-20").cast("date"))
    return spine.join(n, "first", "left").select(F.col("first").cast("string").alias("first_day"), last.cast("string").alias("last_day"), (F.datediff(last, "first") + 1).alias("days"), F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT year(o_orderdate) AS y, count(*) FILTER (WHERE year(o_orderdate) < 1997) AS revisions, count(*) AS n FROM orders GROUP BY 1")
def revision_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(y.alias("y")).agg(F.count_if(y < 1997).alias("revisions"), F.count("*").alias("n"))


@query("SELECT CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '2024-01-01') AS VARCHAR) AS w, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("ts", "7 days", startTime="4 days")
    return table(spark, sf_dir, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("string").alias("w"), "event_type", "n")
