"""Relational operators of the scoring funnel: DataFrame in, DataFrame out, nothing collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.functions import text
from litfunnel.sources import staging


def latest_per_key(log: DataFrame, keys: Sequence[str], at: str, tie: str) -> DataFrame:
    """The newest row of each key; equal times go to the greatest tie. Spark prunes each partition
    to one row a key before it shuffles (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(at), F.desc(tie))
    return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def pending(items: DataFrame, done: DataFrame, key: str, versions: Mapping[str, str] | None = None) -> DataFrame:
    """Items without a finished row of these versions; a null version never counts as finished."""
    for column, value in (versions or {}).items():
        done = done.where(F.col(column) == value)
    return items.join(done.select(key), key, "left_anti")


def finished(items: DataFrame, done: DataFrame, key: str, versions: Mapping[str, str] | None = None) -> DataFrame:
    for column, value in (versions or {}).items():
        done = done.where(F.col(column) == value)
    return items.join(done.select(key), key, "left_semi")


def in_days(df: DataFrame, at: str, first: str, last: str, inclusive: bool = True) -> DataFrame:
    """Rows from the first day to the last; without inclusive the last day is left out."""
    end = F.to_timestamp_ntz(F.lit(last)) + (F.expr("INTERVAL 1 DAY") if inclusive else F.expr("INTERVAL 0 DAY"))
    return df.where((F.col(at) >= F.to_timestamp_ntz(F.lit(first))) & (F.col(at) < end))


#: Rows that one task may sort: the size of a top-k, or of the bracket a selection ends with.
ONE_TASK = 100_000


def percentile_slice(df: DataFrame, score: str, key: str, percent: float, one_task: int = ONE_TASK) -> DataFrame:
    """The best max(1, round half even of n * percent / 100) rows by (score desc, null last, key); none of none.

    A slice of up to one_task rows is a plain top-k. A larger one is cut where its last row is: the
    score, and where it is shared the key, of that row are found by ever smaller brackets of
    quantiles, and rows are only compared with them. Nothing is sorted as a whole or shuffled.
    """
    n = df.count()
    keep = max(1, round(n * percent / 100)) if n else 0
    if keep <= one_task:
        return df.orderBy(F.desc_nulls_last(score), key).limit(keep)
    there = df.where(F.col(score).isNotNull())
    m = there.count()
    if keep > m:
        tied, rest, better = df.where(F.col(score).isNull()), keep - m, F.col(score).isNotNull()
    else:
        cut, before = nth_value(there, score, keep, descending=True, one_task=one_task)
        tied, rest, better = df.where(F.col(score) == F.lit(cut)), keep - before, F.col(score) > F.lit(cut)
    if rest == tied.count():
        return df.where(better).unionByName(tied)
    last, before = nth_value(tied, key, rest, one_task=one_task)
    # Rows that repeat the last key: as many of them as are missing.
    same = tied.where(F.col(key) == F.lit(last))
    return df.where(better).unionByName(tied.where(F.col(key) < F.lit(last))).unionByName(same.limit(rest - before))


def nth_value(df: DataFrame, column: str, n: int, descending: bool = False, one_task: int = ONE_TASK) -> tuple[object, int]:
    """The value of the n-th row (from 1) of df sorted by a column without nulls, and how many rows are before that value.

    Each round narrows the rows by two approximate quantiles around the n-th, whose ranks are then
    counted exactly, to some hundredth of them. Values that have no quantiles (text) are cut by
    a sort whose partitions are counted.
    """
    c, order = F.col(column), F.desc(column) if descending else F.asc(column)
    before = 0
    while (rows := df.count()) > one_task:
        if df.schema[column].dataType.typeName() in ("string", "binary", "boolean"):
            value = numbered(df.select(column), [order], "place").where(F.col("place") == n - before).first()[0]
            return value, before + df.where(c > F.lit(value) if descending else c < F.lit(value)).count()
        at = (n - before) / rows
        at = 1 - at if descending else at
        low, high = df.agg(F.percentile_approx(column, [max(0.0, at - 0.004), min(1.0, at + 0.004)], 10_000)).first()[0]
        inside = c.between(F.lit(low), F.lit(high))
        less = df.where(c > F.lit(high) if descending else c < F.lit(low)).count()
        held = df.where(inside).count()
        if not less < n - before <= less + held:
            low, high = df.agg(F.min(column), F.max(column)).first()
            inside, less, held = F.lit(True), 0, rows
        if low == high:
            return low, before + less
        if held == rows:
            break
        df, before = df.where(inside), before + less
    value = df.select(column).orderBy(order).limit(n - before).agg(F.min(column) if descending else F.max(column)).first()[0]
    return value, before + df.where(c > F.lit(value) if descending else c < F.lit(value)).count()


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df with its row number by order, from 1, in a column name; rows equal in order are numbered as they come.

    The rows are sorted by ranges and written with a number of range and place; the sizes of the
    ranges before, one row for each range, make places into row numbers. No task sees all rows.
    """
    at, part, rows = (staging.unused() for _ in range(3))
    table = staging.written(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "sorted")
    sizes = table.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count("*").alias(rows))
    before = sizes.select(part, (F.sum(rows).over(Window.orderBy(part)) - F.col(rows)).alias(rows))
    joined = table.join(F.broadcast(before), F.shiftright(at, 33) == F.col(part))
    return joined.select(*df.columns, (F.col(rows) + F.col(at).bitwiseAND((1 << 33) - 1) + 1).alias(name))


def routed(routes: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Union of candidate routes: each key once, with the sorted routes that led to it."""
    tagged = [df.select(key, F.lit(name).alias("route")) for name, df in routes.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("route")), ",").alias("routes"))


def best_evidence(evidence: DataFrame, key: str, org: str, confidence: str, weight: str, standing: str, floor: float) -> DataFrame:
    """By key: the organisation of the strongest evidence (weight * min(1, confidence), then
    standing, then the least id), its standing, how much evidence counted, the boost and its status.

    The boost takes the strength rounded to three places. Keys without evidence have no row:
    with_evidence gives them theirs.
    """
    conf = F.coalesce(F.col(confidence), F.lit(1.0))
    strong = (conf >= floor) & F.col(org).isNotNull()
    # Decimals: a boost on a tie must round up in every engine.
    strength = (F.col(weight) * F.least(F.lit(1.0), conf)).cast("decimal(10,6)")
    best = F.max(F.when(strong, F.struct(strength.alias("strength"), F.col(standing).alias("standing"), (-F.col(org)).alias("neg")))).alias("best")
    g = evidence.groupBy(key).agg(best, F.count(F.when(strong, 1)).alias("considered"))
    product = F.col("best.standing").cast("decimal(6,1)") * F.round("best.strength", 3).cast("decimal(8,3)") / F.lit(20).cast("decimal(2,0)")
    boost = F.round(F.least(F.lit(0.5).cast("decimal(12,8)"), product.cast("decimal(12,8)")), 4).cast("double")
    found = F.col("best").isNotNull()
    return g.select(key, (-F.col("best.neg")).alias("org_id"), "considered", F.when(found, F.round("best.standing", 1)).otherwise(0.0).alias("org_score"), F.when(found, boost).otherwise(0.0).alias("org_boost"), F.when(found, "resolved").otherwise("unresolved").alias("status"))


def with_evidence(items: DataFrame, best: DataFrame, key: str) -> DataFrame:
    """items with the columns of best_evidence; those without any evidence are no_evidence_supplied."""
    j = items.join(best, key, "left")
    filled = {"considered": 0, "org_score": 0.0, "org_boost": 0.0, "status": "no_evidence_supplied"}
    return j.select(*items.columns, "org_id", *(F.coalesce(c, F.lit(v)).alias(c) for c, v in filled.items()))


def merged(old: DataFrame, new: DataFrame, key: str, policies: Mapping[str, str]) -> DataFrame:
    """Upsert by full outer join. Policies by column: new (new else old), old (old else new),
    overwrite (new row wins, null too), fill (old unless null or empty), list (new array unless null or empty),
    json (objects merged key by key, the new one wins)."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    there = F.col(f"n.{key}").isNotNull()

    def value(c: str, policy: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if policy == "new":
            return F.coalesce(b, a)
        if policy == "old":
            return F.coalesce(a, b)
        if policy == "fill":
            return F.coalesce(F.nullif(a, F.lit("")), b)
        if policy == "list":
            return F.when(F.size(b) > 0, b).otherwise(a)
        if policy == "overwrite":
            return F.when(there, b).otherwise(a)
        if policy == "json":
            return F.when(there & F.col(f"o.{key}").isNotNull(), text.merged_json(a, b)).otherwise(F.coalesce(b, a))
        raise ValueError(f"unknown policy {policy!r}")

    return both.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *(value(c, p).alias(c) for c, p in policies.items()), F.col(f"o.{key}").isNull().alias("is_new"))


def inserted_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(list(keys)).join(old, list(keys), "left_anti"))


def appended_null_safe(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old and those rows of new whose keys, null equal to null, are neither in old nor repeated in new."""
    n, o = new.dropDuplicates(list(keys)), old.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (n[k].eqNullSafe(o[f"_{k}"]) for k in keys))
    return old.unionByName(n.join(o, same, "left_anti"))


def replaced_positions(old: DataFrame, new: DataFrame, key: str, position: str, carried: Sequence[str], emptied: DataFrame | None = None) -> DataFrame:
    """new takes the place of old for the keys it has, and for those in emptied, which may have no new
    rows; carried columns stay where (key, position) does."""
    gone = new.select(key) if emptied is None else new.select(key).unionByName(emptied.select(key))
    kept = old.join(gone.distinct(), key, "left_anti")
    with_id = new.join(old.select(key, position, *carried), [key, position], "left")
    return kept.unionByName(with_id.select(*old.columns))


def overlap_stats(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of two key sets, their intersection and differences, and both shares."""
    x, y = a.select(key).distinct().withColumn("a", F.lit(1)), b.select(key).distinct().withColumn("b", F.lit(1))
    s = x.join(y, key, "full").agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("n_both"))
    pct = lambda whole: F.when(F.col(whole) > 0, F.round(100.0 * F.col("n_both") / F.col(whole), 1)).otherwise(0.0)
    return s.select("n_a", "n_b", "n_both", (F.col("n_a") - F.col("n_both")).alias("only_a"), (F.col("n_b") - F.col("n_both")).alias("only_b"), pct("n_a").alias("pct_a"), pct("n_b").alias("pct_b"))


def cohort(in_ours: Column, in_theirs: Column) -> Column:
    return F.when(in_ours & in_theirs, "BOTH").when(in_ours, "OURS_ONLY").when(in_theirs, "HF_ONLY")


def first_match(items: DataFrame, matches: Sequence[tuple[DataFrame, str, str]], item_key: str, entity: str) -> DataFrame:
    """Cascading equi-joins: for each item the entity of the first match table that has its key,
    the least entity on ties; items without a match have a null entity. matches: (table of
    key, entity), item column, name of the tier."""
    found = [
        items.select(item_key, F.col(column).alias("_k")).join(t.select(F.col("key").alias("_k"), F.col(entity)), "_k").select(item_key, F.lit(i).alias("tier"), F.lit(name).alias("matched_by"), entity)
        for i, (t, column, name) in enumerate(matches)
    ]
    best = reduce(DataFrame.unionByName, found).groupBy(item_key).agg(F.min(F.struct("tier", entity, "matched_by")).alias("m"))
    return items.select(item_key).join(best, item_key, "left").select(item_key, F.col(f"m.{entity}").alias(entity), F.col("m.matched_by").alias("matched_by"))


def propagated(state: DataFrame, signals: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """state with columns taken over from signals where it has a row for the key, nulls included; the rest as before."""
    s = signals.select(key, *(F.col(c).alias(f"_s_{c}") for c in columns), F.lit(True).alias("_there"))
    j = state.join(s, key, "left")
    return j.select(*(F.when(F.col("_there"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in state.columns))


def grounded_pairs(texts: DataFrame, key: str, said: str, phrases: DataFrame, phrase_key: str, phrase: str) -> DataFrame:
    """(key, phrase_key) of the phrases that stand as whole words in a text, whatever their length.

    An equi-join on the first two words of the phrase (or its only one) finds candidates; only
    their texts are read again to compare the whole phrase. An empty phrase stands nowhere.
    """
    p = phrases.select(phrase_key, text.grounding_key(F.col(phrase)).alias("_phrase")).where("_phrase <> ''")
    p = p.withColumn("_start", F.substring_index("_phrase", " ", 2))
    t = texts.select(key, text.grounding_key(F.col(said)).alias("_text"))
    w = t.select(key, F.split("_text", " ").alias("_w"))
    starts = F.array_distinct(F.concat("_w", F.transform(F.slice("_w", 1, F.size("_w") - 1), lambda x, i: F.concat(x, F.lit(" "), F.get("_w", i + 1)))))
    near = w.where(F.size("_w") > 0).select(key, F.explode(starts).alias("_start")).join(p.select("_start").distinct(), "_start", "left_semi").join(p, "_start").select(key, phrase_key, "_phrase")
    return near.join(t, key).where(F.contains(F.concat(F.lit(" "), "_text", F.lit(" ")), F.concat(F.lit(" "), "_phrase", F.lit(" ")))).select(key, phrase_key).distinct()


def alias_matches(names: DataFrame, aliases: DataFrame, key: str, name: str, kind: str | None = None) -> DataFrame:
    """(key, org_id): the least organisation with this alias, whatever its case, of one kind if given."""
    a = aliases if kind is None else aliases.where(F.col("alias_type") == kind)
    known = a.groupBy(F.lower("alias").alias("_alias")).agg(F.min("org_id").alias("org_id"))
    return names.select(key, F.lower(name).alias("_alias")).join(known, "_alias").select(key, "org_id")


def in_vocabulary(values: Column, vocabulary: Sequence[str]) -> Column:
    return F.filter(values, lambda x: x.isin(*vocabulary))


def out_of_vocabulary(values: Column, vocabulary: Sequence[str], kind: str) -> Column:
    return F.transform(F.filter(values, lambda x: ~x.isin(*vocabulary)), lambda x: F.concat(F.lit(kind + ":"), x))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness; empty when the constraint holds."""
    return df.groupBy(*keys).count().where("count > 1")
