"""Chat formatting of reply trees, by DataFrame operations only.

Messages form trees by parent links. Root paths are found by iterative self-joins that
double the distance in each round (a chain of n turns takes log2(n) joins); each leaf is the
end of a branch; branches of a tree are ranked by score; each chosen branch becomes one
conversation. Control strings inside texts are escaped so that reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litfunnel.llm.common import discard, staged

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
ESCAPE = "\\"
#: Beginnings of control strings of this and other public chat templates.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
CHUNK = 64


def escaped(text: F.Column) -> F.Column:
    """text without control strings; undone by unescaped."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return out


def unescaped(text: F.Column) -> F.Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(c[0] + ESCAPE + c[1:]), F.lit(c))
    return F.replace(out, F.lit(ESCAPE * 2), F.lit(ESCAPE))


def branches(messages: DataFrame, spent: list[DataFrame]) -> DataFrame:
    """Each leaf with its root path length and mean score: conv_id, leaf, n, score.

    messages: conv_id, node, parent (null at a root), score (null counts as 0). Nodes must be
    unique in a conversation; a parent that doesn't exist makes its child a root. Nodes on a cycle,
    and those that lead to one, have no root and belong to no branch: a path is never longer than
    its conversation, so what has not arrived after that many steps never will. Staged tables that
    the result reads are added to spent.
    """
    m = messages.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = m.select(F.col("conv_id").alias("k_conv"), F.col("node").alias("k_node"))
    same = lambda x, y: x["conv_id"].eqNullSafe(y["k_conv"])
    linked = m.join(known, [same(m, known), m["parent"] == known["k_node"]], "left")
    parents = staged(linked.select("conv_id", "node", F.col("k_node").alias("up"), F.lit(1).cast("long").alias("n"), "score"), "walk")
    spent.append(parents)
    largest = parents.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    # Nodes that have reached their root are set aside: only the others walk on.
    done, active, steps = parents.where("up IS NULL"), parents.where("up IS NOT NULL"), 1
    while steps < largest and not active.isEmpty():
        every = done.unionByName(active)
        hop = every.select(F.col("conv_id").alias("k_conv"), F.col("node").alias("k_node"), F.col("up").alias("k_up"), F.col("n").alias("k_n"), F.col("score").alias("k_score"))
        step = active.join(hop, [active["conv_id"].eqNullSafe(hop["k_conv"]), active["up"] == hop["k_node"]], "left")
        walk = staged(step.select("conv_id", "node", F.col("k_up").alias("up"), (F.col("n") + F.coalesce("k_n", F.lit(0))).alias("n"), (F.col("score") + F.coalesce("k_score", F.lit(0.0))).alias("score")), "walk")
        spent.append(walk)
        done, active, steps = done.unionByName(walk.where("up IS NULL")), walk.where("up IS NOT NULL"), 2 * steps
    inner = parents.where("up IS NOT NULL").select(F.col("conv_id").alias("i_conv"), F.col("up").alias("i_up")).distinct()
    leaf = done.join(inner, [done["conv_id"].eqNullSafe(inner["i_conv"]), done["node"] == inner["i_up"]], "left_anti")
    return leaf.select("conv_id", F.col("node").alias("leaf"), "n", (F.col("score") / F.col("n")).alias("score"))


def best_branches(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """The keep best branches of each tree by mean score, then length, then leaf, staged; None keeps all."""
    spent: list[DataFrame] = []
    b = branches(messages, spent)
    if keep is None:
        ranked = b.withColumn("rank", F.lit(1))
    else:
        order = Window.partitionBy("conv_id").orderBy(F.desc("score"), F.desc("n"), "leaf")
        ranked = b.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    out = staged(ranked, "branches")
    for walk in spent:
        discard(walk)
    return out


def paths(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, leaf, place, node) of each chosen branch, place counted from its root.

    The known part of each path doubles in each round: all nodes found so far look up the
    ancestor as many steps away as the round's distance.
    """
    m = messages.select("conv_id", "node", "parent")
    found = staged(chosen.select("conv_id", "leaf", "n", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up_by")), "path")
    jump, by = staged(m.where("parent IS NOT NULL").select(F.col("conv_id").alias("k_conv"), F.col("node").alias("k_node"), F.col("parent").alias("k_up")), "jump"), 1
    longest = chosen.agg(F.max("n")).first()[0] or 0
    while by < longest:
        more = found.join(jump, [found["conv_id"].eqNullSafe(jump["k_conv"]), found["node"] == jump["k_node"]]).select("conv_id", "leaf", "n", F.col("k_up").alias("node"), (F.col("up_by") + by).alias("up_by")).where("up_by < n")
        longer = staged(found.unionByName(more), "path")
        discard(found)
        found = longer
        if 2 * by < longest:
            next_jump = jump.select(F.col("k_conv").alias("j_conv"), F.col("k_node").alias("j_node"), F.col("k_up").alias("j_up"))
            farther = staged(jump.join(next_jump, [jump["k_conv"].eqNullSafe(next_jump["j_conv"]), jump["k_up"] == next_jump["j_node"]]).select("k_conv", "k_node", F.col("j_up").alias("k_up")), "jump")
            discard(jump)
            jump = farther
        by *= 2
    discard(jump)
    return found.select("conv_id", "leaf", (F.col("n") - F.col("up_by") - 1).alias("place"), "node")


def chain(rows: DataFrame) -> DataFrame:
    """Flat turns (conv_id, turn, role, text) as trees: each row replies to the one before it.

    Rows go by turn (null first), then role and text. Conversations are cut into stretches of
    turn numbers, each ranked by itself and set behind the ones before it, so a conversation
    that holds most rows isn't ranked in one task. Repeated rows are separate turns.
    """
    r = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    r = r.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))))
    within = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = r.groupBy("conv_id", "stretch").count()
    sizes = sizes.select(F.col("conv_id").alias("s_conv"), F.col("stretch").alias("s_stretch"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    r = r.withColumn("rank", F.row_number().over(within))
    j = r.join(sizes, [r["conv_id"].eqNullSafe(sizes["s_conv"]), r["stretch"] == sizes["s_stretch"]])
    node = F.col("earlier") + F.col("rank") - 1
    return j.select("conv_id", node.alias("node"), F.when(node > 0, node - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def format_conversations(messages: DataFrame, keep: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """One row per chosen branch: conv_id, leaf, n_turns, formatted, segments.

    messages: conv_id, node, parent, score, role, text; null role or text counts as empty.
    segments is the loss mask: formatted cut into (text, loss) parts, loss true on what a
    loss_role turn says, escaped as it stands in formatted. Turns of long branches are joined
    in stretches of CHUNK first. An empty table gives no rows.
    """
    messages = staged(messages, "messages")
    chosen = best_branches(messages, keep)
    p = paths(messages, chosen)
    body = messages.select(F.col("conv_id").alias("b_conv"), F.col("node").alias("b_node"), escaped(F.coalesce("role", F.lit(""))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    t = p.join(body, [p["conv_id"].eqNullSafe(body["b_conv"]), p["node"] == body["b_node"]])
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    turn = F.array(part(F.concat(F.lit(TURN), F.col("role"), F.lit(SAYS)), F.lit(False)), part(F.col("text"), F.col("role") == loss_role), part(F.lit(END), F.lit(False)))
    in_order = lambda key, value: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value]))
    stretches = t.select("conv_id", "leaf", F.floor(F.col("place") / CHUNK).alias("stretch"), "place", turn.alias("parts")).groupBy("conv_id", "leaf", "stretch").agg(in_order("place", "parts").alias("parts"), F.count("*").alias("n"))
    whole = stretches.groupBy("conv_id", "leaf").agg(in_order("stretch", "parts").alias("segments"), F.sum("n").alias("n_turns"))
    return whole.select("conv_id", "leaf", "n_turns", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: F.Column) -> F.Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda _, i: i > 0)
    role = lambda x: unescaped(F.substring_index(x, SAYS, 1))
    text = lambda x: unescaped(F.substring_index(F.substring_index(x, SAYS, -1), END, 1))
    return F.transform(pieces, lambda x: F.struct(role(x).alias("role"), text(x).alias("text")))
