"""Chat formatting of reply trees.

Every message may have a parent. Self-joins double the reach of the parent links until all roots are found, and the
same links, taken from the longest to the shortest, enumerate all messages of each path from a root to a leaf. Branches are
ranked by score and each chosen path becomes one conversation of a template with control strings. Control strings
inside roles and texts are escaped so that reading back gives exactly what went in.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Backslashes doubled, ``<|`` broken up; no control string is left."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: a single backslash between ``<`` and ``|`` only comes from it."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """Percent codes for what ends a role or begins a control string."""
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def paths(messages: DataFrame) -> DataFrame:
    """Rows (tree, leaf, node, up) for every message on every path from a leaf to its root, ``up`` steps above the leaf.

    A parent that does not exist makes a message a root. Messages on a cycle, or below one, have no root and are on no
    path. The rounds grow with the logarithm of the longest path.
    """
    nodes = stored(messages.select("tree", "node", "parent"), "chat")
    above = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    link = nodes.join(above, nodes.tree.eqNullSafe(above.t) & (nodes.parent == above.n)).select(
        "tree", "node", F.col("n").alias("top")
    )
    steps = [stored(link, "chat")]
    while not steps[-1].isEmpty() and 2 ** len(steps) <= 2 * nodes.count():
        here = steps[-1]
        far = here.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("top").alias("far"))
        further = here.join(far, here.tree.eqNullSafe(far.t) & (here.top == far.n)).select(
            "tree", "node", F.col("far").alias("top")
        )
        steps.append(stored(further, "chat"))
    endless = steps.pop()
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = nodes.join(parents, nodes.tree.eqNullSafe(parents.t) & (nodes.node == parents.p), "left_anti")
    lost = endless.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    leaves = leaves.join(lost, leaves.tree.eqNullSafe(lost.t) & (leaves.node == lost.n), "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(steps))):
        jump = steps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "top")
        both = F.array(
            F.struct("node", "up"), F.struct(F.col("top").alias("node"), (F.col("up") + 2**k).alias("up"))
        )
        met = found.join(jump, found.tree.eqNullSafe(jump.t) & (found.node == jump.n), "left")
        found = met.select(
            "tree", "leaf", F.explode(F.filter(both, lambda x: x.node.isNotNull())).alias("x")
        ).select("tree", "leaf", "x.node", "x.up")
    return found


def format_trees(messages: DataFrame, top: int | None = None, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, score, n_turns, formatted, loss_spans.

    ``messages`` has tree, node, parent, role, text and score; a node id is unique in its tree, of repeated ones
    the smallest row counts. A path's score is the mean of its messages' scores, null counting as 0; rank 1 is the best path
    of its tree, ties go to the smaller leaf, and ``top`` keeps the first ranks only (all by default). ``loss_spans`` are the
    code points [begin, end) of ``formatted`` that hold the escaped texts of the roles in ``learn``. Null roles and texts
    count as empty, a null tree is a tree of its own, rows with a null node and other columns are ignored, no rows give no rows.
    """
    rest = F.struct(
        F.col("parent"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    single = messages.where("node is not null").groupBy("tree", "node").agg(F.min(rest).alias("r"))
    single = stored(single.select("tree", "node", "r.*"), "chat")
    found = paths(single)
    body = single.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text", "score")
    turns = found.join(body, found.tree.eqNullSafe(body.t) & (found.node == body.n)).select(
        "tree", "leaf", "up", "role", "text", "score"
    )
    ranked = turns.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    ranked = ranked.withColumn(
        "rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    )
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "rank", F.col("score").alias("path_score"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    shown = turns.select(
        "tree", "leaf", "up", head.alias("head"), escape(F.col("text")).alias("body"), F.col("role").isin(*learn).alias("on")
    ).withColumn("turn", F.concat("head", "body", F.lit(END + "\n")))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head")
    shown = shown.withColumn("begin", begin)
    span = F.struct("begin", (F.col("begin") + F.length("body")).alias("end"))
    whole = shown.groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("begin", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("on"), span))).alias("loss_spans"),
    )
    chosen = whole.join(ranked, whole.tree.eqNullSafe(ranked.t) & (whole.leaf == ranked.l))
    return chosen.select(
        "tree",
        "leaf",
        "rank",
        F.col("path_score").alias("score"),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.turn", "").alias("formatted"),
        "loss_spans",
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"), unescape(F.substr(inner, F.length(role) + 2)).alias("text")
        )

    return F.transform(parts, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(formatted, s.begin.cast("int") + 1, (s.end - s.begin).cast("int")))), ""
    )


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations of plain turns (conv_id, turn, role, text) as reply trees: every row answers the one before.

    Rows are taken by turn, null turns first, and by role and text where turns are equal.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return rows.select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
