"""Chat formatting (op 10), DataFrame functions only: reply trees to conversations.

Messages form trees by parent. Iterative self-joins double the reach of a jump table, so a chain of a thousand turns
takes ten joins; the scores passed add up on the way and rank the leaves. Only the chosen paths are then enumerated, by
the same tables. Texts take no part until then.

The template writes a turn as ``<turn role="...">text</turn>`` and a newline. Every ``<`` of its own begins a mark;
those of roles and texts are written as ``&lt;``, ampersands as ``&amp;`` and quotes of roles as ``&quot;``. So no
text can hold a control string, marks are found by plain splits, and each replacement can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklode.llm.common import Scratch

#: Fixed values of the template.
OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"


def swap(x: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def escape(x: Column) -> Column:
    return swap(x, ("&", "&amp;"), ("<", "&lt;"))


def escape_role(x: Column) -> Column:
    return swap(escape(x), ('"', "&quot;"))


def unescape(x: Column) -> Column:
    return swap(x, ("&quot;", '"'), ("&lt;", "<"), ("&amp;", "&"))


def chain(rows: DataFrame) -> DataFrame:
    """Messages ``tree, node, parent, role, text, score`` of linear conversations: each turn answers the one before.

    Rows of one turn are ordered by role and text; each is a turn of its own. Null roles and texts count as empty,
    null turns come first, and rows without a conversation are one conversation of a null tree.
    """
    picked = rows.select(F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    numbered = picked.withColumn("node", node)
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def keyed(df: DataFrame) -> DataFrame:
    """Adds ``k, no``, a null-safe form of the tree."""
    return df.withColumns({"k": F.coalesce(F.col("tree").cast("string"), F.lit("")), "no": F.col("tree").isNull()})


KEYS = ["k", "no"]


def jumps(messages: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Tables ``k, no, node, up, total, count`` by round: after round r a jump goes 2**r steps up, ``total`` and ``count`` are of
    the scores (null: 0) of the nodes it passes, its own included. ``up`` is null past the root, where the last table has all.

    A parent that is not there makes its child a root. A loop of parents raises.
    """
    light = keyed(messages).select(*KEYS, "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("total"), F.lit(1).cast("long").alias("count"))
    light = scratch.write(light, "nodes")
    known = light.select(*KEYS, F.col("node").alias("parent"), F.col("node").alias("up"))
    table = scratch.write(light.join(known, [*KEYS, "parent"], "left").select(*KEYS, "node", "up", "total", "count"), "jumps")
    scratch.drop(light)
    out, reach, nodes = [table], 1, table.count()
    while not table.where("up is not null").isEmpty():
        if reach > 2 * nodes:
            raise ValueError("the replies form a loop")
        onward = table.select(*KEYS, F.col("node").alias("up"), F.col("up").alias("top"), F.col("total").alias("more"), F.col("count").alias("n"))
        both = table.where("up is not null").join(onward, [*KEYS, "up"])
        further = both.select(*KEYS, "node", F.col("top").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("count") + F.col("n")).alias("count"))
        table = scratch.write(further.unionByName(table.where("up is null")), "jumps")
        out.append(table)
        reach *= 2
    return out


def paths(messages: DataFrame, scratch: Scratch, branches: int | None = None) -> DataFrame:
    """``tree, leaf, branch, node, back``: the nodes of the best ``branches`` root-to-leaf paths of each tree (None: all), ``back``
    steps from the leaf.

    Leaves rank by the mean score of their path (null: 0), then by the smaller leaf. The sums come along with the jumps,
    so only paths that are chosen are ever written. Trees are null-safe keys; nodes are unique in their tree.
    """
    tables = jumps(messages, scratch)
    inner = tables[0].where("up is not null").select(*KEYS, F.col("up").alias("node")).distinct()
    leaves = tables[-1].join(inner, [*KEYS, "node"], "left_anti").withColumn("mean", F.round(F.col("total") / F.col("count"), 12))
    rank = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc("mean"), "node"))
    best = leaves.withColumn("branch", rank)
    if branches is not None:
        best = best.where(F.col("branch") <= branches)
    found = scratch.write(best.select(*KEYS, F.col("node").alias("leaf"), "branch", "node", F.lit(0).cast("long").alias("back")), "paths")
    for r, table in enumerate(tables[:-1]):
        step = table.where("up is not null").select(*KEYS, "node", "up")
        further = found.join(step, [*KEYS, "node"]).select(*KEYS, "leaf", "branch", F.col("up").alias("node"), (F.col("back") + (1 << r)).alias("back"))
        longer = scratch.write(found.unionByName(further), "paths")
        scratch.drop(found)
        found = longer
    scratch.drop(*tables)
    scratch.sweep()
    kind = messages.schema["tree"].dataType
    return found.select(F.when(~F.col("no"), F.col("k")).cast(kind).alias("tree"), "leaf", "branch", "node", "back")


def chosen(messages: DataFrame, scratch: Scratch, branches: int | None = 1) -> DataFrame:
    """``tree, leaf, branch, back, role, text`` of the messages of the best ``branches`` paths of each tree (None: all)."""
    walked = keyed(paths(messages, scratch, branches)).drop("tree")
    body = keyed(messages).select("tree", *KEYS, "node", "role", "text")
    return walked.join(body, [*KEYS, "node"]).select("tree", "leaf", "branch", "back", "role", "text")


def format_paths(turns: DataFrame) -> DataFrame:
    """``tree, leaf, branch, formatted, mask``: one conversation a path.

    ``mask`` holds ``start`` (from 0) and ``length``, in characters of ``formatted``, of each assistant text. Places are
    running sums over the turns of a path, which stay with their path from there on.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MIDDLE))
    body = escape(F.col("text"))
    path = ["tree", "leaf", "branch"]
    rows = turns.select(*path, "back", (F.col("role") == "assistant").alias("loss"), F.concat(head, body, F.lit(CLOSE)).alias("turn"), F.length(head).alias("head"), F.length(body).alias("body"))
    before = Window.partitionBy(*path).orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)).cast("int") + F.col("head"))
    one = F.struct((-F.col("back")).alias("place"), "turn", F.when(F.col("loss"), F.struct(F.col("at").alias("start"), F.col("body").alias("length"))).alias("mask"))
    listed = rows.groupBy(*path).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    mask = F.array_compact(F.transform("turns", lambda t: t["mask"]))
    return listed.select(*path, F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), mask.alias("mask"))


def parse(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``, an array of role and text, read back from ``formatted`` alone."""
    marked = F.split("formatted", CLOSE)
    each = F.slice(marked, F.lit(1), F.size(marked) - 1)  # nothing follows the last mark
    role = lambda t: F.substring_index(F.substring(t, F.lit(len(OPEN) + 1), F.length(t)), MIDDLE, 1)
    text = lambda t: F.substring(t, F.locate(MIDDLE, t) + len(MIDDLE), F.length(t))
    turns = F.transform(each, lambda t: F.struct(unescape(role(t)).alias("role"), unescape(text(t)).alias("text")))
    return formatted.withColumn("turns", turns)


def digests(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of linear conversations, all read
    back from the formatted text and its mask. A conversation with many turns is one row by nature."""
    made = parse(format_paths(chosen(chain(conversations), scratch)))
    lined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("mask", lambda m: unescape(F.substring("formatted", m["start"] + 1, m["length"]))), "")
    return made.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(lined, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
