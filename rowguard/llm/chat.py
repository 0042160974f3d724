"""Operator 8: chat formatting of reply trees (DataFrame functions only).

Messages are nodes that name their parent. Iterative self-joins by pointer
doubling reach every root in log2(depth) rounds: round k knows each node's
ancestor 2^k steps up and the score sum of the steps between. Leaves are ranked
by the mean score of their path within their tree, the best ``branches`` are
kept, and the doubled pointers, followed from the widest down, list every node
of a kept path. Each path becomes one conversation; nothing is enumerated for
paths that are not kept.

Template: a turn is ``<s>[TAG] text [/TAG]</s>`` and a line break; TAG is INST
for user, SYS for system, ANS for assistant, ROLE and the role's name for
others (brackets in it percent-coded). A control string inside a text gets one
backslash after its first sign, and a string that already has backslashes there
gets one more, so unescaping is exact. The loss mask is the code-point spans of assistant texts.

Defined results: a null text or role is empty; a node whose parent is null or
absent is a root, a node in a cycle of parents has no root and raises an error;
equal scores prefer the smaller leaf; other columns are ignored. For tables of turns,
``chain`` makes each conversation a tree with one branch, ordered by turn (nulls
first), then role and text, so repeated turns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowguard.llm.common import staged

#: fixed values: tags of roles
TAGS = {"user": "INST", "system": "SYS", "assistant": "ANS"}
CONTROL = r"(<|\[)(\\*)(/?s>|/?(?:INST|SYS|ANS|ROLE))"
ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?(?:INST|SYS|ANS|ROLE))"
END_OF_TURN = "</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


#: signs that may not stand in a role's name, with what is written for them
NAME_SIGNS = (("%", "%25"), ("[", "%5B"), ("]", "%5D"), ("<", "%3C"))


def write_name(role: Column) -> Column:
    for sign, code in NAME_SIGNS:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def read_name(name: Column) -> Column:
    for sign, code in reversed(NAME_SIGNS):
        name = F.replace(name, F.lit(code), F.lit(sign))
    return name


def chain(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Nodes (tree, node, parent, role, text, score) of linear conversations."""
    rows = turns.select(F.col(conv_col).cast("long").alias("tree"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                       F.lit(0.0).alias("score"))


def paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth) of the best root-to-leaf paths of every tree."""
    ids = staged(nodes.select(F.coalesce("tree", F.lit(0)).alias("tree"), F.col("tree").isNull().alias("nameless"), "node", "parent",
                              F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    on = ["tree", "nameless"]
    known = ids.select(*on, F.col("node").alias("up"), F.lit(True).alias("there"))
    # a pointer to a missing parent is none
    level = staged(ids.withColumnRenamed("parent", "up").join(known, [*on, "up"], "left").select(
        *on, "node", F.when(F.col("there"), F.col("up")).alias("up"), F.col("score").alias("sum"),
        F.when(F.col("there"), 1).otherwise(0).alias("steps")), "up")
    parents = level.filter("up IS NOT NULL").select(*on, F.col("up").alias("node")).distinct()
    leaves = level.join(parents, [*on, "node"], "left_anti").select(*on, "node")
    levels, limit = [level], ids.count()
    while not (level := levels[-1]).filter("up IS NOT NULL").isEmpty():
        if 2 ** (len(levels) - 1) > max(limit, 1):
            raise ValueError("parents form a cycle")
        above = level.select(*on, F.col("node").alias("up"), F.col("up").alias("up2"), F.col("sum").alias("sum2"), F.col("steps").alias("steps2"))
        # only nodes below their root so far are joined; the others are carried along
        further = level.filter("up IS NOT NULL").join(above, [*on, "up"], "left").select(
            *on, "node", F.col("up2").alias("up"), (F.col("sum") + F.coalesce("sum2", F.lit(0.0))).alias("sum"),
            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"))
        levels.append(staged(further.union(level.filter("up IS NULL").select(*on, "node", "up", "sum", "steps")), "up"))
    total = levels[-1]  # sums and steps up to the root
    best = Window.partitionBy(*on).orderBy(F.desc("mean"), "leaf")
    kept = leaves.join(total, [*on, "node"]).select(*on, F.col("node").alias("leaf"), "steps", (F.col("sum") / (F.col("steps") + 1)).alias("mean"))
    kept = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    found = kept.select(*on, "leaf", "rank", F.col("leaf").alias("node"), F.col("steps").alias("depth"))
    for k in range(len(levels) - 2, -1, -1):  # from the widest pointers down
        jump = levels[k].filter("up IS NOT NULL").select(*on, "node", "up")
        further = found.join(jump, [*on, "node"]).select(*on, "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - 2 ** k).alias("depth"))
        found = staged(found.union(further), "paths") if k % 3 == 0 else found.union(further)
    return found.select(F.when(~F.col("nameless"), F.col("tree")).alias("tree"), "leaf", "rank", "node", "depth")


def conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one row per kept path."""
    member = paths(nodes, branches)
    n = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    turns = member.join(n, member["tree"].eqNullSafe(n["t"]) & (member["node"] == n["n"]))
    tag = F.concat(F.lit("ROLE "), write_name(F.col("role")))
    for role, name in TAGS.items():
        tag = F.when(F.col("role") == role, F.lit(name)).otherwise(tag)
    kind = F.substring_index("tag", " ", 1)
    turns = turns.select("tree", "leaf", "rank", "depth", F.col("role"), tag.alias("tag"), escape(F.col("text")).alias("body"))
    opened = F.concat(F.lit("<s>["), F.col("tag"), F.lit("] "))
    turns = turns.withColumn("turn", F.concat(opened, F.col("body"), F.lit(" [/"), kind, F.lit("]" + END_OF_TURN)))
    path = Window.partitionBy("tree", "leaf", "rank").orderBy("depth")
    before = F.sum(F.length("turn")).over(path) - F.length("turn")
    turns = turns.withColumn("at", (before + F.length(opened)).cast("long"))
    turns = turns.select("tree", "leaf", "rank", F.struct("depth", "turn").alias("piece"),
                         F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"))).alias("span"))
    return turns.groupBy("tree", "leaf", "rank").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list("span")).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    turns = F.filter(F.split(formatted, r"</s>\n", -1), lambda t: t != "")

    def one(turn: Column) -> Column:
        close = F.instr(turn, "] ")
        tag = F.substring(turn, F.lit(5), close - 5)
        kind = F.substring_index(tag, " ", 1)
        body = F.substring(turn, close + 2, F.length(turn) - close - 1 - F.length(kind) - 4)
        role = read_name(F.substring(tag, F.lit(6), F.length(tag)))
        for name, t in TAGS.items():
            role = F.when(tag == t, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(turns, one)


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
