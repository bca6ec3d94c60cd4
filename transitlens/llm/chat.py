"""Chat formatting of reply trees, in DataFrame operations only (operator 7).

Messages that answer messages form trees. Iterative self-joins double the
distance that every message sees towards its root, so a tree of depth n takes
log2(n) joins, over one row of fixed size per message; leaves end the root-to-leaf paths. Branches are
ranked by the sum of their messages' scores (ties: the longer path, then the leaf's id). The messages of
a chosen branch are marked by the same jumps in reverse, and the
branch is formatted as one conversation: its text is one value, which one task puts together.

Template: ``<s>`` and the turns: ``[INST] user [/INST]``, ``[OUT] assistant</s>``,
``[SYS] system [/SYS]``, and ``[ROLE:hex of the role] text [/ROLE]`` for any
other role. A control string inside a text gets one more backslash after its
first character, which reading back takes away, so no text can end a turn.

Defined cases: null texts are empty; a null role is the empty role; a message
whose parent is missing begins a tree; messages of a cycle have no root and are in no path; repeated rows of
a tree's message are one message; a null tree id is a tree of its own; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import NO_ID, free, read, written

CONTROL = r"/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE:|/ROLE\]"
_RAW = rf"([<\[])(\\*)({CONTROL})"
_ESCAPED = rf"([<\[])(\\*)\\({CONTROL})"
_TURN = r"(?s)\[(INST|OUT|SYS|ROLE:[0-9A-F]*)\] (.*?)(?: \[/INST\]| \[/SYS\]| \[/ROLE\]|</s>)"
_MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>"), "system": ("[SYS] ", " [/SYS]")}


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _RAW, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _mark(role: Column, i: int) -> Column:
    other = F.concat(F.lit("[ROLE:"), F.hex(F.encode(role, "UTF-8")), F.lit("] ")) if i == 0 else F.lit(" [/ROLE]")
    out = F.when(role == "user", F.lit(_MARKS["user"][i]))
    for r in ("assistant", "system"):
        out = out.when(role == r, F.lit(_MARKS[r][i]))
    return out.otherwise(other)


def branches(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, leaf, score, depth) of every root-to-leaf path, jumps) of messages (tree, node, parent, score).

    Every round keeps one row of fixed size per message: the message 2 ** round above it (null beyond the root), and the
    summed score and number of the messages passed. ``jumps[round]`` is that row's (tree, node, above).
    """
    nodes = written(messages.select("tree", "node", "parent", "score").dropDuplicates(["tree", "node"]), "nodes")
    most = nodes.groupBy("tree").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    state = written(nodes.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("up")), "left")
                    .select("tree", "node", F.col("up").alias("above"), "score", F.lit(1).cast("long").alias("depth")), "paths")
    jumps = [state]
    # who is still under way after as many steps as the tree has messages is in a cycle or under one
    while 1 << (len(jumps) - 1) < most and not state.filter("above IS NOT NULL").isEmpty():
        up = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("next"),
                          F.col("score").alias("more"), F.col("depth").alias("further"))
        longer = (state.filter("above IS NOT NULL").join(up, (F.col("tree") == F.col("t")) & (F.col("above") == F.col("n")))
                  .select("tree", "node", F.col("next").alias("above"), (F.col("score") + F.col("more")).alias("score"),
                          (F.col("depth") + F.col("further")).alias("depth")))
        state = written(state.filter("above IS NULL").unionByName(longer), "paths")
        jumps.append(state)
    parents = nodes.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = state.filter("above IS NULL").join(parents, ["tree", "node"], "left_anti")
    return leaves.select("tree", F.col("node").alias("leaf"), "score", "depth"), jumps


def best_paths(found: DataFrame, top: int = 1) -> DataFrame:
    """The ``top`` branches of every tree, with their rank."""
    order = W.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def on_paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree, rank, i, node): every message on the chosen branches, ``i`` counted from the root.

    From the longest jump to the shortest, what is marked marks the message that far above it; so a
    message at any distance is marked once, by the binary digits of the distance.
    """
    marked = written(chosen.select("tree", "rank", F.col("leaf").alias("node"), (F.col("depth") - 1).alias("i")), "marked")
    for k in reversed(range(len(jumps))):
        step = jumps[k].filter("above IS NOT NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        more = (marked.join(step, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")))
                .select("tree", "rank", F.col("above").alias("node"), (F.col("i") - (1 << k)).alias("i")))
        last, marked = marked, written(marked.unionByName(more), "marked")
        free(last, jumps[k])
    return marked


def formatted(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, rank, text, mask): the chosen paths as conversations.

    ``messages``: tree, node, parent (long), role, text, score. ``mask`` holds the code-point spans (at, len) of the
    assistant's texts in ``text``: the part that a loss counts.
    """
    src = messages.select(F.coalesce("tree", F.lit(NO_ID)).alias("tree"), "node", "parent",
                          F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                          F.coalesce("score", F.lit(0)).cast("double").alias("score"))
    found, jumps = branches(src)
    turn = on_paths(best_paths(found, top), jumps).join(src.dropDuplicates(["tree", "node"]), ["tree", "node"])
    parts = turn.select("tree", "rank", "i", "role", _mark(F.col("role"), 0).alias("a"), escaped(F.col("text")).alias("b"),
                        _mark(F.col("role"), 1).alias("c"))
    before = W.partitionBy("tree", "rank").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    sized = parts.withColumn("at", F.coalesce(F.sum(F.length(F.concat("a", "b", "c"))).over(before), F.lit(0)) + 3 + F.length("a"))
    rows = sized.groupBy("tree", "rank").agg(F.sort_array(F.collect_list(F.struct(
        "i", F.concat("a", "b", "c").alias("s"), "at", F.length("b").alias("len"), "role"))).alias("x"))
    return rows.select(
        F.when(F.col("tree") != NO_ID, F.col("tree")).alias("tree"), "rank",
        F.concat(F.lit("<s>"), F.array_join(F.col("x.s"), "")).alias("text"),
        F.transform(F.filter("x", lambda t: t["role"] == "assistant"),
                    lambda t: F.struct(t["at"].cast("int").alias("at"), t["len"].alias("len"))).alias("mask"))


def turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    roles = F.regexp_extract_all(text, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(_TURN), F.lit(2))

    def role(r: Column) -> Column:
        return (F.when(r == "INST", "user").when(r == "OUT", "assistant").when(r == "SYS", "system")
                .otherwise(F.decode(F.unhex(F.substring(r, 6, 1 << 30)), "UTF-8")))

    return F.zip_with(roles, bodies, lambda r, b: F.struct(role(r).alias("role"), unescaped(b).alias("text")))


def masked(text: Column, mask: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(mask, lambda m: unescaped(F.substring(text, m["at"] + 1, m["len"])))


def chained(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations by turn as reply chains: every row answers the one before it (order: turn, role, text)."""
    src = rows.select(F.col(conv).cast("long").alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    place = F.row_number().over(W.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return src.withColumn("node", place).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = formatted(chained(table.unionByName(extra)))
    back = out.select("tree", "text", turns(F.col("text")).alias("turns"), F.array_join(masked(F.col("text"), F.col("mask")), "").alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(joined, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), F.length("text").cast("long").alias("formatted_chars"))
