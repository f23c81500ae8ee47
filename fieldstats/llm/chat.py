"""Reply trees to formatted conversations.

Messages point to the message they answer. Every path from a root to a leaf is
enumerated by self-joins that double their reach each round, branches are
ranked by score, and the chosen ones are formatted with marks around turns. In
texts and roles the characters that begin or end marks, and the escape itself,
are escaped, so the conversation can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.llm.components import stored

OPEN, CLOSE = "<s>", "</s>"
# Escapes: none of < [ ] is left in an escaped text, and every backslash begins an escape.
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))


def escaped(text: Column) -> Column:
    for raw, code in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _steps(messages: DataFrame) -> DataFrame:
    """(tree, node, up): links to an earlier message of the same tree."""
    nodes = messages.select("tree", F.col("node").alias("up")).distinct()
    return messages.where("parent < node").select("tree", "node", F.col("parent").alias("up")).join(nodes, ["tree", "up"]).select("tree", "node", "up")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, above): for each leaf all messages up to the root, and how far above the leaf they are.

    messages (tree, node, parent): node is a number, unique in its tree, that
    grows with time. A parent that is null, missing or not earlier makes a
    message a root.
    """
    jump = stored(_steps(messages), "jumps")
    answered = jump.select("tree", F.col("up").alias("node")).distinct()
    leaves = messages.select("tree", "node").join(answered, ["tree", "node"], "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    reach = 1
    while not jump.isEmpty():
        further = found.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("above") + reach).alias("above"))
        found = stored(found.union(further), "paths")
        far = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = stored(jump.join(far, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")), "jumps")
        reach *= 2
    return found


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, branch, formatted, mask) for the best branches of every tree, ranked by the sum of scores.

    messages (tree, node, parent, role, text, score). Equal sums go to the
    smaller leaf. A null role or text is empty, a null score is 0; rows without
    tree or node are left out, of rows with the same node one is taken (the
    smallest by parent, role, text). mask lists the spans (start, stop; code
    points) of assistant texts in formatted. An empty table gives no rows.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    rest = F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), score)
    own = messages.where("tree is not null and node is not null").groupBy("tree", "node").agg(F.min(rest).alias("m")).select("tree", "node", "m.*")
    own = stored(own, "messages")
    every = paths(own)
    ranked = every.join(own.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    best = ranked.withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf"))).where(F.col("branch") <= branches)
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(OPEN + "["), role, F.lit("]"))
    turns = (
        every.join(best.select("tree", "leaf", "branch"), ["tree", "leaf"])
        .join(own.select("tree", "node", "role", "text"), ["tree", "node"])
        .select("tree", "leaf", "branch", "above", "role", F.length(head).alias("lead"), F.concat(head, text, F.lit(CLOSE)).alias("piece"))
    )
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
    start = F.col("at") + F.col("lead")
    stop = F.col("at") + F.length("piece") - len(CLOSE)
    span = F.when(F.col("role") == "assistant", F.struct(start.alias("start"), stop.alias("stop")))
    out = turns.groupBy("tree", "leaf", "branch").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("above")).alias("k"), "piece"))).alias("pieces"), F.array_sort(F.collect_list(span)).alias("mask")
    )
    return out.select("tree", "leaf", "branch", F.array_join("pieces.piece", "").alias("formatted"), "mask")


def turns_of(text: Column) -> Column:
    """Array of (role, body) read back from a formatted conversation, bodies still escaped."""
    pieces = F.filter(F.split(text, CLOSE), lambda p: p != "")
    inner = lambda p: F.substring(p, len(OPEN) + 2, F.length(p))
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(inner(p), "]", 1)).alias("role"),
            F.substring(inner(p), F.length(F.substring_index(inner(p), "]", 1)) + 2, F.length(p)).alias("body"),
        ),
    )
