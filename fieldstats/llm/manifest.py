"""Merkle manifest of a table: leaves, subroots per group, one root, and a proof per row.

Every level joins runs of ``FANOUT`` consecutive nodes (the last run may be shorter, even one
node) into the SHA-256 of their hex digests, until one node remains. Rows are ranked inside their
group; the rank, written in base ``FANOUT``, says where a row sits: dropping its lowest digit
gives its parent. A pass groups away ``DEPTH`` digits at once, so a group holds at most
``FANOUT ** DEPTH`` nodes, nested as an array of structs inside which all levels of the block
are computed with higher-order functions. Block digests go up as the nodes of the next pass.
Going down, each block meets the path above its top once, and a transform and explode give every
row its siblings, level by level, and the proof. Only one row per block is joined; rows never are.

Hard cases, all defined:

* null fields are written ``-``, an empty text ``0:``; texts are hashed whole, however long;
* rows are ordered by (id, leaf digest), nulls first, so repeated rows and ties are fixed;
* a group key may be null (it sorts first), and a group may hold a third of all rows: it is cut
  into blocks by rank, with no task holding more than one block;
* a group of one row has that leaf as its subroot; a table of one group has that subroot as root;
* an empty table gives no rows. Columns beyond the ones named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.llm.components import stored

FANOUT = 8
#: Levels computed inside one block: at most FANOUT ** DEPTH nodes are grouped at once.
DEPTH = 3
BLOCK = FANOUT**DEPTH
#: Rows of the table of ranges per partition that are broadcast; beyond, it is joined by key.
BROADCAST_RANGES = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<before:string,after:string>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: list[str], text: Column | None = None) -> Column:
    """The leaf digest of the named columns in order; ``text`` replaces the column ``text``."""
    return digest(*[field(text if (name == "text" and text is not None) else F.col(name)) for name in columns])


def group_key(value: Column) -> Column:
    """A non-null key whose bytewise order puts null first, then the values bytewise."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("~"), value.cast("string")))


def ranked(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Add ``pos``, the 0-based rank inside ``group`` by ``order``, and ``total``, the group's size.

    Rows are range-partitioned on (group, order) and numbered inside their partition; a small
    table of (partition, group) ranges gives each its offset. A group spread over many partitions
    is thus numbered by many tasks.
    """
    parted = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    parted = parted.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    parted = stored(parted, "ranked")
    ranges = parted.groupBy("_part", group).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ranges = ranges.withColumn(
        "_offset", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("total", F.sum("_n").over(Window.partitionBy(group)))
    ranges = stored(ranges.select("_part", group, "_first", "_offset", "total"), "ranges")
    if ranges.count() <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    out = parted.join(ranges, ["_part", group])
    return out.withColumn("pos", F.col("_seq") - F.col("_first") + F.col("_offset")).drop("_part", "_seq", "_first", "_offset")


def _levels_to_go(total: Column) -> Column:
    """Smallest L with FANOUT ** L >= total (0 for one node)."""
    guess = F.ceil(F.log(float(FANOUT), F.greatest(total, F.lit(1)).cast("double"))).cast("int")
    guess = F.when(F.pow(F.lit(float(FANOUT)), guess - 1) >= total, guess - 1).otherwise(guess)
    return F.when(F.pow(F.lit(float(FANOUT)), guess) < total, guess + 1).otherwise(guess)


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of BLOCK nodes: the nodes, the levels inside, the block's top digest.

    ``nodes``: seq, pos, total (nodes of seq at this level), hash, and a struct ``load``.
    """
    rows = F.array_sort(F.collect_list(F.struct((F.col("pos") % BLOCK).alias("at"), "hash", "load")))
    blocks = nodes.groupBy("seq", (F.col("pos") / F.lit(BLOCK)).cast("long").alias("blk")).agg(
        F.first("total").alias("total"), rows.alias("nodes")
    )
    done = F.least(_levels_to_go(F.col("total")), F.lit(DEPTH))
    level = F.transform("nodes", lambda n: n["hash"])
    levels = [level]
    for _ in range(DEPTH):
        below = levels[-1]
        above = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(below) / F.lit(FANOUT)).cast("int") - 1),
            lambda i: F.sha2(F.array_join(F.slice(below, i * FANOUT + 1, FANOUT), ""), 256),
        )
        levels.append(above)
    top = F.element_at(F.array(*[F.element_at(x, 1) for x in levels]), done + 1)
    return blocks.select("seq", "blk", "total", "nodes", done.alias("done"), F.array(*levels).alias("levels"), top.alias("top"))


def _steps(levels: Column, done: Column, at: Column) -> Column:
    """The siblings of node ``at`` of a block at each of its ``done`` levels: before and after it."""

    def step(j: Column) -> Column:
        row = F.element_at(levels, j + 1)
        me = (at / F.pow(F.lit(float(FANOUT)), j)).cast("int")
        start = (me / FANOUT).cast("int") * FANOUT
        stop = F.least(start + FANOUT, F.size(row))
        before = F.array_join(F.slice(row, start + 1, me - start), "")
        after = F.array_join(F.slice(row, me + 2, F.greatest(stop - me - 1, F.lit(0))), "")
        return F.struct(before.alias("before"), after.alias("after"))

    none = F.array().cast(f"array<{_STEP}>")
    return F.when(done > 0, F.transform(F.sequence(F.lit(0), done - 1), step)).otherwise(none)


def rolled_up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All passes of blocks over ``nodes`` (seq, pos, total, hash, load), and the root of each seq."""
    passes: list[DataFrame] = []
    level = nodes
    while True:
        blocks = stored(_blocks(level), "blocks")
        passes.append(blocks)
        up = blocks.where(F.col("total") > BLOCK)
        if up.isEmpty():
            break
        level = up.select(
            "seq",
            F.col("blk").alias("pos"),
            F.ceil(F.col("total") / F.lit(BLOCK)).cast("long").alias("total"),
            F.col("top").alias("hash"),
            F.struct(F.lit(None).cast("string").alias("none")).alias("load"),
        )
    roots = passes[0].where(F.col("total") <= BLOCK).select("seq", F.col("top").alias("root"))
    for blocks in passes[1:]:
        roots = roots.union(blocks.where(F.col("total") <= BLOCK).select("seq", F.col("top").alias("root")))
    return passes, roots


def unrolled(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """Per node of the lowest pass: seq, pos, load and ``path``, its siblings up to the top.

    ``above``: seq and ``path`` above each seq's root (empty where the root is the top).
    """
    paths = None
    for depth in range(len(passes) - 1, -1, -1):
        blocks = passes[depth]
        top = blocks.where(F.col("total") <= BLOCK).join(above, "seq")
        if paths is not None:
            inner = blocks.where(F.col("total") > BLOCK).join(paths.select("seq", F.col("pos").alias("blk"), "path"), ["seq", "blk"])
            top = top.unionByName(inner)
        nodes = top.select("seq", "blk", "levels", "done", "path", F.explode("nodes").alias("n"))
        paths = nodes.select(
            "seq",
            (F.col("blk") * BLOCK + F.col("n.at")).alias("pos"),
            F.col("n.load").alias("load"),
            F.concat(_steps(F.col("levels"), F.col("done"), F.col("n.at")), F.col("path")).alias("path"),
        )
        if depth:
            paths = stored(paths.drop("load"), "paths")
    return paths


def fold(path: Column, start: Column) -> Column:
    """The digest reached from ``start`` through the siblings of ``path``."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(df: DataFrame, columns: list[str], key: str, group: str, tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root, proof and a folded root for every row of ``df``.

    ``columns`` make the leaf, in order; ``key`` orders leaves inside ``group``; subroots are
    ordered by group (null first, bytewise). ``tampered``, if given, is a leaf digest computed from
    changed fields; ``folded_root`` recomputes the root from it and the original siblings, and
    ``verified`` says whether it equals the root.
    Returns key, group, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    leaf = leaf_of(columns)
    rows = df.select(
        F.col(key).alias("_key"),
        F.col(group).alias("_group"),
        group_key(F.col(group)).alias("seq"),
        leaf.alias("hash"),
        (tampered if tampered is not None else leaf).alias("_changed"),
    )
    rows = ranked(rows, "seq", [F.col("_key").asc_nulls_first(), F.col("hash")])
    load = F.struct("_key", "_group", F.col("hash").alias("leaf"), "_changed", _levels_to_go(F.col("total")).alias("inner"))
    passes, subroots = rolled_up(rows.select("seq", "pos", "total", "hash", load.alias("load")))
    groups = ranked(stored(subroots, "subroots").select(F.lit("").alias("all"), "seq", F.col("root").alias("hash")), "all", [F.col("seq")])
    groups = groups.select(F.col("all").alias("seq"), "pos", "total", "hash", F.struct(F.col("seq").alias("group")).alias("load"))
    top_passes, _ = rolled_up(groups)
    empty = F.array().cast(f"array<{_STEP}>")
    above = unrolled(top_passes, top_passes[-1].select("seq", empty.alias("path")).distinct())
    above = stored(above.select(F.col("load.group").alias("seq"), "path"), "above")
    leaves = unrolled(passes, above)
    path, start = F.col("path"), F.col("load.leaf")
    return leaves.select(
        F.col("load._key").alias(key),
        F.col("load._group").alias(group),
        start.alias("leaf"),
        fold(F.slice(path, 1, F.col("load.inner")), start).alias("subroot"),
        fold(path, start).alias("root"),
        F.sha2(siblings(path), 256).alias("proof_sha256"),
        fold(path, F.col("load._changed")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
