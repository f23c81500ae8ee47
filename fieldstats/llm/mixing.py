"""Mixing sources to target weights by a Pfair schedule.

Every source's documents, in an order given by a hash, are cut into blocks of
equal number. Time runs in slots of one block. The i-th block of a source of
weight w is released at slot floor(i / w) and due at ceil((i + 1) / w);
among the released blocks the one due first is next. So at every slot each
source is less than one block away from its share.

Weights written as decimals (or integers) are taken exactly: their integer
ratios give each source its blocks per period and the period is their sum, up
to MAX_PERIOD slots, so at every slot each source is less than one block from
its true share. Other weights (the square roots of the default) are rounded to
whole quotas of PERIOD slots. Either way the schedule repeats: it is worked out
for one period (a table bounded by its length) and carried over to all blocks
by arithmetic. The rows are numbered within small hash ranges,
no source is ever sorted as a whole.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents of a block, slots of a period, rows of a hash range.
BLOCK_ROWS, PERIOD, RANGE_ROWS = 64, 1_000, 500
#: Longest period of exact weights; weights whose exact ratios need more slots are rounded to quotas of PERIOD.
MAX_PERIOD = 100_000


def exact_quotas(weights: dict[str, float], longest: int = MAX_PERIOD) -> tuple[dict[str, int], int] | None:
    """Blocks per period in the exact ratio of the weights as written (decimals), and the period; None if that needs over ``longest`` slots or a weight is not above 0."""
    if not weights or any(not w > 0 or math.isinf(w) for w in weights.values()):
        return None
    shares = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    common = math.lcm(*[x.denominator for x in shares.values()])
    whole = {s: int(x * common) for s, x in shares.items()}
    g = math.gcd(*whole.values())
    whole = {s: n // g for s, n in whole.items()}
    return (whole, sum(whole.values())) if sum(whole.values()) <= longest else None


def quotas(weights: dict[str, float], period: int = PERIOD) -> tuple[dict[str, int], int]:
    """Blocks per period and source, and the period: exact where the weights allow (``exact_quotas``), else
    at least one each by largest remainders, the period longer if there are many sources."""
    exact = exact_quotas(weights)
    if exact is not None:
        return exact
    names = sorted(weights)
    period = max(period, 4 * len(names))
    usable = {s: weights[s] if weights[s] > 0 else 0.0 for s in names}
    total = sum(usable.values()) or 1.0
    free = period - len(names)
    exact = {s: usable[s] / total * free for s in names}
    out = {s: 1 + math.floor(exact[s]) for s in names}
    left = period - sum(out.values())
    for s in sorted(names, key=lambda s: (math.floor(exact[s]) - exact[s], s))[: max(0, left)]:
        out[s] += 1
    return out, sum(out.values())


def period_slots(quota: dict[str, int], period: int) -> list[tuple[str, int, int]]:
    """(source, block, slot) of one period, earliest deadline first among the released."""
    waiting = [(0, s, 0) for s in sorted(quota)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // quota[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out.append((s, i, slot))
        if i + 1 < quota[s]:
            heapq.heappush(waiting, ((i + 1) * period // quota[s], s, i + 1))
    return out


def _key(source: Column) -> Column:
    """Source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mixed(spark: SparkSession, documents: DataFrame, targets: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """documents with block, slot and row_in_block; sorted by slot and row_in_block they are the mixture.

    targets: weight by source, null included; a source that is not listed, and
    every source without targets, weighs the square root of its number of
    documents over all rows. The sources are a bounded list. Nothing is dropped
    or repeated: once a source has run out its slots stay empty and the others
    keep their proportions. Null sources are a source of their own; rows with
    equal or null ids are ordered by a hash of all columns; columns with the
    names of the three results give way to them; an empty table gives no rows.
    """
    docs = documents.select(
        F.struct("*").alias("row"), _key(F.col("source")).alias("s"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h")
    )
    counts = {r["s"]: r["n"] for r in docs.groupBy("s").agg(F.count("*").alias("n")).collect()}
    given = {("" if s is None else f"={s}"): w for s, w in (targets or {}).items()}
    quota, period = quotas({s: given.get(s, math.sqrt(n)) for s, n in counts.items()})
    table = spark.createDataFrame([(s, i, slot, quota[s]) for s, i, slot in period_slots(quota, period)], "s string, i long, t long, q long")
    rows, digits = sum(counts.values()), 1
    while rows > RANGE_ROWS * 16**digits:
        digits += 1
    docs = docs.withColumn("r", F.substring("h", 1, digits))
    ranges = docs.groupBy("s", "r").agg(F.count("*").alias("n"))
    before = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("s", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("s", "r").orderBy("h", F.xxhash64("row"))
    placed = docs.withColumn("k", F.row_number().over(own)).join(ranges, ["s", "r"])
    number = F.col("before") + F.col("k") - 1
    placed = placed.withColumn("block", F.floor(number / block_rows)).withColumn("row_in_block", (number % block_rows).cast("long"))
    each = table.groupBy("s").agg(F.first("q").alias("q"))
    placed = placed.join(F.broadcast(each), "s").withColumn("i", F.col("block") % F.col("q"))
    placed = placed.join(F.broadcast(table.drop("q")), ["s", "i"])
    slot = (F.floor(F.col("block") / F.col("q")) * period + F.col("t")).cast("long")
    plain = [F.col("row")[c].alias(c) for c in documents.columns if c not in ("block", "slot", "row_in_block")]
    return placed.select(*plain, "block", slot.alias("slot"), "row_in_block")


def in_order(mixture: DataFrame) -> DataFrame:
    """The rows of a mixture in its order, dealt to partitions by ranges of slots."""
    return mixture.repartitionByRange("slot", "row_in_block").sortWithinPartitions("slot", "row_in_block")
