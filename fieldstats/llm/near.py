"""Grouped prefix join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Shingles are ordered alike everywhere: those found in at least ``FREQUENT``
documents last (rarest of them first), all others before them by hash. Two
similar sets then share a shingle within their prefixes (the first n - ceil(0.8 n) + 1).

1. Count every shingle over all documents, in packed blocks of hashes.
2. Documents with equal prefix and size form a group. Groups meet on prefix
   shingles; a pair is kept if sizes and the positions of the shared shingle
   still allow enough common shingles.
3. Kept group pairs are expanded to their classes of equal sets, and each pair
   of classes is verified on the whole sets.

Rare shingles have short lists, which give all their pairs. A frequent shingle
in a prefix (large families of near copies) first gives the pairs with one
pivot only, the group in which it stands nearest the front; such pairs grow
with the list. What is still apart after that is compared in a second step
with all others of the list, so no link between components is lost and no pair
within one is built.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.llm.components import components, released, stored
from fieldstats.llm.words import Hasher, blocks, shingle_sets

#: A shingle in so many documents is ordered last and handled by pivots.
FREQUENT = 16
#: At most so many frequent shingles, the most frequent ones, are told to the tasks (16 bytes each);
#: this only sets the order of shingles, not which pairs are found.
FREQUENT_KEPT = 1 << 18
#: Ids of texts to verify are broadcast up to so many, beyond that they are joined by shuffle.
BROADCAST_IDS = 200_000
#: Shingles that a task holds before it packs and passes on their counts (8 bytes each).
COUNTED_AT_ONCE = 1 << 21
#: Group pairs with more class pairs than this start with pivots too.
CLASS_PAIRS = 256


def _slots(h: np.ndarray, parts: int) -> np.ndarray:
    """Block of a hash in the high half, its low 32 bits in the low half."""
    return ((h >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))


def _split(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of a sorted array."""
    if len(part):
        cut = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip(np.r_[0, cut].tolist(), np.r_[cut, len(part)].tolist(), strict=True):
            yield int(part[a]), slice(a, b)


def _packed(found: list[np.ndarray]) -> pa.RecordBatch:
    """Slots as one row per part: those seen once, and those seen more often with their counts."""
    keys = np.concatenate(found)
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(first, append=len(keys))
    keys = keys[first]
    low = keys.astype(np.uint32)
    rows = {"part": [], "one": [], "more": [], "times": []}
    for p, own in _split((keys >> np.uint64(32)).astype(np.int64)):
        single = counts[own] == 1
        rows["part"].append(p)
        rows["one"].append(low[own][single].tobytes())
        rows["more"].append(low[own][~single].tobytes())
        rows["times"].append(counts[own][~single].astype(np.int64).tobytes())
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64()), ("one", pa.binary()), ("more", pa.binary()), ("times", pa.binary())]))


def _count_blocks(parts: int):
    def run(batches):
        hasher, found, held = Hasher(), [], 0
        for batch in batches:
            for _, texts in blocks(batch.column(0)):
                found.append(_slots(np.concatenate(shingle_sets(hasher, texts)), parts))
                held += len(found[-1])
                if held >= COUNTED_AT_ONCE:
                    yield _packed(found)
                    found, held = [], 0
        if held:
            yield _packed(found)

    return run


def _gathered(batches, columns: list[str]) -> Iterator[tuple[int, dict[str, bytes]]]:
    """The blobs of each part, joined."""
    held: dict[int, dict[str, list[bytes]]] = {}
    for batch in batches:
        cells = {c: batch.column(c).to_pylist() for c in columns}
        for i, p in enumerate(batch.column("part").to_pylist()):
            own = held.setdefault(p, {c: [] for c in columns})
            for c in columns:
                own[c].append(cells[c][i])
    while held:
        p, own = held.popitem()
        yield p, {c: b"".join(v) for c, v in own.items()}


def _frequent_of(least: int):
    def run(batches):
        for p, blob in _gathered(batches, ["one", "more", "times"]):
            low = np.frombuffer(blob["one"] + blob["more"], dtype=np.uint32)
            times = np.r_[np.ones(len(blob["one"]) // 4, dtype=np.int64), np.frombuffer(blob["times"], dtype=np.int64)]
            order = np.argsort(low, kind="stable")
            low, times = low[order], times[order]
            first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]) if len(low) else np.empty(0, dtype=np.int64)
            total = np.add.reduceat(times, first) if len(first) else times
            often = total >= least
            slot = (low[first][often].astype(np.uint64) | np.uint64(p) << np.uint64(32)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"slot": slot, "df": total[often]}, schema=pa.schema([("slot", pa.int64()), ("df", pa.int64())]))

    return run


class _Order:
    """The prefix of a set in the order of shingles."""

    def __init__(self, slots: np.ndarray, ranks: np.ndarray, parts: int):
        self.slots, self.ranks, self.parts = slots, ranks, parts

    def prefix(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Prefix shingles with their slots, and how many of them are rare."""
        n = len(own)
        p = n - (4 * n + 4) // 5 + 1
        slot = _slots(own, self.parts)
        if not len(self.slots):
            return own[:p], slot[:p], min(p, n)
        at = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        often = self.slots[at] == slot
        rare = np.flatnonzero(~often)[:p]
        rest = np.flatnonzero(often)
        rest = rest[np.argsort(self.ranks[at[rest]], kind="stable")][: p - len(rare)]
        picked = np.r_[rare, rest]
        return own[picked], slot[picked], len(rare)


def _group_key(n: int, prefix: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(prefix.tobytes(), digest_size=8, salt=n.to_bytes(8, "little")).digest(), "little", signed=True)


def _signature(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


_DIGEST = "doc_id long, n long, sig binary, gkey long, often array<struct<slot:long,pos:int>>"


def _digests(order):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("gkey", pa.int64()), ("often", pa.list_(pa.struct([("slot", pa.int64()), ("pos", pa.int32())])))]
    )

    def run(batches):
        hasher, known = Hasher(), order.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in blocks(batch.column(1)):
                rows = {f.name: [] for f in schema}
                for k, own in enumerate(shingle_sets(hasher, texts)):
                    prefix, slot, rare = known.prefix(own) if len(own) else (own, own, 0)
                    rows["doc_id"].append(ids[first + k])
                    rows["n"].append(len(own))
                    rows["sig"].append(_signature(own))
                    rows["gkey"].append(_group_key(len(own), prefix))
                    rows["often"].append([{"slot": s, "pos": rare + i} for i, s in enumerate(slot[rare:].astype(np.int64).tolist())])
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


def _prefix_blocks(order):
    def run(batches):
        hasher, known = Hasher(), order.value
        for batch in batches:
            slots, keys, sizes, places, seen = [], [], [], [], set()
            for _, texts in blocks(batch.column(0)):
                for own in shingle_sets(hasher, texts):
                    if not len(own):
                        continue
                    prefix, slot, rare = known.prefix(own)
                    key = _group_key(len(own), prefix)
                    if rare and key not in seen:
                        seen.add(key)
                        slots.append(slot[:rare])
                        keys.append(np.full(rare, key, dtype=np.int64))
                        sizes.append(np.full(rare, len(own), dtype=np.uint32))
                        places.append(np.arange(rare, dtype=np.uint32))
            if not slots:
                continue
            slot = np.concatenate(slots)
            by = np.argsort(slot >> np.uint64(32), kind="stable")
            slot, cells = slot[by], [np.concatenate(x)[by] for x in (keys, sizes, places)]
            rows = {"part": [], "low": [], "gkey": [], "n": [], "pos": []}
            for p, own in _split((slot >> np.uint64(32)).astype(np.int64)):
                rows["part"].append(p)
                rows["low"].append(slot[own].astype(np.uint32).tobytes())
                for name, cell in zip(("gkey", "n", "pos"), cells, strict=True):
                    rows[name].append(cell[own].tobytes())
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64())] + [(c, pa.binary()) for c in ("low", "gkey", "n", "pos")]))

    return run


def _rare_pairs(batches):
    """Group pairs that share a rare prefix shingle, by lists of equal shingles."""
    schema = pa.schema([("ga", pa.int64()), ("gb", pa.int64())])
    for _, blob in _gathered(batches, ["low", "gkey", "n", "pos"]):
        low, key = np.frombuffer(blob["low"], dtype=np.uint32), np.frombuffer(blob["gkey"], dtype=np.int64)
        n, pos = (np.frombuffer(blob[c], dtype=np.uint32).astype(np.int64) for c in ("n", "pos"))
        order = np.lexsort((key, low))
        low, key, n, pos = low[order], key[order], n[order], pos[order]
        new = np.r_[True, (low[1:] != low[:-1]) | (key[1:] != key[:-1])] if len(low) else np.empty(0, dtype=bool)
        low, key, n, pos = low[new], key[new], n[new], pos[new]
        active = np.arange(len(low))
        lag = 1
        while len(active := active[active + lag < len(low)]) and len(active := active[low[active] == low[active + lag]]):
            a, b = active, active + lag
            most = np.minimum(n[a] - pos[a], n[b] - pos[b])
            fits = (9 * most >= 4 * (n[a] + n[b])) & (5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b]))
            a, b = a[fits], b[fits]
            if len(a):
                pairs = np.unique(np.stack([key[a], key[b]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=schema)
            lag += 1


def _sets(batches):
    schema = pa.schema([("sig", pa.binary()), ("shingles", pa.list_(pa.int64()))])
    hasher = Hasher()
    for batch in batches:
        for _, texts in blocks(batch.column(0)):
            found = shingle_sets(hasher, texts)
            yield pa.RecordBatch.from_pydict({"sig": [_signature(x) for x in found], "shingles": [x.view(np.int64) for x in found]}, schema=schema)


def _may_match(n1: str, p1: str, n2: str, p2: str) -> Column:
    return F.expr(f"9 * least({n1} - {p1}, {n2} - {p2}) >= 4 * ({n1} + {n2}) and 5 * least({n1}, {n2}) >= 4 * greatest({n1}, {n2})")


def _verified(docs: DataFrame, pairs: DataFrame, spent: list[DataFrame] | None = None) -> DataFrame:
    """Links (a, b) of representatives among class pairs (sa, a, sb, b), decided on the whole sets.

    The stored frames it reads are added to ``spent``, to be released once the links are stored.
    """
    ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = docs.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(_sets, "sig binary, shingles array<long>")
    sets = stored(sets.groupBy("sig").agg(F.first("shingles").alias("shingles")), "sets")
    if spent is not None:
        spent += [ids, sets]
    left = sets.select(F.col("sig").alias("sa"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("sig").alias("sb"), F.col("shingles").alias("xb"))
    both = pairs.join(left, "sa").join(right, "sb")
    common = F.size(F.array_intersect("xa", "xb"))
    return both.where(100 * common >= 80 * (F.size("xa") + F.size("xb") - common)).select("a", "b")


def _expanded(gpairs: DataFrame, classes: DataFrame, pivots_only: bool) -> DataFrame:
    """Class pairs of group pairs; of large ones at first only those with the first class of a group."""
    a, b = (classes.select(*[F.col(c).alias(f"{c}_{x}") for c in classes.columns]) for x in "ab")
    both = gpairs.join(a, F.col("ga") == F.col("gkey_a")).join(b, F.col("gb") == F.col("gkey_b"))
    apart = "(ga <> gb or sig_a < sig_b)"
    if pivots_only:
        apart += f" and (size_a * size_b <= {CLASS_PAIRS} or lead_a or lead_b)"
    else:
        apart += " and c_a <> c_b"
    return both.where(apart).select(F.col("sig_a").alias("sa"), F.col("rep_a").alias("a"), F.col("sig_b").alias("sb"), F.col("rep_b").alias("b"))


def jaccard_components(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of documents (doc_id, text; other columns are ignored).

    Null and empty texts, and texts without words, have no shingles, are linked
    with nothing and are their own component. Rows with the same doc_id are one
    document: their links are joined. Rows with a null doc_id get their
    n_shingles and a null component and link nothing. An empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = docs.select("text")
    parts = max(texts.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    counted = texts.mapInArrow(_count_blocks(parts), "part long, one binary, more binary, times binary")
    often = counted.repartition(parts, "part").mapInArrow(_frequent_of(FREQUENT), "slot long, df long")
    frequent = stored(often.orderBy(F.desc("df"), "slot").limit(FREQUENT_KEPT), "frequent")
    kept = frequent.toPandas()
    released(frequent)
    slots = kept["slot"].to_numpy(dtype=np.uint64)
    ranks = np.lexsort((slots, kept["df"].to_numpy(dtype=np.int64))).argsort()
    by = np.argsort(slots)
    order = spark.sparkContext.broadcast(_Order(slots[by], ranks[by], parts))

    digest = stored(docs.mapInArrow(_digests(order), _DIGEST), "digests")
    known = digest.where("n > 0 and doc_id is not null")
    classes = known.groupBy("gkey", "sig", "n").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    sizes = classes.groupBy("gkey").agg(F.count("*").alias("size"), F.min("sig").alias("least"))
    plain, classes = classes, stored(classes.join(sizes, "gkey").select("gkey", "sig", "rep", "size", (F.col("sig") == F.col("least")).alias("lead")), "classes")
    released(plain)

    packed = texts.mapInArrow(_prefix_blocks(order), "part long, low binary, gkey binary, n binary, pos binary")
    rare = packed.repartition(parts, "part").mapInArrow(_rare_pairs, "ga long, gb long")

    lists = (
        known.where(F.size("often") > 0)
        .groupBy("gkey", "n")
        .agg(F.first("often").alias("often"))
        .select("gkey", "n", F.explode("often").alias("o"))
        .select(F.col("o.slot").alias("slot"), "gkey", "n", F.col("o.pos").cast("long").alias("pos"))
    )
    lists = stored(lists, "lists")
    nearest = F.struct((F.col("pos") / F.col("n")).alias("share"), "gkey", "n", "pos")
    pivots = lists.groupBy("slot").agg(F.min(nearest).alias("p")).select("slot", F.col("p.gkey").alias("pg"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp"))
    star = lists.join(pivots, "slot").where(F.col("gkey") != F.col("pg")).where(_may_match("n", "pos", "pn", "pp"))
    pair = [F.least("gkey", "pg").alias("ga"), F.greatest("gkey", "pg").alias("gb")]
    gpairs = rare.union(star.select(*pair)).distinct()
    within = classes.where("size > 1 and lead").select(F.col("gkey").alias("ga"), F.col("gkey").alias("gb"))
    gpairs = stored(gpairs.union(within), "group-pairs")

    spent: list[DataFrame] = [stored(_expanded(gpairs, classes, True), "class-pairs")]
    links = _verified(docs, spent[0], spent)
    repeated = known.join(classes, ["gkey", "sig"]).groupBy("doc_id", "rep").agg(F.count("*").alias("k"))
    repeated = repeated.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    twice = repeated.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("last")).where("b <> last").select("a", F.col("b").alias("first"))
    same = repeated.join(twice, "a").select(F.col("first").alias("a"), "b").where("a <> b")
    links = stored(links.union(same).distinct(), "links")
    released(*spent)
    found = components(spark, links)

    labelled = classes.join(found, classes.rep == found.node, "left").select(classes["*"], F.coalesce("component", "rep").alias("c"))
    labelled = stored(labelled, "classes")
    group = labelled.groupBy("gkey").agg(F.min("c").alias("c1"), F.max("c").alias("c2"))
    placed = stored(lists.join(group, "gkey"), "lists")
    released(lists)
    open_lists = placed.groupBy("slot").agg(F.min("c1").alias("m1"), F.max("c2").alias("m2"), F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), "gkey", "c1")).alias("p"))
    open_lists = open_lists.where("m1 <> m2").select("slot", F.col("p.c1").alias("main"))
    rest = placed.join(open_lists, "slot")
    few = rest.where("c1 <> main or c2 <> main").select("slot", F.col("gkey").alias("pg"), F.col("n").alias("pn"), F.col("pos").alias("pp"), F.col("c1").alias("d1"), F.col("c2").alias("d2"))
    apart = rest.join(few, "slot").where("gkey <> pg and not (c1 = c2 and d1 = d2 and c1 = d1)").where(_may_match("n", "pos", "pn", "pp"))
    wide = labelled.select("gkey", "size").distinct()
    large = (
        gpairs.join(wide.select(F.col("gkey").alias("ga"), F.col("size").alias("x")), "ga")
        .join(wide.select(F.col("gkey").alias("gb"), F.col("size").alias("y")), "gb")
        .where(F.col("x") * F.col("y") > CLASS_PAIRS)
        .select("ga", "gb")
    )
    again = stored(_expanded(apart.select(*pair).union(large).distinct(), labelled, False), "class-pairs")
    released(placed, gpairs, labelled)
    if not again.isEmpty():
        spent = [again]
        more = stored(_verified(docs, again, spent).union(links), "links")
        released(links, found, *spent)
        found = components(spark, more)
        released(more)
    else:
        released(again, links)

    member = known.select("doc_id", "sig", "gkey").distinct().join(classes, ["gkey", "sig"]).select("doc_id", "sig", "rep")
    member = member.join(found, member.rep == found.node, "left").select("doc_id", "sig", F.coalesce("component", "rep").alias("c"))
    out = digest.join(member, ["doc_id", "sig"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", own).alias("component_id"))
