"""Exact top-k search by inner product on a bit-sliced index.

A block of vectors keeps, for each attribute, bitmaps of the highest bits of
its (shifted, non-negative) values. For a query the slices are added up with
carry-save bitmap arithmetic, each as often as the query's weight has it (a
negative weight takes the complement). The k-th largest sum is found from the
most significant slice of the total downward. The bits left out bound the
error, so all rows that could still be among the best are known; these are
scored exactly.

Queries and vectors meet in blocks: each block of queries goes once to every
share of the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slices kept of each attribute; rows of an index block; queries of a query block.
SLICES, BLOCK, QUERIES = 7, 8_192, 256
SCALE = 1024
#: Components up to this are scored in 64-bit integers, larger ones in exact ones, clipped to long at the end.
WIDE = 1 << 27

_INDEX = pa.schema([("dim", pa.int64()), ("share", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_LONG = 2**63 - 1


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): components as floor(1024 x); rows without id, or with null or non-finite components, left out."""
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    good &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


def _packed(rows: int, shares: int):
    """Blocks of up to ``rows`` vectors of one length; a task deals its blocks to the shares in turn, from its partition number."""

    def run(batches):
        context = TaskContext.get()
        number = context.partitionId() if context is not None else 0
        for batch in batches:
            ids, lists = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("v")
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                for at in range(0, len(own), rows):
                    part = own[at : at + rows]
                    v = flat[starts[part][:, None] + np.arange(dim)].astype(np.int64)
                    number += 1
                    share = [number % shares]
                    yield pa.RecordBatch.from_pydict({"dim": [dim], "share": share, "ids": [ids[part].astype(np.int64).tobytes()], "vectors": [v.tobytes()]}, schema=_INDEX)

    return run


class SlicedBlock:
    """The bit-sliced index of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dim = vectors.shape
        self.words = -(-n // 64)
        self.valid = self._bitmap(np.ones((1, n), dtype=bool))[0]
        self.low = int(vectors.min()) if vectors.size else 0
        high = int(vectors.max()) - self.low if vectors.size else 0
        self.shift = max(0, high.bit_length() - SLICES)
        kept = ((vectors.astype(object) - self.low if high > _LONG else vectors - self.low) >> self.shift).astype(np.int64)
        bits = ((kept.T[:, None, :] >> np.arange(SLICES)[None, :, None]) & 1).astype(bool)
        self.planes = self._bitmap(bits.reshape(dim * SLICES, n)).reshape(dim, SLICES, self.words)
        self.wide = bool(vectors.size) and int(np.abs(vectors.astype(np.float64)).max()) > WIDE

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits), self.words * 64), dtype=bool)
        padded[:, : bits.shape[1]] = bits
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def _sum(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of sum(|w| * kept) over the attributes, complements where w is negative."""
        size = np.abs(weights)
        sign = np.where(weights < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None, None]
        planes = self.planes ^ sign
        levels: list[list[np.ndarray]] = []
        for bit in range(int(size.max()).bit_length() if len(size) else 0):
            chosen = planes[(size >> bit) & 1 == 1]
            for j in range(SLICES):
                while len(levels) <= bit + j:
                    levels.append([])
                levels[bit + j].append(chosen[:, j])
        out, b = [], 0
        while b < len(levels):
            rows = np.concatenate(levels[b]) if levels[b] else np.empty((0, self.words), dtype=np.uint64)
            while len(rows) > 1:
                if b + 1 == len(levels):
                    levels.append([])
                if len(rows) == 2:
                    levels[b + 1].append((rows[:1] & rows[1:]))
                    rows = rows[:1] ^ rows[1:]
                else:
                    t = len(rows) // 3
                    x, y, z = rows[:t], rows[t : 2 * t], rows[2 * t : 3 * t]
                    odd = x ^ y
                    levels[b + 1].append((x & y) | (z & odd))
                    rows = np.concatenate([odd ^ z, rows[3 * t :]])
            out.append(rows[0] if len(rows) else np.zeros(self.words, dtype=np.uint64))
            b += 1
        return out

    def candidates(self, query: np.ndarray, k: int, without: int | None) -> np.ndarray:
        """Rows that can be among the k best."""
        allowed = self.valid.copy()
        if without is not None:
            for row in np.flatnonzero(self.ids == without).tolist():
                allowed[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        total = self._sum(query)
        left, got, best = allowed, 0, 0
        for b in range(len(total) - 1, -1, -1):
            with_bit = left & total[b]
            count = int(np.bitwise_count(with_bit).sum())
            if got + count >= k:
                left, best = with_bit, best | 1 << b
            else:
                got += count
                left = left & ~total[b]
        error = int(np.abs(query.astype(object)).sum()) * ((1 << self.shift) - 1) if len(query) else 0
        least = max(0, best - -(-error >> self.shift) - 1) if self.shift else best
        if got + int(np.bitwise_count(left).sum()) < k:
            least = 0
        above, equal = np.zeros_like(allowed), allowed
        for b in range(len(total) - 1, -1, -1):
            if least >> b & 1:
                equal = equal & total[b]
            else:
                above |= equal & total[b]
                equal = equal & ~total[b]
        picked = (above | equal).view(np.uint8)
        return np.flatnonzero(np.unpackbits(picked, bitorder="little")[: len(self.ids)])

    def best(self, query: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows, ties to the smaller id."""
        rows = self.candidates(query, k, without)
        if self.wide or (len(query) and int(np.abs(query.astype(np.float64)).max()) > WIDE):
            exact = self.vectors[rows].astype(object) @ query.astype(object) if len(query) else np.zeros(len(rows), dtype=object)
            scores = np.array([max(-_LONG - 1, min(_LONG, int(x))) for x in exact], dtype=np.int64)
        else:
            scores = self.vectors[rows] @ query
        order = np.lexsort((self.ids[rows], -np.maximum(scores, -_LONG)))[:k]
        return self.ids[rows][order], scores[order]


def _answers(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            key, block = None, None
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                raw = batch.column("ids")[i].as_buffer()
                if key is None or key != (hash(bytes(raw)), dim):
                    key = hash(bytes(raw)), dim
                    ids = np.frombuffer(raw, dtype=np.int64)
                    block = SlicedBlock(ids, np.frombuffer(batch.column("vectors")[i].as_buffer(), dtype=np.int64).reshape(len(ids), dim))
                own = np.frombuffer(batch.column("query_ids")[i].as_buffer(), dtype=np.int64)
                queries = np.frombuffer(batch.column("queries")[i].as_buffer(), dtype=np.int64).reshape(len(own), dim)
                rows = {f.name: [] for f in schema}
                for query_id, query in zip(own.tolist(), queries, strict=True):
                    ids, scores = block.best(query, k, query_id)
                    rows["query_id"] += [query_id] * len(ids)
                    rows["q"] += [query.tolist()] * len(ids)
                    rows["vec_id"] += ids.tolist()
                    rows["score"] += scores.tolist()
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return run


def top_k(spark: SparkSession, queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest integer inner products for each query.

    queries and vectors (vec_id, embedding). Candidates are all rows but those
    with the query's own vec_id; ties go to the smaller vec_id, then rows of a
    repeated vec_id count each. Vectors of other lengths than the query's have
    no score. Rows without vec_id, null vectors and vectors with null or
    non-finite components take no part. Equal queries are answered once; no
    queries or no vectors give no rows. Scores beyond 64 bits are clipped.
    """
    candidates = whole(vectors)
    shares = max(1, candidates.rdd.getNumPartitions())
    kinds = "dim long, share long, ids binary, vectors binary"
    index = candidates.mapInArrow(_packed(BLOCK, shares), kinds)
    asked = whole(queries).distinct().coalesce(max(1, shares // 4)).mapInArrow(_packed(QUERIES, 1), kinds)
    asked = asked.select("dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share"))
    met = index.join(asked, ["dim", "share"]).select("dim", "ids", "vectors", "query_ids", "queries")
    found = met.mapInArrow(_answers(k), "query_id long, q array<long>, vec_id long, score long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
