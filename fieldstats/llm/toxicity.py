"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; the model of a category sees, next
to the words, the probabilities of all categories before it. In training these
come from models that have not seen the row (out-of-fold predictions).

Features are the presence of words and of the first 4 and 5 bytes of words,
hashed. The models are fitted on a bounded sample of labelled rows; every
document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.llm.words import Hasher, blocks, separators

#: Labelled rows per value of the last category that the models are fitted on (smallest hashes of doc_id).
FIT_ROWS = 4_000
#: Hashed features, and how many of them a model keeps.
HASHED, KEPT = 1 << 20, 4_096
#: Least z value of the difference in frequency of a kept feature, and least rows that have it.
LEAST_Z, LEAST_ROWS = 4.5, 4
#: Features that a fit spreads out at once; the runs' sums are the same for any number.
PART = 1 << 18
FOLDS = 5
THRESHOLD = 0.5
_PREFIXES = (4, 5)


def _features(hasher: Hasher, texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashed features of each text."""
    owner, *hashes = hasher.words(texts, _PREFIXES)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    cells = np.stack(hashes) & np.uint64(HASHED - 1)
    return [np.unique(cells[:, cuts[k] : cuts[k + 1]]).astype(np.int32) for k in range(len(texts))]


def _sample_features(batches):
    hasher = Hasher(separators(letters_only=True))
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.binary())])
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for first, block in blocks(batch.column("text")):
            found = [x.tobytes() for x in _features(hasher, block)]
            yield pa.RecordBatch.from_pydict({"doc_id": ids[first : first + len(block)], "features": found}, schema=schema)


def _parts(rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and the row of each, in runs of whole rows of about PART features, so that a fit holds one run at a time."""
    ends = np.cumsum([len(r) for r in rows])
    first = 0
    while first < len(rows):
        before = int(ends[first]) - len(rows[first])
        stop = max(first + 1, int(np.searchsorted(ends, before + PART, side="right")))
        run = rows[first:stop]
        yield np.concatenate(run), np.repeat(np.arange(first, stop), [len(r) for r in run])
        first = stop


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic regression on chosen binary features and the chain's earlier probabilities."""

    def __init__(self, rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, rounds: int = 200, ridge: float = 1e-4):
        n, positive = len(y), int(y.sum())
        self.keep = np.empty(0, dtype=np.int32)
        self.bias = np.log((positive + 0.5) / (n - positive + 0.5)) if n else -30.0
        self.weight, self.chain = np.zeros(0), np.zeros(before.shape[1])
        if not n or positive in (0, n):
            return
        with_it, positive_with = np.zeros(HASHED, dtype=np.int64), np.zeros(HASHED, dtype=np.int64)
        for flat, owner in _parts(rows):
            with_it += np.bincount(flat, minlength=HASHED)
            positive_with += np.bincount(flat[y[owner] == 1], minlength=HASHED)
        seen = np.flatnonzero(with_it >= LEAST_ROWS)
        with_it, positive_with = with_it[seen], positive_with[seen]
        share = with_it / n
        spread = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / positive + 1 / (n - positive)))
        z = np.abs(positive_with / positive - (with_it - positive_with) / (n - positive)) / spread
        chosen = np.argsort(-z, kind="stable")[:KEPT]
        self.keep = np.sort(seen[chosen[z[chosen] >= LEAST_Z]]).astype(np.int32)
        self.weight = np.zeros(len(self.keep))
        held = [(at[has], owner[has]) for flat, owner in _parts(rows) for at, has in [self._columns(flat)]]
        column, owner = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        step_w, step_c, step_b = np.zeros_like(self.weight), np.zeros_like(self.chain), 0.0
        # Both classes weigh alike, so that a rare category is not held below the threshold.
        each = np.where(y == 1, 0.5 / positive, 0.5 / (n - positive))
        self.bias, rate = 0.0, 2.0
        for _ in range(rounds):
            score = self.bias + before @ self.chain + np.bincount(owner, self.weight[column], minlength=n)
            error = (_sigmoid(score) - y) * each
            grad_w = np.bincount(column, error[owner], minlength=len(self.weight)) + ridge * self.weight
            step_w = 0.9 * step_w - rate * grad_w
            step_c = 0.9 * step_c - rate * (before.T @ error + ridge * self.chain)
            step_b = 0.9 * step_b - rate * 0.1 * error.sum()
            self.weight, self.chain, self.bias = self.weight + step_w, self.chain + step_c, self.bias + step_b

    def _columns(self, features: np.ndarray):
        if not len(self.keep):
            return np.zeros(len(features), dtype=np.int64), np.zeros(len(features), dtype=bool)
        at = np.minimum(np.searchsorted(self.keep, features), len(self.keep) - 1)
        return at, self.keep[at] == features

    def probability(self, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        inside = np.zeros(len(rows))
        for flat, owner in _parts(rows) if len(self.weight) else ():
            column, has = self._columns(flat)
            inside += np.bincount(owner[has], self.weight[column[has]], minlength=len(rows))
        return _sigmoid(self.bias + before @ self.chain + inside)


def chain_of(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of labels, each trained with out-of-fold probabilities of those before."""
    before, models = np.zeros((len(rows), 0)), []
    for y in labels.T:
        models.append(Linear(rows, before, y))
        apart = np.zeros(len(rows))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(folds != k), np.flatnonzero(folds == k)
            model = Linear([rows[i] for i in inside], before[inside], y[inside])
            apart[outside] = model.probability([rows[i] for i in outside], before[outside])
        before = np.column_stack([before, apart])
    return models


def chained(models: list[Linear], rows: list[np.ndarray]) -> np.ndarray:
    """Probabilities, one column per category."""
    before = np.zeros((len(rows), 0))
    for model in models:
        before = np.column_stack([before, model.probability(rows, before)])
    return before


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, categories: list[str]) -> list[Linear]:
    """The chain for the 0/1 columns of labels named in categories, in this order.

    Rows of labels without doc_id or with a null category are not used; of
    repeated rows a category's largest value counts. Without rows of both
    values a model gives the same small or large probability to all.
    """
    known = labels.dropna(subset=["doc_id", *categories]).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(*[F.max(F.col(c).cast("int")).alias(f"y{k}") for k, c in enumerate(categories)])
    last = f"y{len(categories) - 1}"
    picked = [known.where(F.col(last) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS) for v in (0, 1)]
    chosen = picked[0].union(picked[1])
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    found = own.mapInArrow(_sample_features, "doc_id long, features binary").groupBy("doc_id").agg(F.min("features").alias("features"))
    table = chosen.join(found, "doc_id").toPandas().sort_values("doc_id")
    rows = [np.frombuffer(x, dtype=np.int32) for x in table["features"]]
    y = table[[f"y{k}" for k in range(len(categories))]].to_numpy(dtype=np.int64).reshape(len(rows), len(categories))
    return chain_of(rows, y, np.arange(len(rows)) % FOLDS)


def _score(models, schema: pa.Schema):
    def run(batches):
        hasher = Hasher(separators(letters_only=True))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, block in blocks(batch.column("text")):
                p = chained(models.value, _features(hasher, block))
                columns = [ids[first : first + len(block)], *p.T, p[:, -1] >= THRESHOLD]
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)

    return run


def _accept(models):
    def run(batches):
        hasher = Hasher(separators(letters_only=True))
        for batch in batches:
            good = [chained(models.value, _features(hasher, block))[:, -1] < THRESHOLD for _, block in blocks(batch.column("text"))]
            yield batch.filter(pa.array(np.concatenate(good))) if good else batch

    return run


def scored(spark: SparkSession, documents: DataFrame, models: list[Linear], categories: list[str]) -> DataFrame:
    """(doc_id, p_<category>..., rejected) per row of documents, by its whole text.

    rejected: the last category's probability is THRESHOLD or more. A null text
    is scored as an empty one; null and repeated ids are passed on row by row.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(f"p_{c}", pa.float64()) for c in categories], ("rejected", pa.bool_())])
    kinds = "doc_id long, " + ", ".join(f"`p_{c}` double" for c in categories) + ", rejected boolean"
    told = spark.sparkContext.broadcast(models)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(told, schema), kinds)


def accepted(spark: SparkSession, documents: DataFrame, models: list[Linear]) -> DataFrame:
    """The rows of documents, with all their columns, that are not rejected."""
    return documents.mapInArrow(_accept(spark.sparkContext.broadcast(models)), documents.schema)
