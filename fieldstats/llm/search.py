"""Ranked lexical search: every document scored for each query, the best k kept, exactly.

Hybrid term-at-a-time and document-at-a-time. Postings of query terms are counted by Spark.
Terms whose lists are short (at most ``SHORT`` documents) are summed term at a time by a join and
an aggregation into one accumulator per (query, document). Long lists are not joined: documents
are dealt into blocks by a hash of their row, and one task per block walks its part of the long
lists in document order (MaxScore): the accumulators of the block act as one more list whose
bound is their largest value, are scored first, and set the threshold of the k-th best; lists
whose bounds together stay below it are no longer walked, only probed (binary search) for the
documents that the other lists bring. The best k of each block are merged per query.

Score (integers, as in the query contract): w = floor(1000 ln((2N + 2) / (2 df + 1))),
m = 75 + (25 n N) div L, impact = w ((10^9 tf) div (1000 tf + 12 m)); a document's score for a
query sums qtf * impact over the query's distinct terms (qtf: repeats in the query).

Hard cases: null texts have no terms; documents without terms count in neither N nor L; repeated
document rows are separate documents (same doc_id and score, so they sit side by side); ties go
to the smaller doc_id, nulls last. Repeated query rows count once; rows of one query id pool
their terms; a null query id is a query of its own; a query without known terms returns nothing.
Only scores above 0 are returned. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstats.llm.components import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lists of at most this many documents are summed term at a time.
SHORT = 2048
#: Long-list postings per block of the document-at-a-time pass (a block's task holds them at once).
BLOCK_POSTINGS = 400_000
#: Query terms sent to the tasks at once (about: queries are dealt by hash); larger query sets run in several passes.
BATCH_TERMS = 200_000
#: Candidates scored between two updates of the threshold.
CHUNK = 2048
K = 20


def terms(text: Column) -> Column:
    """The maximal runs of TERM: the pieces between runs of the other characters."""
    pieces = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.filter(pieces, lambda p: p != "")


def _query_terms(queries: DataFrame) -> DataFrame:
    """(item, term, qtf): item is the query id as text ('' for null)."""
    rows = queries.select(F.coalesce(F.concat(F.lit("#"), F.col("item_id").cast("string")), F.lit("")).alias("item"), "text").distinct()
    return rows.select("item", F.explode(terms(F.col("text"))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("qtf"))


def _lookup(rows: np.ndarray, values: np.ndarray, probe: np.ndarray) -> np.ndarray:
    at = np.searchsorted(rows, probe)
    ok = at < len(rows)
    ok[ok] = rows[at[ok]] == probe[ok]
    out = np.zeros(len(probe), dtype=np.int64)
    out[ok] = values[at[ok]]
    return out


def _best(score: np.ndarray, doc: np.ndarray, null: np.ndarray, row: np.ndarray, k: int):
    order = np.lexsort((row, doc, null, -score))[:k]
    return score[order], doc[order], null[order], row[order]


def block_search(long_terms: dict[str, list[tuple[str, int]]], k: int = K):
    """The task of one block: (block, long postings, accumulators) to the block's best k per query.

    ``long_terms``: per query, its long terms and their repeats.
    """

    def run(key, post: pd.DataFrame, acc: pd.DataFrame) -> pd.DataFrame:
        post = post.sort_values("row", kind="stable")
        lists = {t: (g["row"].to_numpy(np.int64), g["impact"].to_numpy(np.int64)) for t, g in post.groupby("term", sort=False)}
        ids = pd.concat([post[["row", "doc", "null"]], acc[["row", "doc", "null"]]]).drop_duplicates("row").sort_values("row")
        id_rows = ids["row"].to_numpy(np.int64)
        id_null = ids["null"].to_numpy(bool)
        id_doc = ids["doc"].to_numpy(np.int64)
        by_item = dict(tuple(acc.groupby("item", sort=False)))
        out = []
        for item in set(by_item) | {i for i, ts in long_terms.items() if any(t in lists for t, _ in ts)}:
            a = by_item.get(item)
            a_rows = np.sort(a["row"].to_numpy(np.int64)) if a is not None else np.zeros(0, np.int64)
            a_vals = a.sort_values("row")["acc"].to_numpy(np.int64) if a is not None else np.zeros(0, np.int64)
            mine = [(lists[t][0], lists[t][1] * q) for t, q in long_terms.get(item, []) if t in lists]

            def full(cand: np.ndarray) -> np.ndarray:
                s = _lookup(a_rows, a_vals, cand)
                for rows, vals in mine:
                    s += _lookup(rows, vals, cand)
                return s

            def keep(best, cand):
                s = full(cand)
                pos = s > 0
                cand, s = cand[pos], s[pos]
                at = np.searchsorted(id_rows, cand)
                merged = [np.concatenate([b, x]) for b, x in zip(best, (s, id_doc[at], id_null[at], cand))]
                return _best(*merged, k)

            best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
            best = keep(best, a_rows)  # the accumulators: one list, scored first
            bounds = np.array([int(vals.max()) if len(vals) else 0 for _, vals in mine], dtype=np.int64)
            order = np.argsort(bounds, kind="stable")
            last = np.int64(np.iinfo(np.int64).min)
            while True:
                theta = int(best[0][-1]) if len(best[0]) == k else 1
                prefix = np.cumsum(bounds[order])
                essential = [mine[j] for j, c in zip(order, prefix) if c >= theta]
                if not essential:
                    break
                cand = np.unique(np.concatenate([rows[rows > last] for rows, _ in essential]))
                cand = cand[~np.isin(cand, a_rows)]
                if not len(cand):
                    break
                chunk = cand[:CHUNK]
                best = keep(best, chunk)
                last = chunk[-1]
            score, doc, null, _ = best
            out.append(pd.DataFrame({"item": item, "doc": doc, "null": null, "score": score}))
        if not out:
            return pd.DataFrame({"item": pd.Series([], dtype=str), "doc": np.zeros(0, np.int64), "null": np.zeros(0, bool), "score": np.zeros(0, np.int64)})
        return pd.concat(out, ignore_index=True)

    return run


def search(spark, docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Per query id of ``queries`` (item_id, text): item_id, rank, doc_id, score of its best k documents in ``docs`` (doc_id, text)."""
    qterms = stored(_query_terms(queries), "query_terms")
    vocabulary = qterms.select("term").distinct()
    if vocabulary.count() <= BATCH_TERMS:
        vocabulary = F.broadcast(vocabulary)
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("doc_id"), F.lit(0)).alias("doc"),
        F.col("doc_id").isNull().alias("null"),
        terms(F.col("text")).alias("t"),
    )
    # One pass over the texts: a row per (document, query term), and one with a null term per document for N and L.
    each = keyed.select("row", "doc", "null", F.size("t").alias("n"), F.explode(F.concat("t", F.array(F.lit(None).cast("string")))).alias("term"))
    asked = vocabulary.select("term", F.lit(True).alias("asked"))
    each = each.join(asked, "term", "left").where(F.col("term").isNull() | F.col("asked"))
    counted = stored(each.groupBy("row", "doc", "null", "n", "term").agg(F.count(F.lit(1)).alias("tf")), "postings")
    sizes = counted.where(F.col("term").isNull()).agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")
    ).first()
    post = counted.where(F.col("term").isNotNull())
    n_docs, length = int(sizes["N"]), int(sizes["L"])
    if not length:
        return _empty(spark)
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    stats = stored(df.select("term", "df", weight.alias("w")), "term_stats")
    m = F.lit(75) + F.expr(f"(25L * n * {n_docs}L) div {length}L")
    impact = F.col("w") * F.expr("(1000000000L * tf) div (1000L * tf + 12L * m)")
    post = post.join(F.broadcast(stats) if stats.count() <= BATCH_TERMS else stats, "term").withColumn("m", m)
    post = post.select("row", "doc", "null", "term", "df", impact.alias("impact"))

    found = []
    batches = stored(qterms.join(stats, "term").select("item", "term", "qtf", "df"), "batches")
    parts = max(1, -(-batches.count() // BATCH_TERMS))
    for part in range(parts):
        batch = batches.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        short = post.where(F.col("df") <= SHORT).join(F.broadcast(batch.where(F.col("df") <= SHORT).select("item", "term", "qtf")), "term")
        acc = short.groupBy("item", "row", "doc", "null").agg(F.sum(F.col("qtf") * F.col("impact")).alias("acc"))
        long = {}
        for r in batch.where(F.col("df") > SHORT).select("item", "term", "qtf").collect():  # about BATCH_TERMS rows
            long.setdefault(r["item"], []).append((r["term"], int(r["qtf"])))
        names = F.broadcast(batch.where(F.col("df") > SHORT).select("term", "df").distinct())
        long_postings = names.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
        block = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-long_postings // BLOCK_POSTINGS))))
        lp = post.where(F.col("df") > SHORT).join(names.select("term"), "term", "left_semi")
        # Both sides come from the same postings: new names keep the self-join check quiet.
        lp = lp.select(block.alias("block"), *[F.col(c).alias(c) for c in ("row", "doc", "null", "term", "impact")])
        acc = acc.select(block.alias("block"), *[F.col(c).alias(c) for c in ("item", "row", "doc", "null", "acc")])
        local = lp.groupBy("block").cogroup(acc.groupBy("block")).applyInPandas(
            block_search(long, k), "item string, doc long, null boolean, score long"
        )
        found.append(local)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.select("item", F.when(~F.col("null"), F.col("doc")).alias("doc_id"), "score")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    item_id = F.when(F.col("item") != "", F.substring("item", 2, 1 << 30).cast("long"))
    return out.select(item_id.alias("item_id"), F.col("rank").cast("int"), "doc_id", "score")


def _empty(spark) -> DataFrame:
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
