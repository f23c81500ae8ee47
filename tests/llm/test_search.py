"""op12: hybrid term-at-a-time and document-at-a-time search against scoring every document."""

import brute
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fieldstats.llm import search
from fieldstats.llm.queries import QUERIES


def _write(folder, docs, queries):
    ids, texts = (list(x) for x in zip(*docs)) if docs else ([], [])
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "score": pa.array([1.0] * len(ids))}), f"{folder}/documents.parquet")
    qi, qt = (list(x) for x in zip(*queries)) if queries else ([], [])
    pq.write_table(pa.table({"item_id": pa.array(qi, pa.int64()), "text": pa.array(qt, pa.string()), "rank": pa.array(["x"] * len(qi))}), f"{folder}/benchmark.parquet")


def _run(spark, folder):
    return sorted((tuple(r) for r in QUERIES["op12_search"](spark, str(folder)).collect()), key=repr)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
DOCS = [
    (i, " ".join(WORDS[(i * j + i) % len(WORDS)] for j in range(1 + i % 9)) + (" Alpha ALPHA" if i % 5 == 0 else ""))
    for i in range(120)
] + [(7, "alpha beta"), (7, "alpha beta"), (None, "alpha gamma"), (500, None), (501, ""), (502, "ÄÖ x9 9x ü,ü;")]
QUERIES_ = [(1, "alpha"), (1, "alpha"), (2, "beta gamma beta"), (3, "kappa lambda mu nu"), (None, "alpha zeta"), (4, "unknown"), (5, None), (6, "ü x9")]


@pytest.mark.parametrize("short,block,chunk", [(2048, 50_000, 2048), (3, 16, 2), (0, 7, 1)])
def test_against_every_document(spark, tmp_path, monkeypatch, short, block, chunk):
    monkeypatch.setattr(search, "SHORT", short)
    monkeypatch.setattr(search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(search, "CHUNK", chunk)
    _write(tmp_path, DOCS, QUERIES_)
    assert _run(spark, tmp_path) == sorted(brute.search(DOCS, QUERIES_), key=repr)


def test_given_tables(spark, monkeypatch):
    monkeypatch.setattr(search, "SHORT", 40)
    monkeypatch.setattr(search, "BLOCK_POSTINGS", 64)
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    queries = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert _run(spark, folder) == sorted(brute.search(docs, queries), key=repr)


def test_empty(spark, tmp_path):
    _write(tmp_path, [], [(1, "alpha")])
    assert _run(spark, tmp_path) == []
