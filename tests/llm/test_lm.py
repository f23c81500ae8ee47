"""op13: Kneser-Ney scores from the memory-mapped arrays against a plain restatement."""

import math
import os
import random
import time
from urllib.parse import urlparse

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fieldstats.llm import lm
from fieldstats.llm.queries import QUERIES
from fieldstats.session import scratch_path


def _write(folder, rows, extra=False):
    ids, texts = (list(x) for x in zip(*rows)) if rows else ([], [])
    cols = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}
    if extra:
        cols |= {"score": pa.array([1.0] * len(rows)), "row": pa.array(["x"] * len(rows))}
    pq.write_table(pa.table(cols), f"{folder}/documents.parquet")


def _same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[5], r[6])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


TEXTS = [
    "the cat sat on the mat",
    "The Cat sat on the MAT",
    "the dog sat on the log",
    "",
    None,
    "a a a a a a b",
    "\t\n  ",
    "new words never seen éé </s>",
    "the cat " * 3000,
]


def test_hard_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "FILE_ROWS", 7)  # many array files
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, "the cat"), (2, "held or not")]
    _write(tmp_path, rows, extra=True)
    got = [tuple(r) for r in QUERIES["op13_lm_scores"](spark, str(tmp_path)).collect()]
    _same(got, brute.lm_scores(rows))
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_lm_scores"](spark, "/root/testdata/sf0.001").collect()]
    _same(got, brute.lm_scores(rows))


def test_empty_and_no_training_rows(spark, tmp_path):
    empty = tmp_path / "e"
    empty.mkdir()
    _write(empty, [])
    assert QUERIES["op13_lm_scores"](spark, str(empty)).count() == 0
    held = tmp_path / "h"
    held.mkdir()
    ids = [i for i in range(200) if brute.zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [(i, "only held out text") for i in ids]
    _write(held, rows)
    got = [tuple(r) for r in QUERIES["op13_lm_scores"](spark, str(held)).collect()]
    _same(got, brute.lm_scores(rows))
    assert all(r[6] == 0.0 for r in got)


def _prose(n, words, seed=11):
    """Rows of invented text, most of its trigrams seen once, some of them on both sides of the split."""
    rnd = random.Random(seed)
    pick = lambda: f"w{int(rnd.paretovariate(0.6)) % 5000}"
    texts = [" ".join(pick() for _ in range(words)) for _ in range(n)]
    return [(i, " ".join([t, *texts[i - 1].split()[: words // 4]])) for i, t in enumerate(texts)]


def test_ngrams_seen_once_on_both_sides_of_the_split(spark, tmp_path):
    rows = _prose(120, 40)
    _write(tmp_path, rows)
    got = [tuple(r) for r in QUERIES["op13_lm_scores"](spark, str(tmp_path)).collect()]
    _same(got, brute.lm_scores(rows))


def _bytes_left(spark):
    """Bytes of shuffle files and of the scratch folder of this session."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    root = urlparse(scratch_path(spark, "x").rsplit("/", 1)[0]).path
    files |= {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def test_disk_a_token(spark, tmp_path):
    """Counting leaves no shuffle files, and the model less than 8 bytes a token (before: 28 of both)."""
    rows = _prose(1000, 160)
    _write(tmp_path, rows)
    before = _bytes_left(spark)
    QUERIES["op13_lm_scores"](spark, str(tmp_path))
    tokens = sum(len(t.split()) + 1 for _, t in rows)
    for _ in range(50):  # files are removed in the background
        left = (_bytes_left(spark) - before) / tokens
        if left < 8:
            break
        time.sleep(0.2)
    assert left < 8


class _Held:
    def __init__(self, value):
        self.value = value


def _scores_here(model, rows):
    """Scores of (doc_id, text), all of them training rows, in this process; and how often an array file was searched."""
    ids, texts = zip(*rows)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([True] * len(rows)), pa.array(ids, pa.int64())], names=["text", "train", "doc_id"])
    searched = []
    plain = lm._mapped
    lm._mapped = lambda path: (searched.append(path) if path.endswith("keys.npy") else None, plain(path))[1]
    try:
        out = pa.Table.from_batches(lm._scores(_Held(model))([batch])).to_pylist()
    finally:
        lm._mapped = plain
    return [tuple(r.values()) for r in out], len(searched)


def test_blocks_of_texts_share_their_lookups(spark, monkeypatch):
    """Twenty blocks of texts search each file once (before: once a block), with the scores of texts looked up alone."""
    rows = [*enumerate([*TEXTS, *(t for _, t in _prose(1000, 900))])]
    docs = spark.createDataFrame([(t, True) for _, t in rows], "text string, train boolean")
    model = lm.fit(spark, docs)
    monkeypatch.setattr(lm, "SCORE_AT_ONCE", 1 << 24, raising=False)
    together, searched = _scores_here(model, rows)
    files = sum(len(parts) for parts in model.tables.values())
    assert files <= searched <= files + 3
    monkeypatch.setattr(lm, "SCORE_AT_ONCE", 1)
    alone, more = _scores_here(model, rows)
    assert together == alone and more > 5 * searched


def test_each_distinct_hash_is_looked_up_once(tmp_path):
    keys = np.array([3, 5, 1 << 63, (1 << 64) - 1], dtype=np.uint64)
    values = np.array([[1, 7], [2, 7], [2, 7], [4, 9]])
    parts = [(int(k[0]), lm._save(str(tmp_path), k, v)) for k, v in ((keys[:2], values[:2]), (keys[2:], values[2:]))]
    wanted = np.array([5, 0, 5, (1 << 64) - 1, 4, 1 << 63, 5, 3], dtype=np.uint64)
    rows, at = lm.lookup(parts, 2, wanted)
    assert len(rows) == len(set(wanted.tolist()))
    known = dict(zip(keys.tolist(), values.tolist()))
    assert rows[at].tolist() == [known.get(h, [0, 0]) for h in wanted.tolist()]
    rows, at = lm.lookup([], 2, wanted)
    assert rows[at].tolist() == [[0, 0]] * len(wanted)


def test_positions_in_order_of_large_counts():
    rnd = random.Random(5)
    for top in (3, 1 << 40):  # one number, and too large for one
        rows = sorted(((rnd.randrange(9), rnd.randrange(top), rnd.choice([0, 1, top])) for _ in range(300)), key=lambda r: r[0])
        keys, ends, goes = (np.array(x) for x in zip(*rows))
        order = lm._ordered(keys.astype(np.uint64), ends, goes)
        assert (np.stack([keys, ends, goes])[:, order].T == np.array(sorted(rows))).all()
        assert (keys[order] == keys).all()
    none = np.empty(0, dtype=np.int64)
    assert len(lm._ordered(none.astype(np.uint64), none, none)) == 0
