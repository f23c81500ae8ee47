"""op11: the Merkle manifest against a plain restatement, on given and hard tables, in one pass and in several."""

import brute
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fieldstats.llm import manifest
from fieldstats.llm.queries import QUERIES

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _expected(rows):
    return sorted(brute.manifest(rows), key=repr)


def _write(folder, rows, extra=False):
    cols = list(zip(*rows)) if rows else [[] for _ in COLUMNS]
    table = pa.table(
        {
            "doc_id": pa.array(cols[0], pa.int64()),
            "text": pa.array(cols[4], pa.string()),
            "lang": pa.array(cols[2], pa.string()),
            "source": pa.array(cols[1], pa.string()),
            "n_chars": pa.array(cols[3], pa.int64()),
            **({"leaf": pa.array(["x"] * len(rows), pa.string()), "root": pa.array([1] * len(rows), pa.int64())} if extra else {}),
        }
    )
    pq.write_table(table, f"{folder}/documents.parquet")


HARD = [
    (1, "web", "en", 5, "Hello"),
    (1, "web", "en", 5, "Hello"),  # a repeated row
    (2, None, "en", None, None),
    (None, "code", None, 0, ""),
    (3, "web", "", 3, "ABC"),
    (4, "wiki", "de", 9, "Ärger ÜBER"),
    (5, "wiki", "zz", 30_000, "Word " * 6000),
    *[(100 + i, "web", "en", 4, f"T{i}xY") for i in range(70)],
]


@pytest.mark.parametrize("depth", [1, 3])
def test_hard_rows(spark, tmp_path, monkeypatch, depth):
    monkeypatch.setattr(manifest, "DEPTH", depth)
    monkeypatch.setattr(manifest, "BLOCK", manifest.FANOUT**depth)
    _write(tmp_path, HARD, extra=True)
    got = _result(QUERIES["op11_manifest"](spark, str(tmp_path)))
    assert got == _expected(HARD)
    assert {r[3] for r in got} == {got[0][3]} and any(not r[6] for r in got) and any(r[6] for r in got)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS).collect()]
    assert _result(QUERIES["op11_manifest"](spark, "/root/testdata/sf0.001")) == _expected(rows)


def test_one_row_and_empty(spark, tmp_path):
    one = tmp_path / "one"
    one.mkdir()
    _write(one, [(7, "s", "en", 1, "A")])
    got = _result(QUERIES["op11_manifest"](spark, str(one)))
    assert got == _expected([(7, "s", "en", 1, "A")]) and got[0][1] == got[0][2] == got[0][3]
    empty = tmp_path / "empty"
    empty.mkdir()
    _write(empty, [])
    assert QUERIES["op11_manifest"](spark, str(empty)).count() == 0


def test_hot_group_is_numbered_by_many_tasks(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "'s' as source", "'en' as lang", "1L as n_chars", "cast(id as string) as text")
    ranked = manifest.ranked(rows.selectExpr("doc_id", "lang as seq"), "seq", [rows.doc_id])
    assert ranked.selectExpr("min(pos)", "max(pos)", "count(distinct pos)", "max(total)").first() == (0, 4999, 5000, 5000)
