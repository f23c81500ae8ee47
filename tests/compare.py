"""Run queries against their SQL checks: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    if isinstance(value, str):
        return "s:" + value
    return str(pd.Timestamp(value)) if hasattr(value, "year") else str(value)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None where both give the same rows, else what differs."""
    result = con.sql(sql)
    expected_columns = list(result.columns)
    expected = result.fetchall()
    columns = spark_df.columns
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(set(columns) ^ set(expected_columns))}"
    got = normal(columns, [tuple(r) for r in spark_df.collect()])
    want = normal(expected_columns, expected)
    if got == want:
        return None if got else "no rows on either side"
    surplus, missing = Counter(got) - Counter(want), Counter(want) - Counter(got)
    note = f"{len(got)} rows, expected {len(want)}; {surplus.total()} surplus, {missing.total()} missing"
    names = sorted(columns)
    if surplus and missing:
        a = min(surplus)
        b = max(missing, key=lambda row: sum(x == y for x, y in zip(a, row, strict=True)))
        note += "; " + "; ".join(f"{n}: {x} != {y}" for n, x, y in zip(names, a, b, strict=True) if x != y)
        note += f" in {b}"
    return note


def kinds(spark_df, con, sql: str) -> list[str]:
    """Columns whose types differ between both sides."""
    same = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    result = con.sql(sql)
    theirs = dict(zip(result.columns, map(str, result.types), strict=True))
    return [
        f"{f.name}: {f.dataType.simpleString()} / {theirs.get(f.name)}"
        for f in spark_df.schema.fields
        if same.get(f.dataType.simpleString()) != theirs.get(f.name)
    ]


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    from fieldstats.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, checks = connect(folder), oracle_sql()
    for name, run in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            sql = checks.get(name)
            verdict = "no check" if sql is None else difference(df, con, sql)
            types = kinds(df, con, sql) if sql else []
            n = df.count()
        except Exception as error:  # noqa: BLE001
            verdict, types, n = f"ERROR {str(error)[:600]}", [], 0
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {n} rows {time.time() - start:.1f}s {verdict or ''} {types or ''}", flush=True)


if __name__ == "__main__":
    main()
