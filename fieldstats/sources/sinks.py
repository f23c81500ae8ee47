"""Result tables: full refresh, append, once-per-day append, dated export."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable
import time
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Column
from pyspark.sql.functions import col, count, lit, shiftright, when, xxhash64
from pyspark.sql.functions import max as max_
from pyspark.sql.functions import sum as sum_
from pyspark.sql.types import StructType

#: Column of the run id in a log, and the folder of its commits.
RUN, COMMITS = "run", "_commits"
#: Folders beside a result refreshed by quarter: input fingerprints, quarters left empty.
FINGERPRINTS, EMPTY = "_fingerprints", "_empty"


def evenly_sized(df: DataFrame) -> DataFrame:
    """Let Spark merge small and split large output partitions before a write."""
    return df.hint("rebalance")


#: Versions of a replaced table kept beside the current one, for readers still on them.
KEEP_VERSIONS = 2


def _local(path: str) -> str | None:
    """The path on this machine for a mounted folder, None for other file systems."""
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    return None if "://" in path or ":" in path.split("/")[0] else path


def replace_table(df: DataFrame, name: str, root: str | None = None, keep: int = KEEP_VERSIONS) -> str:
    """Replace the catalog view ``name`` with the result; returns the folder of the new version.

    The result is written whole to a new version folder under ``root`` (default: the
    warehouse), and only then does one catalog statement point the view at it, so readers
    see the old rows or the new ones, and a run that fails leaves the old ones. Nothing is
    dropped or renamed; versions beyond the last ``keep`` are removed where the folder is
    mounted on the driver (elsewhere they stay, to be removed by the store's own rules).
    """
    spark = df.sparkSession
    base = (root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + "/" + name.replace(".", "/") + "__versions"
    version = f"{base}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(version)
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"create or replace view {quoted} as select * from parquet.`{version}`")
    local = _local(base)
    if local and os.path.isdir(local):
        for old in sorted(v for v in os.listdir(local) if v.startswith("v"))[: -(keep + 1) or None]:
            shutil.rmtree(os.path.join(local, old), ignore_errors=True)
    return version


def replace_folder(df: DataFrame, path: str) -> None:
    """Replace a parquet folder with the result (readers of the folder may meet the gap; see ``replace_table``)."""
    df.write.mode("overwrite").parquet(path)


def append_snapshot(df: DataFrame, path: str, day: date, column: str = "extract_date") -> None:
    """Append the result to a log, stamped and partitioned by its extract day."""
    df.withColumn(column, lit(day)).write.mode("append").partitionBy(column).parquet(path)


def write_snapshot_once(df: DataFrame, path: str, day: date, column: str = "extract_date") -> str:
    """Write the day's rows as a new run, then commit it; returns the run id.

    The rows go to their own folder (day, run), which nothing reads before the commit: one
    row (day, run, rows) appended to ``_commits`` afterwards. ``read_snapshots`` shows each
    day's last committed run only, so a second run of a day replaces it (with nothing if it is
    empty), and a run that fails half-way changes nothing. The plan runs once: the row count
    of the commit is observed while writing.
    """
    spark = df.sparkSession
    run = f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    stamped = df.observe(seen, count(lit(1)).alias("rows")).withColumn(column, lit(day)).withColumn(RUN, lit(run))
    stamped.write.mode("append").partitionBy(column, RUN).parquet(path)
    commit = spark.createDataFrame([(day, run, int(seen.get.get("rows", 0)))], f"{column} date, {RUN} string, rows bigint")
    commit.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{COMMITS}")
    return run


def read_snapshots(spark, path: str, schema: str | StructType | None = None, column: str = "extract_date") -> DataFrame:
    """The log written by ``write_snapshot_once``: for each day, the rows of its last committed run.

    ``schema`` (of the rows, without the day) is needed only where no run has rows yet.
    """
    commits = spark.read.parquet(f"{path.rstrip('/')}/{COMMITS}")
    last = commits.groupBy(column).agg(max_(RUN).alias(RUN))
    try:
        rows = spark.read.parquet(path)
    except AnalysisException:  # no run has written rows
        if schema is None:
            raise
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        rows = spark.createDataFrame([], fields.add(column, "date").add(RUN, "string"))
    same = (rows[column] == last[column]) & (rows[RUN] == last[RUN])
    return rows.join(last, same, "left_semi").drop(RUN)


def quarter_fingerprints(df: DataFrame, quarter: Column) -> DataFrame:
    """(quarter_index, rows, digest) of the input: a row count and an order-free sum of row hashes per quarter.

    The hashes are cut to their top 31 bits, so the sum cannot overflow below 2^32 rows a quarter.
    """
    return df.groupBy(quarter.alias("quarter_index")).agg(
        count(lit(1)).alias("rows"), sum_(shiftright(xxhash64(*[col(c) for c in df.columns]), 33)).alias("digest")
    )


def refresh_touched(
    build: Callable[[list[int]], DataFrame],
    inputs: DataFrame,
    input_quarter: Column,
    path: str,
    reach: int = 0,
) -> list[int]:
    """Rewrite only the quarters of a result partitioned by ``quarter_index`` whose input changed; returns them.

    The input is fingerprinted per quarter (one small aggregate, a row per quarter) and compared
    with the fingerprints of the last run. A changed, new or vanished input quarter q touches the
    result quarters q to q + ``reach`` (``reach``: how far a result looks back, e.g. 4 for
    trailing years). ``build(quarters)`` returns the result rows of those quarters; they replace
    their partitions (dynamic overwrite) and nothing else is written. Touched quarters left
    without rows are listed in ``_empty`` and hidden by ``read_refreshed``. The fingerprints are
    stored last, so a failed run is redone whole by the next one.
    """
    spark = inputs.sparkSession
    base = path.rstrip("/")
    now = {r["quarter_index"]: (r["rows"], r["digest"]) for r in quarter_fingerprints(inputs, input_quarter).collect()}
    try:
        before = {r["quarter_index"]: (r["rows"], r["digest"]) for r in spark.read.parquet(f"{base}/{FINGERPRINTS}").collect()}
    except AnalysisException:  # the first run
        before = {}
    changed = {q for q in now.keys() | before.keys() if now.get(q) != before.get(q)}
    touched = sorted({q + k for q in changed for k in range(reach + 1)})
    if not touched:
        return []
    out = build(touched).where(col("quarter_index").isin(touched))
    seen = Observation(f"refresh_{uuid.uuid4().hex}")
    counted = out.observe(seen, *[count(when(col("quarter_index") == q, 1)).alias(f"q{q}") for q in touched])
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("quarter_index").parquet(base)
    empty = {q for q in touched if not seen.get.get(f"q{q}", 0)}
    try:
        empty |= {r["quarter_index"] for r in spark.read.parquet(f"{base}/{EMPTY}").collect()} - set(touched)
    except AnalysisException:
        pass
    spark.createDataFrame([(q,) for q in sorted(empty)], "quarter_index int").coalesce(1).write.mode("overwrite").parquet(f"{base}/{EMPTY}")
    rows = [(q, n, d) for q, (n, d) in sorted(now.items())]
    spark.createDataFrame(rows, "quarter_index int, rows bigint, digest bigint").coalesce(1).write.mode("overwrite").parquet(f"{base}/{FINGERPRINTS}")
    return touched


def read_refreshed(spark, path: str) -> DataFrame:
    """The result kept by ``refresh_touched``, without quarters whose last refresh left no rows."""
    base = path.rstrip("/")
    rows = spark.read.parquet(base)
    return rows.join(spark.read.parquet(f"{base}/{EMPTY}"), "quarter_index", "left_anti")


def bucketed_copy(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a catalog table bucketed and sorted by ``key``; returns the table.

    Tables bucketed by the same key into the same number of buckets are joined and grouped on
    that key without a shuffle: each bucket of one meets the same bucket of the other. Written
    once, such copies serve every later query on the key; choose ``buckets`` near table size /
    200 MB, the same for all tables that meet.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def export_dated(df: DataFrame, folder: str, day: date, prefix: str = "MarketData") -> str:
    """Write CSV files to a folder named after the day; returns the folder."""
    path = f"{folder.rstrip('/')}/{prefix}_{day.isoformat()}"
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path
