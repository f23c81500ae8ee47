"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions, broadcasts by measured size and
# splits skewed join partitions, also where that costs one more exchange. It only
# merges: set spark.sql.adaptive.coalescePartitions.initialPartitionNum (or
# spark.sql.shuffle.partitions) to shuffled bytes / 200 MB for large inputs.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the settings above."""
    builder = SparkSession.builder.appName("fieldstats")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the session names.

    Where ``spark.checkpoint.dir`` is unset a session on one machine gets a
    temporary folder; on a cluster that raises, since executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _fallback_roots.setdefault(app, "") or tempfile.mkdtemp(prefix="fieldstats-")
        _fallback_roots[app] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
