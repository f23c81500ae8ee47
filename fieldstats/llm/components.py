"""Connected components of a table of links."""

from __future__ import annotations

import os
import shutil
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstats.session import scratch_path


#: Removes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again, so that nothing before is computed twice or lost.

    The shuffle files of the write are removed with it: the stored rows replace them, and disk
    holds the shuffles of one step at a time instead of those of all steps.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def released(*frames: DataFrame) -> None:
    """Remove the folders of stored frames that nothing will read again.

    Only folders under the session's scratch folder are touched, and only where that
    folder is mounted on the driver; elsewhere (an object store) they stay, to be
    removed by the store's own rules. Call it once a later stored frame holds their rows.
    """
    for df in frames:
        spark = df.sparkSession
        root = urlparse(scratch_path(spark, "x").rsplit("/", 1)[0]).path.rstrip("/") + "/"
        for name in df.inputFiles():
            where = urlparse(name)
            if where.scheme not in ("", "file"):
                continue
            folder = os.path.dirname(where.path)
            if folder.startswith(root) and os.path.isdir(folder):
                shutil.rmtree(folder, ignore_errors=True)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for every node in links (a, b); component is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and
    then the label of its label, so chains shorten by jumps. Links of a node
    are pre-aggregated by the minimum, so a node with very many is no hot spot.
    """
    edges = links.where("a <> b").select("a", "b")
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("a").alias("b"), "l"), "b")
            .groupBy("a")
            .agg(F.min("l").alias("m"))
            .join(labels, "a")
            .select("a", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        )
        # The label is a node itself; its own label before this round is at most as large.
        jump = labels.select(F.col("a").alias("k"), F.col("l").alias("far"))
        new = near.join(jump, F.col("l") == F.col("k"), "left").select(
            "a", F.least("l", "far").alias("l"), (F.least("l", "far") < F.col("old")).alias("moved")
        )
        new = stored(new, "labels")
        released(labels)  # the round before is held in the new labels
        labels = new.select("a", "l")
        if new.where("moved").isEmpty():
            released(edges)
            return labels.select(F.col("a").alias("node"), F.col("l").alias("component"))
