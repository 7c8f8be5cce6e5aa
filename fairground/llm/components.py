"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairground.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Every round is a pair of aggregations and joins over the edges, written to the shared folder; the rounds needed
    grow with the logarithm of the longest path. Self links and repeated edges are dropped. No edges give no rows.
    """
    now = scratch.table(f"{label}-0", edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    step = 0
    while mark[0]:
        step += 1
        wide = scratch.table(f"{label}-{step}-wide", _large_star(now))
        new = scratch.table(f"{label}-{step}", _small_star(wide))
        new_mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{label}-{step - 1}", f"{label}-{step}-wide")
        now = new
        if new_mark == mark:
            break
        mark = new_mark
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
