"""Connected components by alternating star contraction, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_width

#: an edge is 16 bytes, so its shuffles are read by this share of the tasks
SHARE, LEAST = 8, 6


def _few(df: DataFrame) -> DataFrame:
    return df.coalesce(max(LEAST, shuffle_width(df.sparkSession) // SHARE))


def _least(pairs: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours; pre-aggregated, so a node
    with very many neighbours costs one row per task."""
    return (pairs.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")))


def _is_done(edges: DataFrame) -> bool:
    """Whether every node hangs on one root only, which hangs on nothing."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return _few(ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
                .where("hangs + holds > 1")).isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``edges(u long, v long)``.

    The component is its smallest node.  Large-star hangs each larger
    neighbour on the smallest one, small-star hangs a node and its smaller
    neighbours there; a path of n nodes takes O(log^2 n) rounds.  Every round
    is written, so a lost executor repeats one round at most.  Loops are
    allowed; null nodes are dropped; no edges give no rows.
    """
    all_edges = edges.where("u IS NOT NULL AND v IS NOT NULL")
    now = materialize(_few(all_edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()), "cc")
    for _ in range(rounds):
        if _is_done(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_few(both.where("v > u").join(_least(both), "u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = materialize(_few(large), "cc")
        small = _few(large.join(_least(large), "u")).select(F.col("v").alias("a"), "u", "m")
        ends = small.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("m").alias("v")),
                                              F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = materialize(_few(ends.select("e.u", "e.v").where("u <> v").distinct()), "cc")
    else:
        raise RuntimeError("components did not settle")
    nodes = all_edges.select(F.col("u").alias("node")).unionByName(all_edges.select(F.col("v").alias("node"))).distinct()
    root = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
