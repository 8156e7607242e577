"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import drop, shuffles_released, stored


def _state(edges: DataFrame) -> tuple:
    with shuffles_released(edges.sparkSession):
        row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "root")).alias("x")).first()
    return row["n"], row["x"]


def star_round(edges: DataFrame) -> DataFrame:
    """One large star and one small star: links (node > root) move towards their smallest neighbours."""
    both = edges.unionAll(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    nearest = both.groupBy("node").agg(F.min("root").alias("least"))
    nearest = nearest.select(F.col("node").alias("via"), F.least("least", "node").alias("least"))
    # Upward links of a node go to its smallest neighbour instead of to the node.
    upward = edges.join(nearest, edges["root"] == nearest["via"]).select("node", F.col("least").alias("root")).distinct()
    best = upward.groupBy("node").agg(F.min("root").alias("least")).withColumnRenamed("node", "via")
    lower = upward.join(best, upward["node"] == best["via"]).select("root", "least", "node")
    moved = lower.select(F.col("root").alias("node"), F.col("least").alias("root")).where("node != root")
    return moved.unionAll(lower.select("node", F.col("least").alias("root"))).distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """node, root for every linked node that is not the smallest of its component.

    `links` has integer columns a and b. With `rounds`, it stops early: nodes of one root are then
    connected, but a component may still have several roots.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    edges = stored(edges, "links")
    before, done = None, 0
    while rounds is None or done < rounds:
        state = _state(edges)
        if state == before:
            break
        before, done = state, done + 1
        old, edges = edges, stored(star_round(edges), "links")
        drop(old)
    return edges.groupBy("node").agg(F.min("root").alias("root"))
