"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.shared import dropped, saved


# Parameter: tasks that share the edges of one node, so that a hub is no single task's.
SALTS = 16


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` (a, b) with ``m`` of their node a, joined in SALTS parts of each node."""
    parts = least.select("a", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).join(parts, ["a", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours under the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _with_least(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours under the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(down, least).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: bigint); root is the smallest node that it
    reaches. Alternating large and small stars halve the depth of every tree in a round; each
    round is a table in the shared folder, and only counts reach the driver."""
    now = saved(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        after = saved(_small_star(_large_star(now)), "edges")
        dropped(now)
        now = after
        # the edge set as a count and an order-free checksum
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == state:
            break
        state = seen
    roots = now.select(F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("root").alias("node"), "root"))
