"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.storage import Scratch


#: Edges that one task may hold; below this a round needs no shuffle.
ONE_TASK_EDGES = 100_000


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one type); root is the component's smallest node.

    Large-star / small-star rounds: every node hangs its larger neighbours, then its smaller
    ones, below its smallest neighbour. The table never holds more edges than it began with,
    a round is two aggregations and two joins whatever the degrees are, and a chain of n
    nodes takes about log n rounds. Each round is written to the shared folder.
    Edges with a null end and loops are left out; no edges give no rows.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges = scratch.keep(edges, "edges-0")
    turn = 0
    # Rounds never add edges, so a small table stays small.
    few = edges.count() <= ONE_TASK_EDGES
    while True:
        turn += 1
        edges = edges.coalesce(1) if few else edges
        ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = edges.select(F.explode(ends).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        following = scratch.keep(small, f"edges-{turn}")
        # Stars only: no node is both a leaf and a root, and every leaf has one root.
        state = [
            d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
            for d in (edges, following)
        ]
        edges = following
        scratch.drop(f"edges-{turn - 1}")
        if state[0] == state[1]:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
