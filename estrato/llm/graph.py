"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estrato.workspace import freeze


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the component's least node.

    Large stars hang the greater neighbours of a node under its least neighbour, small stars
    the rest; both are a minimum per node joined back to the edges, and the edges never grow
    in number. The loop ends when a round changes nothing, after about log(nodes) rounds.
    """
    now = freeze(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(), "edges",
    )
    seen = _mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, both.filter("v > u"), keep_hub=False)
        now = freeze(_hung(large, large, keep_hub=True), "edges")
        after = _mark(now)
        if after == seen:
            break
        seen = after
    # Stars: every u hangs under its root v.
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _hung(least_of: DataFrame, moved: DataFrame, keep_hub: bool) -> DataFrame:
    """Every `v` of `moved` under the least neighbour of its `u`, greater end first."""
    hubs = least_of.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("hub"))
    edges = moved.join(hubs, "u").select(F.col("v").alias("x"), F.col("hub").alias("y"))
    if keep_hub:
        edges = edges.unionByName(hubs.select(F.col("u").alias("x"), F.col("hub").alias("y")))
    return edges.filter("x <> y").select(
        F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")
    ).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and checksum of the edges."""
    checksum = F.bit_xor(F.xxhash64("u", "v"))
    return tuple(edges.agg(F.count("*"), F.coalesce(checksum, F.lit(0))).first())
