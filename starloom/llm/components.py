"""Connected components of a link table, by shuffles of shrinking tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def components(links: DataFrame, src: str = "src", dst: str = "dst", label: str = "links") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node that has a link.

    Each round hangs every node under the smallest of its neighbours and itself, follows those
    pointers to their ends and draws the links between the ends that are left. The node count of a
    round is at most half of the one before. Minimum and distinct are combined before the shuffle,
    so a node with very many links is no hot key. Null ends and loops are ignored; no links give
    no rows. Nothing but row counts reaches the driver.
    """
    edges = stored(
        links.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") < F.col("b")))
        .distinct(),
        f"{label}-edges",
    )
    pointer = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up")), f"{label}-up")
        hung = _flat(hung, label)
        edges = stored(_relabelled(edges, hung), f"{label}-edges")
        if pointer is None:
            pointer = hung
        else:
            above = hung.select(F.col("node").alias("up"), F.col("up").alias("top"))
            pointer = stored(
                pointer.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up")), f"{label}-tree"
            )
    if pointer is None:
        kind = links.schema[src].dataType.simpleString()
        return links.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    return pointer.withColumnRenamed("up", "component")


def _flat(tree: DataFrame, label: str) -> DataFrame:
    """Every node points at the end of its path; paths halve in each pass."""
    while True:
        above = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = tree.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
        jumped = stored(jumped, f"{label}-jump")
        tree = jumped.select("node", "up")
        if jumped.where("moved").isEmpty():
            return tree


def _relabelled(edges: DataFrame, tree: DataFrame) -> DataFrame:
    a = tree.select(F.col("node").alias("a"), F.col("up").alias("ua"))
    b = tree.select(F.col("node").alias("b"), F.col("up").alias("ub"))
    moved = edges.join(a, "a").join(b, "b")
    return (
        moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).where("a < b").distinct()
    )
