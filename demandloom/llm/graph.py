"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

#: Links that one task works on: a small table is not spread over more tasks than it needs.
TASK_ROWS = 20_000


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(node, root)`` of every node in ``links`` ``(a, b)``; the root is the smallest node reachable.

    Each round points all neighbours of a node at the smallest of them and of itself, first the larger
    neighbours, then the smaller ones, until no pointer changes. A star is done in one round and a
    chain in about the logarithm of its length. No step gathers the neighbours of a node.
    """
    edges = scratch.keep(
        f"{name}-0",
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
    )
    # the sum of a hash of all edges tells whether a round has changed them
    mark, step = _mark(edges), 0
    while True:
        both = few_tasks(edges.union(edges.select("b", "a")), 2 * mark[0])
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(small_low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(small_low.select("a", "low"))
        small = few_tasks(small, 2 * mark[0])
        step += 1
        edges = scratch.keep(f"{name}-{step}", small.filter("a <> b").distinct())
        found = _mark(edges)
        scratch.drop(f"{name}-{step - 1}")
        if found == mark:
            break
        mark = found
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def few_tasks(table: DataFrame, rows: int) -> DataFrame:
    """A written table of known size in as few partitions as it needs."""
    return table.coalesce(rows // TASK_ROWS + 1)


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    )
