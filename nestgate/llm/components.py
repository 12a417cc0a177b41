"""Connected components by alternating large-star and small-star on an edge table.

Nodes are any orderable type.  Every round is two shuffles of the edges; a node
with many neighbours is never collected: the smallest neighbour comes from a
partial aggregate and is joined back.  The rounds end when the edge table no
longer changes, i.e. every node points at the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import saved


EDGES_A_TASK = 50_000


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """One star step on rows (u, v).  Large: strictly larger neighbours of u move to u's smallest
    neighbour (u included); small: the smaller neighbours and u itself do.

    ``tasks`` follows the number of edges, so small tables are not written as very many files.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(low, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks)


def _mark(edges: DataFrame) -> tuple:
    # exact sums: the hashes are added as decimals, so the order of the rows does not matter
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges (u, v)``; ``root`` is the smallest node."""
    edges = saved(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct())
    before = _mark(edges)
    tasks = max(1, -(-before[0] // EDGES_A_TASK))
    for _ in range(max_rounds):
        edges = saved(_star(_star(edges.coalesce(tasks), True, tasks), False, tasks))
        now = _mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
