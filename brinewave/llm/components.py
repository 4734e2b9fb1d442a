"""Connected components of an undirected graph by alternating large-star and small-star steps.

Every step is an aggregation (smallest neighbour, combined on the map side) joined back to the edges, so a node
with very many neighbours is a skewed join at worst and never a group in one task.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import held


LEAST_TASKS = 8


def _star(edges: DataFrame, large: bool, tasks: int | None = None) -> DataFrame:
    """Link neighbours to the smallest node of a neighbourhood: the larger ones, or the smaller ones with the node."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    out = out.filter("a <> b")
    return out.distinct() if tasks is None else out.coalesce(tasks).distinct().coalesce(tasks)


def _stars(edges: DataFrame) -> bool:
    """Whether every larger node has one edge and is no other's smaller node, so that no step changes the edges."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    of = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return of.filter("up > 1 OR up > 0 AND down > 0").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, rows_of_task: int | None = None) -> DataFrame:
    """``(node, component)`` of every node in ``links(a, b)``; the component is its smallest node.

    Links are symmetric; repeated links and self-links change nothing. An empty input gives no row. With ``rows_of_task``, a
    step has as many tasks as its links need at that number of rows each, where the session's shuffles would have far more.
    """
    edges = held(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    tasks = None
    if rows_of_task is not None:
        tasks = max(LEAST_TASKS, ceil(edges.count() / rows_of_task))
        edges = edges.coalesce(tasks)
    while not _stars(edges):
        edges = held(_star(_star(edges, True, tasks), False, tasks))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
