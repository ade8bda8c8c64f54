"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import written


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one (or itself)."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them. ``a > b`` in all edges."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return low.select("a", F.col("m").alias("b")).union(moved).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (two columns, any orientation); root is the least node reachable.

    Every round is written to the shared folder, so lost executors cost a re-read. Rounds end when
    the edge set no longer changes, which takes about the logarithm of the longest path.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = written(edges, "edges")
    seen = _digest(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
