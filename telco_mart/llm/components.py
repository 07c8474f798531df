"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has a > b."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root being the
    smallest node of its component. Null ends and loops are ignored; an empty
    table gives an empty result.

    Each round joins every node to the smallest neighbour it knows; minima are
    aggregated map-side and the joins are plain equi-joins, so a node with very
    many links is never gathered in one task (skewed partitions are split at
    run time). Rounds are written to the shared folder, and end when the links
    no longer change: then all of them point at the smallest node.
    """
    clean = edges.filter("a is not null and b is not null and a <> b")
    e = written(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    digest = lambda d: tuple(d.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())
    before = digest(e)
    while before[0]:
        e = written(_small_star(_large_star(e).distinct()).distinct(), "links")
        now = digest(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
