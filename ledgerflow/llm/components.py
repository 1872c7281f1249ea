"""Connected components of links between long keys, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import store


def _to_least(links: DataFrame, key: str, other: str) -> DataFrame:
    """Each link of a key beside the smallest key it is linked to; the smallest is combined before the shuffle."""
    least = links.groupBy(key).agg(F.min(other).alias("_least"))
    return links.join(least.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key")).drop("_key")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours instead."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _to_least(both, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.least("a", "_least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    found = _to_least(links, "a", "b")
    moved = found.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a > b")
    return moved.unionByName(found.select("a", F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every key in ``links`` (a, b: long, not null) but the roots: ``root`` is the smallest key reachable.

    Each step is stored in the shared folder. The steps end when the links form stars around roots, after a number of
    rounds that grows with the logarithm of the longest path. Nothing is gathered but one answer per round.
    """
    now = store(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(now):
        now = store(_small_star(_large_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(links: DataFrame) -> bool:
    """Whether every key is linked to one smaller key at most, and none to a key that is linked to a smaller one itself."""
    end = lambda key, up, down: F.struct(F.col(key).alias("key"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    keys = links.select(F.inline(F.array(end("a", 1, 0), end("b", 0, 1)))).groupBy("key").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return keys.filter("up > 1 OR up > 0 AND down > 0").isEmpty()
