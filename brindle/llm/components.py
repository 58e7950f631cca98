"""Connected components of links, each named by its smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import staged


def _mark(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node in ``edges`` (columns ``a``, ``b``) that is not its component's smallest.

    Alternating large and small stars: every node's larger neighbours move to its smallest one, then its smaller
    neighbours do, until nothing changes, in about the logarithm of the longest path. A star's smallest neighbour is a
    minimum that is combined before the shuffle, and it comes back by a join, so no neighbourhood is ever gathered.
    Each round is written to the shared folder. Equal ends and repeated links are allowed; null ends are left out.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(ordered.distinct(), "links")
    before, mark = None, _mark(now)
    while mark[0] and mark != before:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, mark = mark, _mark(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
