"""Connected components of a graph whose edges are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node that it reaches.

    Alternates two steps until the edges stay as they are: each node links its larger neighbours to the
    smallest node around it, then each node links its smaller neighbours and itself to the smallest of them. Only
    minima are aggregated, so a node with very many neighbours is combined before the shuffle, and the joins are
    plain enough for adaptive execution to split it. Every round is written to the shared scratch folder.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _digest(edges)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = stored(small.distinct())
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
