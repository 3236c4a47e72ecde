"""Connected components of links, as joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized


def components(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = materialized) -> DataFrame:
    """node, class (the smallest node of its component) for each node of ``links`` (a, b) but the smallest.

    Large and small stars in turn: every node is tied to the smallest it knows, until nothing changes, which takes
    a number of rounds logarithmic in the length of a chain. Each node's smallest is an aggregate, and the join
    with it has one row per node on that side, so a node with very many links is split like any skewed key. ``keep``
    writes the links of a round.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = keep(links.filter("a <> b").select(high, low).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = keep(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = keep(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("class"))
        state = now
