"""Connected components of a link table, by alternating large and small stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import consumed, kept


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, component (the least node reachable) for every node of a link; loops and nulls are ignored.

    Each round links every node to the least of its neighbourhood; rounds end when nothing changes, after about
    log of the longest path. Only sums by node are shuffled, so a node with many links costs its links.
    """
    pairs = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    pairs = kept(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(pairs)
    while state[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        last, pairs = pairs, kept(small.where("u <> v").distinct(), "links")
        consumed(last)
        before, state = state, _state(pairs)
        if before == state:
            break
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
