"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import attach, cut


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the smallest node reachable.

    Links that are null at an end or loop to themselves are left out.  Each
    round replaces links by links to smaller nodes; a node of any degree is
    reduced by a partial minimum, and high-degree nodes are joined by a bounded
    broadcast.  Every round is written to the shared folder.  An empty table
    gives an empty result.
    """
    a, b = F.col("a"), F.col("b")
    e = cut(links.where((a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    state = _state(e)
    while state[0]:
        # large star: every larger neighbour of a node goes to its smallest neighbour
        both = e.unionByName(e.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = attach(both, low, "a", "n", 2 * state[0], ["m"]).where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = cut(large.where(a != b).distinct(), "large")
        # small star: a node and its smaller neighbours go to the smallest of them
        total = large.count()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        near = attach(large, low, "a", "n", max(total, 1), ["m"]).select(b.alias("a"), F.col("m").alias("b"))
        e = cut(near.unionByName(low.select("a", F.col("m").alias("b"))).where(a != b).distinct(), "small")
        before, state = state, _state(e)
        if before == state:
            break
    roots = e.select(b.alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(a.alias("node"), b.alias("root")).unionByName(roots)
