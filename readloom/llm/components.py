"""Connected components of a distributed edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.shared import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, comp`` (smallest node reachable) for every node of the edges ``a, b``.

    Each pass connects the larger neighbours of every node to its smallest
    neighbour, then the smaller ones, until the edges are stars.  Both steps
    are a group minimum (combined before the shuffle) and an equi-join.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct(), name)
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if new == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        state = new
