"""Connected components of an edge table, without the driver seeing an edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.plans.lineage import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): root is the smallest node that ``node`` reaches.

    Alternates two steps until nothing changes: every node hangs its larger
    neighbours on its smallest one, then its smaller neighbours and itself.
    Depth halves with each round, so rounds grow with the logarithm of the
    longest chain.  Minima are combined before the shuffle, and the joins on a
    hub's key are splittable, so a hub may hold much of the table.  Each round
    is written to the checkpoint folder.  Nodes without an edge to another are
    left out; null ends are no edges.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _state(now)
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(down.select("u", F.col("m").alias("v"))).distinct())
        after = _state(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
