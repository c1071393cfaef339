"""Connected components of a table of links, by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.shared import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link; ``component`` is the smallest node reachable.

    Each round hangs every node's larger neighbours under its smallest neighbour (large star), then does the same
    towards smaller ones (small star), until the links no longer change and are stars around the smallest nodes.
    The links stay distributed; only their number and a checksum come back.
    """
    now = written(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        before, now = now, written(small.select("e.u", "e.v").filter("u != v").distinct(), "links")
        discard(before)
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.union(now.select("v", "v").distinct())
