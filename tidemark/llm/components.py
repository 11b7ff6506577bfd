"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge the smallest node that it
    is connected with.

    Large-star and small-star steps in turn (each points nodes at the smallest
    node near them) until nothing changes; the number of rounds grows with the
    logarithm of the longest chain.  Every step is written to the shared
    folder.  Hub nodes only meet aggregates with partial sums, and joins with a
    written table of one row per node, whose other side Spark splits at a hub.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    state = _state(now)
    while True:
        # large star: the greater neighbours of u are pointed at the least one
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = written(low, "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are pointed at the least one
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
