"""Connected components of a graph, given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import meet, written


def _towards_least(pairs: DataFrame, label: str) -> DataFrame:
    """Every pair (u, v) as (v, least of u and its partners), and u's own pair with it."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
    total = pairs.count()
    moved = meet(pairs, least, ["u"], "n", total, "inner").select(F.col("v").alias("x"), F.col("m").alias("y"))
    own = least.select(F.col("u").alias("x"), F.col("m").alias("y"))
    return written(moved.unionByName(own).where("x > y").distinct(), label)


def components(edges: DataFrame) -> DataFrame:
    """(x, root): every node ``x`` that has an edge and is not the least of its component,
    with that least node.

    ``edges`` has columns x and y of one orderable type. Alternates large and small stars
    until nothing changes: a number of rounds of the order of the logarithm of the
    nodes. Each round is written, so a lost executor repeats part of one round; a node
    with very many edges is dealt into slices. Loops and repeated edges do no harm.
    """
    now = written(
        edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x > y").distinct(), "edges"
    )
    mark = None
    while True:
        both = now.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(
            now.select(F.col("y").alias("u"), F.col("x").alias("v"))
        )
        # large star: only partners above u move
        large = _towards_least(both, "large-star")
        small = _towards_least(large.select(F.col("x").alias("u"), F.col("y").alias("v")), "small-star")
        seen = small.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("s")
        ).first()
        now = small
        if seen == mark:
            return now.select("x", F.col("y").alias("root"))
        mark = seen
