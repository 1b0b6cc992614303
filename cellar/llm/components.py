"""Connected components by alternating stars: every step is a join or an aggregate on node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import written


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns u, v: long); component is its smallest node.

    A large-star step links each node's larger neighbours to its smallest one, a
    small-star step its smaller ones and itself; edges end as stars around the
    smallest nodes. Smallest neighbours and each round's edges are written to
    the shared folder, so that both sides of a join are scanned and shuffled and
    AQE can split a node with very many edges.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges", edges.count())
    before = _checksum(edges)
    while before[0]:
        n = before[0]  # edges never become more
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least", 2 * n)
        large = written(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .distinct(), "large", n)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least", n)
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges", n)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)
