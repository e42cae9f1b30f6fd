"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.session import forget, written


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Large-star (``both_ways``): every node links its larger neighbours to its smallest one. Small-star:
    every node links itself and its smaller neighbours to the smallest of them."""
    if both_ways:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = seen.join(least, "a")
    if both_ways:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes of an edge table; the component is its smallest node.

    Loops and repeated edges are ignored. Every round is written to the shared folder and costs joins on
    a node, whose hot keys AQE splits; the round before is deleted. Rounds go on until the table stays as it is (their
    number grows with the logarithm of a component's size); nothing is collected but one fingerprint of it.
    """
    e = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b and a is not null and b is not null").distinct(), "edges")
    before = None
    while True:
        last, e = e, written(_stars(_stars(e, True), False), "stars")
        forget(last)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    # Every node is linked to its root by now, and to nothing else.
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
