"""Connected components of a graph as Spark joins: every node gets the smallest node it reaches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, label: str = "component", store: Callable[[DataFrame, str], DataFrame] = common.store) -> DataFrame:
    """(node, component) for all nodes of `edges` (a, b), which may repeat and point either way.

    Rounds of large-star and small-star: each node's larger, then smaller neighbours are tied to the smallest one.
    A star's centre is found by an aggregate that combines before the shuffle; the join that ties the others is one
    that Spark splits where a centre is hot. The rounds, logarithmic in the longest path, end when no edge changes.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = store(edges, label)
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        edges = store(small.where("a != b").distinct(), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
