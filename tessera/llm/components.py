"""Connected components over an edge table, wholly distributed.

Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce
and Beyond", 2014).  Neighbour minima are partial aggregates and the join back has one row a node
on its small side, so that a node with a third of all edges is split by adaptive execution.
Nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, release


def _normal(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, once each."""
    return (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: columns u, v of one orderable type.  Returns (node, component) for every node of a
    proper edge, component being the smallest node that it reaches.

    Edges with a null end and loops are ignored; repeated edges count once; an empty table gives
    an empty result.
    """
    now = materialize(_normal(edges.select("u", "v").dropna()), "edges")
    before = _state(now)
    while before[0]:
        after = materialize(_normal(_small_star(_normal(_large_star(now)))), "edges")
        release(now)
        now, state = after, _state(after)
        if state == before:
            break
        before = state
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
