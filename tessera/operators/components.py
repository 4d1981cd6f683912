"""Connected components by alternating large-star and small-star steps (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """edges: two columns of one orderable type. node, component (the smallest node it reaches).

    Nodes are those of the edges; a loop makes its node a component. Each round hangs the neighbours
    of every node under its least neighbour, so that the number of rounds follows the logarithm of
    the longest path. All steps are joins and minima by key: a node with very many neighbours is no
    group that has to fit a task. Edges with a null end are no edges.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialize(pairs, "edges")
    loops = pairs.where("u = v").select("u")
    stars = pairs.where("u <> v")
    seen, last = None, None
    while True:
        stars = materialize(_small_star(_large_star(stars)), "stars")
        if last is not None:
            discard(last)
        last = stars
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.expr("sum(cast(xxhash64(v, u) % 1000003 as bigint))")).first()
        if state == seen:
            break
        seen = state
    tops = stars.select(F.col("v").alias("u")).union(loops).distinct()
    alone = tops.join(stars.select("u"), "u", "left_anti").select(F.col("u").alias("node"), F.col("u").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(alone)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every neighbour above a node goes under the least of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.where("v > u").join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its neighbours below go under the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    hung = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hung.unionByName(own).where("u <> v").distinct()
