"""Connected components of a graph that is given by its edges, in DataFrame operations.

Alternating stars: *large* links the greater neighbours of a node to its least
neighbour, *small* links the lesser ones and the node itself. Both only replace edges,
so the graph never grows, and it ends as stars around each component's least node.
Paths halve, so the rounds grow with the logarithm of the longest path. Each round is
written to shared storage: plans stay short and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.staging import stage


def _toward_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with the least of u and its v as ``m``.

    A hub's pairs may be a third of all. Minima are combined before the shuffle. They
    join back on a struct around the key, which is shuffled on both sides alike, so
    that the adaptive skew join can split a hub's pairs.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("_v"))
    least = least.select(
        F.struct(F.col("u").alias("k")).alias("_k"),
        F.least(F.col("u"), F.col("_v")).alias("m"),
    )
    keyed = pairs.withColumn("_k", F.struct(F.col("u").alias("k")))
    return keyed.join(least, "_k").select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _toward_least(both).filter("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the greater to the lesser node."""
    found = _toward_least(edges)
    moved = found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def _state(edges: DataFrame) -> tuple:
    # Decimal sums cannot overflow; equal sums of hashes: the same edges.
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the least node it reaches) for every node of an edge.

    Edges have no direction; repeated ones and loops do no harm, an edge with a null end
    is no edge. A node that only has a loop gets no row. No edges: no rows.
    """
    ends = F.col(a), F.col(b)
    current = stage(
        edges.filter(ends[0].isNotNull() & ends[1].isNotNull() & (ends[0] != ends[1]))
        .select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v"))
        .distinct()
    )
    before, state = None, _state(current)
    while state != before and state[0]:
        current = stage(_small_star(_large_star(current)))
        before, state = state, _state(current)
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.unionByName(roots.distinct())
