"""Connected components of an edge list by alternating large and small stars.

Every step is an aggregation and an equi-join on single nodes, so a node with
very many neighbours is folded map-side and its join partition can be split.
Rounds grow with the logarithm of a component's diameter; each is written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point each node's larger (or smaller and own) neighbours at the least of its neighbours."""
    u, v = F.col("u"), F.col("v")
    seen = edges.union(edges.select("v", "u")) if large else edges.select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    )
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = seen.join(least, "u")
    if large:
        return joined.where(v > u).select(v.alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    moved = joined.select(v.alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, component) for every node of an edge; the component is its least node."""
    current = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v"), "components")
    before = None
    while True:
        current = stage(_star(_star(current, large=True), large=False), "components")
        mark = current.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == before:
            break
        before = mark
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.union(roots)
