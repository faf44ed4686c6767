"""Connected components of an edge table, by alternating large and small stars.

Every round writes its edges to the shared folder, so the plan stays short and
a lost executor costs one round.  A round aggregates a minimum per node (with
map-side combine) and joins it back; no component is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each larger neighbour of a node to the node's smallest
    neighbour.  Small star: the same for the node and its smaller neighbours."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # Stored, so that the join below can split the rows of a node with very many neighbours.
    least = written(sides.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("_u"), F.least("u", "m").alias("m")), "least")
    joined = sides.join(least, F.col("u") == F.col("_u"))
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest reachable node.

    ``edges`` has columns ``u`` and ``v`` of an orderable type.  Self loops and
    repeats are allowed, null ends are not.
    """
    edges = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "edges")
        # Rounds end when the set of edges stays the same; its digest is one row.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
