"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.session import materialize


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (smallest node it reaches) for every node of an edge.

    Each round points every node at its smallest neighbour, follows the pointers
    to their ends and contracts the edges; at least half of the nodes that still
    have edges disappear per round.  All tables are written, so lineage stays
    short and a lost executor costs one step.  Nodes with many neighbours are
    only ever the skewed side of a join of two stored tables, which the adaptive
    planner splits, or part of a pre-aggregated minimum.

    Edges with a null end and loops are ignored; an empty table gives no rows.
    """
    edges = edges.select(*_ordered(F.col(a).cast("long"), F.col(b).cast("long"))).where("a < b").distinct()
    edges = materialize(edges, "edges")
    whole = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        up = materialize(up.select("node", F.least("node", "up").alias("up")), "pointers")
        while True:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = up.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
            jumped = materialize(jumped, "pointers")
            up = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        if whole is None:
            whole = up.withColumnRenamed("up", "component")
        else:
            step = up.withColumnRenamed("node", "component")
            whole = whole.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            whole = materialize(whole, "components")
        left = up.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = up.select(F.col("node").alias("b"), F.col("up").alias("y"))
        half = materialize(edges.join(left, "a").select("b", "x"), "edges")
        edges = half.join(right, "b").select(*_ordered(F.col("x"), F.col("y"))).where("a < b").distinct()
        edges = materialize(edges, "edges")
    if whole is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return whole
