"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joining import attach_totals, store_totals
from ..workspace import Workspace


def _star(edges: DataFrame, workspace: Workspace, large: bool) -> DataFrame:
    """Link nodes to the smallest neighbour of a node they share.

    ``edges`` runs from larger to smaller node. The large star sends a node's
    larger neighbours, the small star its smaller ones and itself, to the least
    of its neighbourhood. Minima are pre-aggregated, and a hub with many
    neighbours is split when its minimum is joined back.
    """
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("rows")
    )
    stored, sizes = store_totals(least, workspace, "least-neighbours")
    moved = attach_totals(both, stored, ["u"], ["v"], sizes[None])
    if large:
        linked = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            stored.select("u", F.col("m").alias("v"))
        )
    return linked.filter("u <> v").distinct()


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """``u, v``: each linked node ``u`` and the least node ``v`` of its component.

    ``edges`` has two columns of one orderable type. Large and small stars
    alternate until nothing changes, in about the logarithm of the longest path;
    each round is a stored table. The least nodes themselves, and nodes without an
    edge, have no row.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    metrics = [
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"),
        F.expr("sum(xxhash64(u, v) % 1000003)").alias("s"),
    ]
    edges, state = workspace.store_observed(edges.distinct(), "edges", metrics)
    while state["n"]:
        larger = workspace.store(_star(edges, workspace, large=True), "large-star")
        edges, now = workspace.store_observed(
            _star(larger, workspace, large=False), "small-star", metrics
        )
        if now == state:
            break
        state = now
    return edges
