"""Connected components by repeated contraction.

Every round each node joins the neighbour (or itself) with the smallest hash of that round, and the
edges are rewritten between the chosen nodes.  With fresh hashes the graph shrinks by a constant
factor per round whatever its shape (a long chain of rising ids included), so rounds are
logarithmic and the total work is about that of the first round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firegrid.operators.joins import hot_lookup
from firegrid.session import cut, cut_counted


def _canonical(edges: DataFrame, u: str, v: str) -> DataFrame:
    return (
        edges.where(F.col(u) != F.col(v))
        .select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))
        .distinct()
    )


def connected_components(
    edges: DataFrame, nodes: DataFrame | None = None, src: str = "src", dst: str = "dst", node: str = "node",
    weight: str | None = None, canonical: bool = False,
) -> DataFrame:
    """(node, component, n_nodes[, weight]): component = smallest node id; lone nodes are their own component.

    ``weight`` names a column of ``nodes`` to add up per component.  ``canonical`` promises that the
    edges are stored, distinct and have src < dst, which saves a pass.
    """
    if canonical:
        e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        left = 0 if e.isEmpty() else 1
    else:
        e, left = cut_counted(_canonical(edges, src, dst))
    steps: list[DataFrame] = []
    while left:
        seed = F.lit(len(steps))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = F.min(F.struct(F.xxhash64("v", seed).alias("h"), F.col("v").alias("id")))
        own = F.struct(F.xxhash64("node", seed).alias("h"), F.col("node").alias("id"))
        step = cut(
            both.groupBy(F.col("u").alias("node")).agg(best.alias("best"))
            .select("node", F.least(own, F.col("best"))["id"].alias("rep"))
        )
        steps.append(step)
        moved = (
            e.join(step.select(F.col("node").alias("u"), F.col("rep").alias("ru")), "u")
            .join(step.select(F.col("node").alias("v"), F.col("rep").alias("rv")), "v")
        )
        e, left = cut_counted(_canonical(moved, "ru", "rv"))
    weights = [] if weight is None else [weight]
    if not steps:
        every = nodes.select(F.col(node).alias("node"), *weights) if nodes is not None else edges.select(F.col(src).alias("node")).limit(0)
        return every.select("node", F.col("node").alias("component"), F.lit(1).cast("long").alias("n_nodes"), *weights)
    # Follow the steps backwards, smallest tables first.
    reach = steps[-1]
    for step in reversed(steps[:-1]):
        nxt = reach.select(F.col("node").alias("rep"), F.col("rep").alias("far"))
        reach = step.join(nxt, "rep", "left").select("node", F.coalesce("far", "rep").alias("rep"))
    if len(steps) > 1:
        reach = cut(reach)
    sums = reach.join(nodes.select(F.col(node).alias("node"), weight), "node") if weight else reach
    groups = cut(sums.groupBy("rep").agg(
        F.min("node").alias("component"), F.count("*").alias("n_nodes"), *[F.sum(w).alias(w) for w in weights]
    ))
    labels = hot_lookup(reach, groups, ["rep"], "n_nodes", "node").drop("rep")
    if nodes is None:
        return labels
    own = [F.col(w).alias(f"_own_{w}") for w in weights]
    return (
        nodes.select(F.col(node).alias("node"), *own).join(labels, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"),
                F.coalesce("n_nodes", F.lit(1)).cast("long").alias("n_nodes"),
                *[F.coalesce(w, f"_own_{w}").alias(w) for w in weights])
    )
