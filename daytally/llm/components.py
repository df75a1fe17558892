"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every end of the edges ``a``, ``b`` (long).

    Each round hooks every node to its least neighbour, in the order of a hash
    (so that long chains of rising ids contract as fast as any other), and
    replaces the edges by those between the hooks.  A round removes a constant
    share of the nodes.  Every round is written to the shared folder, so lost
    executors cost one round.  Neighbours are only aggregated, never gathered:
    a hub leaves each task as one row.
    """
    edges = materialize(edges.where("a <> b"), "edges")
    steps = []
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order("b")).alias("least"))
        hook = materialize(least.select(F.col("a").alias("node"), F.least("least", order("a"))["id"].alias("root")), "hooks")
        steps.append(hook)
        up = lambda name: hook.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))  # noqa: B023, E731
        lifted = edges.join(up("a"), "a").join(up("b"), "b").where("a_root <> b_root")
        edges = materialize(
            lifted.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "edges"
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for hook in steps[1:]:
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
        found = found.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return materialize(found, "components") if len(steps) > 1 else found
