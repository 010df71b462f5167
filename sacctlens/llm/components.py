"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sacctlens.llm.common import few, materialize


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """node, component (smallest node of its component) for edges (a, b) of longs.

    Each round takes the smallest label among a node's neighbours and then the
    label's own label, until nothing changes.  A hub's neighbours are combined
    before they shuffle; every round is cut off by a written table.  ``most``: there are
    at most so many edges, if the caller knows.
    """
    most = None if most is None else 2 * most
    both = materialize(few(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), most))
    labels = materialize(few(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), most))
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near")))
        lower = labels.join(near, labels.node == near.a).select("node", "component", F.least("component", "near").alias("low"))
        own = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        new = materialize(few(lower.join(own, lower.low == own._n, "left")
                          .select("node", F.least("low", F.coalesce("_c", "low")).alias("component"), F.col("component").alias("was")), most))
        changed = new.filter("component <> was").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
