"""Connected components of a distributed edge table: hook every node to its least neighbour, follow the hooks, contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators.storage import materialize


def relabelled(labels: DataFrame, later: DataFrame) -> DataFrame:
    """``labels(node, root)`` after their roots got the roots of ``later(node, root)`` themselves."""
    up = later.select(F.col("node").alias("from"), F.col("root").alias("to"))
    return labels.join(up, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(later)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)`` that is not the smallest of its component; root is the smallest.

    A hook points to a smaller node, so hooks form trees; following them halves their depth with each
    join. What remains are edges between roots. No node's neighbours are gathered.
    """
    edges = materialize(links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low <> high").distinct())
    labels = None
    while (n := edges.count()) or labels is None:
        hooks = materialize(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root")))
        only_trees = hooks.count() == n
        while True:
            above = hooks.select(F.col("node").alias("from"), F.col("root").alias("to"))
            hooks = materialize(hooks.join(above, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
            moved = hooks.where("moved").take(1)
            hooks = hooks.select("node", "root")
            if not moved:
                break
        labels = hooks if labels is None else materialize(relabelled(labels, hooks))
        if only_trees:
            break
        for end in ("low", "high"):
            edges = edges.join(hooks.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        edges = materialize(edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).where("low <> high").distinct())
    return labels
