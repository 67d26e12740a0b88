"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import forget, store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least
    node reachable. Labels drop to the least neighbour's and then follow the
    label of their label, so a chain halves in each round; every round is a
    stored table, which a lost executor cannot take away."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = store(both.filter("a != b").distinct(), "links")
    labels = store(
        links.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels"
    )
    before = labels
    while True:
        near = (
            links.join(labels, links["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("root").alias("_near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "root", F.least("root", "_near").alias("_next")
        )
        over = labels.select(F.col("node").alias("_next"), F.col("root").alias("_jump"))
        step = store(
            lower.join(over, "_next", "left").select(
                "node", F.least("_next", "_jump").alias("root"), F.col("root").alias("_before")
            ),
            "labels",
        )
        changed = step.filter("root != _before").limit(1).count()
        forget(before)
        labels, before = step.select("node", "root"), step
        if not changed:
            forget(links)
            return labels
