"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tablelift.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable over edges (a, b), for each node named.

    Each round gives a node the least label among its own and its neighbours', then the
    label of that label, so chains shorten by powers of two. Only aggregates are
    shuffled, which reduce before they are, and joins are merges at every size, as very many
    small broadcasts add up on the driver; each round's table is written, and the number
    of labels changed on the way is all that the driver sees.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both, "component-edges")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("component")),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("near")).hint("merge"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        )
        least = labels.join(near.hint("merge"), "node").select(
            "node", "component", F.least("component", "near").alias("lower")
        )
        above = labels.select(F.col("node").alias("lower"), F.col("component").alias("top"))
        jumped = least.join(above.hint("merge"), "lower").select(
            "node", F.col("component").alias("before"), F.least("lower", "top").alias("component")
        )
        # Counted as they are written, so that no job is run for it.
        seen = Observation()
        jumped = jumped.observe(seen, F.count_if(F.col("component") != F.col("before")).alias("changed"))
        labels = written(jumped.drop("before"), "component-labels")
        if not seen.get["changed"]:
            return labels
