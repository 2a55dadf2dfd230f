"""Connected components of links between nodes, without any single large task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perplexis.sources.workspace import stored


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``node, comp`` after the links ``a, b`` (nodes) have merged components.

    In each round every component hooks onto its least neighbour, which can't
    make a cycle, and takes the label of what that one hooked onto; links within
    one component go. Rounds follow the logarithm of the longest chain.
    """
    at = labels.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    edges = stored(
        links.join(at, F.col("a") == F.col("_node")).select(F.col("_comp").alias("a"), "b")
        .join(at, F.col("b") == F.col("_node")).select("a", F.col("_comp").alias("b"))
        .where("a <> b").distinct(), "edges",
    )
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(
            both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")), "hooks"
        )
        for _ in range(2):
            up = hooks.select(F.col("a").alias("_a"), F.col("to").alias("_to"))
            hooks = hooks.join(up, F.col("to") == F.col("_a"), "left").select("a", F.coalesce("_to", "to").alias("to"))
        hooks = stored(hooks, "jumps")
        up = hooks.select(F.col("a").alias("_a"), F.col("to").alias("_to"))
        labels = stored(
            labels.join(up, F.col("comp") == F.col("_a"), "left")
            .select("node", F.coalesce("_to", "comp").alias("comp")), "labels",
        )
        edges = stored(
            edges.join(up, F.col("a") == F.col("_a")).select(F.col("_to").alias("a"), "b")
            .join(up, F.col("b") == F.col("_a")).select("a", F.col("_to").alias("b"))
            .where("a <> b").distinct(), "edges",
        )
    return labels
