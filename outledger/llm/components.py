"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from outledger.llm import frames


def connected(links: DataFrame) -> DataFrame:
    """node and component (smallest node that can be reached) of every end of a link (a, b).

    Each round takes the smallest label among neighbours and then the label of the label, so that
    chains halve; it ends when nothing changes. Labels are written to the shared folder after each
    step; a node with very many links is split by the skew join and reduced map-side.
    """
    edges = frames.stored(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(links.select("b", "a")).filter("node <> other"),
        "edges",
    )
    labels = frames.stored(
        edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels"
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node").agg(F.min("component").alias("near"))
        )
        lower = frames.stored(
            labels.join(near, "node").select(
                "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
            ),
            "labels-near",
        )
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = frames.stored(
            lower.join(jump, "component").select(
                "node", "before", F.least("component", "next").alias("component")
            ),
            "labels-jumped",
        )
        if labels.filter("before <> component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
