"""Connected components by least labels and pointer jumping, a written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowferry.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b; nodes of any ordered type).

    The label is the least node reachable. Each round takes the least label of all neighbours, then
    the label of the label, so the rounds grow with the logarithm of the longest chain. Nothing is
    collected but the number of changed labels. No links give no rows.
    """
    both = settle(
        links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").where("a != b").distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("a"), F.min("b")).alias("label")).select("node", "label"), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        )
        least = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jumped = least.alias("x").join(
            labels.select(F.col("node").alias("via"), F.col("label").alias("far")),
            F.col("label") == F.col("via"), "left",
        ).select("node", "before", F.least("label", F.coalesce("far", "label")).alias("label"))
        settled = settle(jumped, "labels")
        labels = settled.select("node", "label")
        if settled.where("label != before").limit(1).count() == 0:
            return labels
