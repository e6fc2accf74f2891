"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``a, b``; the label is the component's smallest node.

    Labels spread to neighbours and are then replaced by the labels of the nodes they name, so the
    number of rounds grows with the logarithm of a component's width. Every round is written to the
    shared folder. A node with very many links is summed up in the map tasks first.
    """
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = materialize(ends.filter("a <> b").distinct(), "component-links")
    labels = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = materialize(labels.select("node", F.least("node", "low").alias("label")), "component-labels")
    while True:
        heard = ends.join(labels, ends.a == labels.node).groupBy("b").agg(F.min("label").alias("heard"))
        spread = labels.join(heard, labels.node == heard.b, "left").select(
            "node", "label", F.least("label", F.coalesce("heard", "label")).alias("low")
        )
        named = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        jumped = spread.join(named, "low", "left").select(
            "node", F.col("label").alias("old"), F.least("low", F.coalesce("jump", "low")).alias("label")
        )
        jumped = materialize(jumped, "component-labels")
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels
