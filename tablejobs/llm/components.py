"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.shared import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that occurs in a link; the component is its smallest node. No links give no rows.

    Each round takes the smallest label among the neighbours and then the label of that label, so distances shrink by more
    than half; labels live in a table written between rounds, never on the driver.
    """
    near, far = F.col(a).alias("node"), F.col(b).alias("other")
    both = links.select(near, far).union(links.select(far.alias("node"), near.alias("other")))
    both = written(both.where("node <> other").distinct(), "links")
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component"))
    while True:
        labels = written(labels, "labels")
        seen = labels.select(F.col("node").alias("other"), F.col("component").alias("reached"))
        nearest = both.join(seen, "other").groupBy("node").agg(F.min("reached").alias("reached"))
        moved = labels.join(nearest, "node").select("node", "component", F.least("component", "reached").alias("step"))
        jump = labels.select(F.col("node").alias("step"), F.col("component").alias("jumped"))
        after = written(moved.join(jump, "step").select("node", "component", F.least("step", "jumped").alias("next")), "labels")
        labels = after.select("node", F.col("next").alias("component"))
        if after.where("next <> component").isEmpty():
            return labels
