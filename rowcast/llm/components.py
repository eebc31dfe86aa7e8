"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import BROADCAST_ROWS, stored


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, component)``, the component being its smallest node, for nodes with an edge.

    Every round a node and the node it is labelled by take the smallest label
    that the labels of its neighbours and its own label have (hooking and
    shortcutting at once), so rounds follow the logarithm of a chain's length,
    however its nodes are named. A round is one table written; only counts of
    labels come to the driver. Labels are broadcast while they are few. NULL
    ends and loops are ignored; an empty edge list gives no rows.
    """
    ends = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ((left, right), (right, left))]
    both = stored(edges.select(F.inline(F.array(*ends))).filter("node <> other"), "edges")
    labels = both.groupBy("node").agg(F.min("other").alias("least"))
    labels = stored(labels.select("node", F.least("node", "least").alias("component")), "labels")
    # Two longs a row: the bound on rows is one on bytes.
    few = labels.count() <= BROADCAST_ROWS
    while True:
        own = labels.select("node", F.col("component").alias("other"), F.col("component").alias("was"))
        around = both.unionByName(own, allowMissingColumns=True)
        jump = labels.select(F.col("node").alias("other"), F.col("component").alias("far"))
        jump = F.broadcast(jump) if few else jump
        for _ in range(2):
            around = around.join(jump, "other").select("node", F.col("far").alias("other"), "was")
        around = around.join(jump.select(F.col("other").alias("node"), F.col("far").alias("top")), "node")
        hooks = [F.struct("node", "other", "was"), F.struct(F.col("top").alias("node"), "other", F.lit(None).cast("long").alias("was"))]
        after = around.select(F.inline(F.array(*hooks))).groupBy("node").agg(F.max("was").alias("was"), F.min("other").alias("component"))
        after = stored(after, "labels")
        if after.filter("component <> was").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
