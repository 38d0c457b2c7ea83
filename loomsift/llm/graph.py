"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node that it is connected with.

    Each round takes the least label among the neighbours and then jumps to
    that label's own label, so long chains shrink fast.
    """
    both = cut(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        low = labels.join(near, "node").select("node", F.least("root", "near").alias("low"), F.col("root").alias("old"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        new = cut(low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("root"), "old"))
        if not new.where("root <> old").limit(1).count():
            return new.select("node", "root")
        labels = new.select("node", "root")
