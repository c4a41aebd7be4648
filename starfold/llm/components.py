"""Connected components of a link table by least labels and pointer jumping, in joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, shared_checkpoint


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> (node, label): label is the least node that can be reached; only linked nodes appear.

    Each round takes the least label among the neighbours and then the label's label, so the rounds grow with the
    logarithm of the longest path.  Self links and repeated links are harmless; an empty table gives an empty one.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).na.drop().distinct()
    both = shared_checkpoint(both)
    labels = shared_checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    # labels go to their neighbours by broadcast where they are few, else both are shuffled
    few = labels.count() <= BROADCAST_ROWS
    sent = F.broadcast if few else lambda df: df
    while True:
        other = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        nearest = both.join(sent(other), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = labels.join(nearest, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = shared_checkpoint(moved.join(sent(jump), "next", "left").select("node", "label", F.least("next", F.coalesce("far", "next")).alias("next")))
        changed = after.filter("next <> label").limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
