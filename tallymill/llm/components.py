"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import stored


def connected(links: DataFrame) -> DataFrame:
    """``c``, ``label`` (smallest number reachable) for every number in ``links`` (``x``, ``y``).

    Each round takes the smallest label of the neighbours, then the label's own label, so the
    number of rounds grows with the logarithm of the longest way.  A hub's neighbours are reduced
    before they are shuffled.
    """
    both = stored(links.select(F.col("x").alias("c"), F.col("y").alias("to")).union(links.select("y", "x")).where("c != to").distinct(), "links")
    labels = stored(both.groupBy("c").agg(F.min("to").alias("to")).select("c", F.least("c", "to").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("c", "to"), "to").groupBy("c").agg(F.min("label").alias("near"))
        # Written, so that rows with one frequent label can be split in the join with that label's own row.
        lower = stored(labels.join(near, "c").select("c", "label", F.least("label", "near").alias("lower")), "lower")
        hop = lower.select(F.col("c").alias("lower"), F.col("lower").alias("next"))
        moved = stored(lower.join(hop, "lower", "left").select("c", "label", F.least("lower", F.coalesce("next", "lower")).alias("after")), "labels")
        labels = moved.select("c", F.col("after").alias("label"))
        if moved.where("after != label").isEmpty():
            return labels
