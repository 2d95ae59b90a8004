"""Connected components by label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node of the component.

    ``nodes`` has ``node``, ``edges`` has ``a`` and ``b``, in one direction.
    Every round gives a node the least label of its neighbours' labels, hooks the
    old label onto it and jumps labels twice, so the rounds grow with the
    logarithm of a component's diameter. Each round's labels are checkpointed in
    the shared folder; nothing but a changed flag reaches the driver. Meant for
    graphs of bounded degree (cells of a grid)."""
    ensure_checkpoint_dir(nodes.sparkSession)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).checkpoint()
    label = nodes.select("node", F.col("node").alias("label")).distinct().checkpoint()
    while True:
        seen = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        met = label.join(seen, "node", "left").select("node", "label", F.least("label", "near").alias("near"))
        # the old label learns what any of its nodes has met
        hook = met.groupBy(F.col("label").alias("node")).agg(F.min("near").alias("hook"))
        new = (met.join(hook.withColumnRenamed("node", "label"), "label")
               .select("node", F.least("near", "hook").alias("label")))
        for _ in range(2):
            up = new.select(F.col("node").alias("label"), F.col("label").alias("up"))
            new = new.join(up, "label").select("node", F.least("label", "up").alias("label"))
        new = new.checkpoint()
        if not new.join(label.withColumnRenamed("label", "old"), "node").where("label <> old").take(1):
            return new
        label = new
