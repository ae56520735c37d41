"""Connected components of a graph whose edges are rows: minimum labels with pointer jumping.

Every round is written to the shared folder, so an executor lost later costs a re-read.  Labels are
combined before each shuffle, and what a round no longer needs is deleted.  Rounds grow with the logarithm of the longest shortest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martlet.sources.store import Store


def components(edges: DataFrame, store: Store) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (columns ``a``, ``b``); the label is the smallest node reachable.

    Every round reads ``edges`` again, so they should be a stored table.
    """
    both = edges.union(edges.select("b", "a")).toDF("node", "other")
    labels = store.put(
        both.groupBy("node").agg(F.min("other").alias("_least")).select("node", F.least("node", "_least").alias("label")),
        "labels-0",
    )
    turn = 0
    while True:
        turn += 1
        heard = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("_heard"))
        )
        spoken = labels.join(heard, "node").select(F.least("label", "_heard").alias("label"), "node", F.col("label").alias("_old"))
        # the label of a label is at most as large; if no label changes, neighbours have the same one
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        changed = Observation()
        new = spoken.join(jump, "label").select("node", F.col("_next").alias("label"), (F.col("_next") != F.col("_old")).alias("_new"))
        new = new.observe(changed, F.count_if("_new").alias("rows")).select("node", "label")
        labels = store.put(new, f"labels-{turn}")
        store.drop(f"labels-{turn - 1}")
        if not changed.get["rows"]:
            return labels
