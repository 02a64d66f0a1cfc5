"""Connected components of a table of links, by hooking to the least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.workspace import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the least node reachable.

    Each round takes the least label among a node and its neighbours, then jumps to that label's own
    label, so the number of rounds grows with the logarithm of the longest path about. All tables
    are written between rounds, so a lost executor costs no round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    written = labels
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "root", F.least("root", "near").alias("new")
        )
        hooked = materialize(hooked, "hooked")
        jumped = hooked.join(hooked.select(F.col("node").alias("new"), F.col("new").alias("far")), "new").select(
            "node", F.col("root").alias("old"), F.least("new", "far").alias("root")
        )
        jumped = materialize(jumped, "jumped")
        discard(hooked, written)
        if jumped.filter("old <> root").limit(1).count() == 0:
            discard(both)
            return jumped.select("node", "root")
        labels, written = jumped.select("node", "root"), jumped
