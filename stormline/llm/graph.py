"""Connected components by rounds of joins: a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.llm.store import Scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the (src, dst) links; component: its smallest node.

    A round gives every node the smallest label among its neighbours; from the second round on also
    the label of its label, so a long chain halves each time. Rounds stop when no label moves. Loops and repeated links change
    nothing; a link with a null end is ignored; no links give no rows. Each round is
    stored, so that a lost executor never restarts the rounds, and the round before is freed.
    """
    scratch = Scratch(edges.sparkSession)
    once = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()
    ).distinct()
    both = scratch.put(once.select(F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e")).select("e.*"), "links")
    labels = scratch.put(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.min("src")).alias("component")), "labels")
    rounds = 0
    while True:
        rounds += 1
        told = both.join(labels.toDF("dst", "c"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("c").alias("m"))
        near = labels.join(told, "node").select("node", "component", F.least("component", "m").alias("m"))
        if rounds > 1:
            near = near.join(labels.toDF("m", "far"), "m").select("node", "component", F.least("m", "far").alias("m"))
        moved = scratch.put(near.select("node", F.col("m").alias("component"), (F.col("m") < F.col("component")).alias("moved")), "labels")
        labels = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            scratch.drop("links")
            return labels
