"""Connected components of a link table by least labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: root is its component's least node.

    Every round a node takes the least label of itself and its neighbours and
    then that label's own label, so labels travel in doubling steps; rounds
    end when nothing changes. Links are spread by their ends, a node of many
    links is split by Spark's skew join, and each round is checkpointed, so
    no task or driver holds a component.
    """
    ends = links.select("a", "b").where("a <> b")
    edges = materialize(ends.unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
                        .withColumn("root", F.least("node", "root")))
    while True:
        near = (edges.join(roots, edges.b == roots.node).groupBy("a")
                .agg(F.min("root").alias("near")))
        nearer = roots.join(near, roots.node == near.a).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("step"))
        above = roots.select(F.col("node").alias("step"), F.col("root").alias("jump"))
        moved = materialize(nearer.join(above, "step").select("node", "old", F.least("step", "jump").alias("root")))
        roots = moved.select("node", "root")
        if not moved.where("old <> root").limit(1).collect():
            return roots
