"""Connected components of an edge table: least labels with jumps, a few joins a round, nothing on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import removed, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node that has an edge; the label is the least node of its component.

    Each round every node takes the least label among its own, its neighbours' and that of its label, so that
    long chains halve. Rounds end as soon as no label changes.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    none, least = F.lit(None).cast(labels.schema["label"].dataType), (F.min("label").alias("label"), F.max("old").alias("old"))
    while True:
        offered = both.join(labels, F.col("u") == F.col("node")).select(F.col("v").alias("node"), "label", none.alias("old"))
        near = labels.withColumn("old", F.col("label")).unionByName(offered).groupBy("node").agg(*least)
        # a root hears of the better labels that its nodes have found
        hooks = near.where("label < old").select(F.col("old").alias("node"), "label", none.alias("old"))
        best = near.unionByName(hooks).groupBy("node").agg(*least)
        up = best.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        jumped = best.join(up, "label", "left").select("node", F.least("label", F.coalesce("higher", "label")).alias("label"), "old")
        new = written(jumped, "labels")
        # the label before stands beside the new one, so that no join has to tell
        changed = new.where("label <> old").limit(1).count()
        removed(labels)
        labels = new.select("node", "label")
        if not changed:
            removed(both)
            return labels
