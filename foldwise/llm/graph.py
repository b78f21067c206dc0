"""Connected components of an edge table, entirely in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``): the root is
    the same for all nodes of a component and is one of them.

    Each round every node takes the smallest label among itself and its
    neighbours, edges are relabelled, and those inside one label vanish;
    the labels of one round that point at each other are followed in the
    next.  Rounds are written to the shared folder, so an executor lost in
    one costs that round only.  Sums per label are combined before the
    shuffle, so a hub of any degree is one row per task.
    """
    live = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-edges")
    labels = written(live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), f"{name}-labels")
    while not live.isEmpty():
        # both ends hook to the smallest end of their edges
        hook = written(live.select(F.explode(F.array("a", "b")).alias("n"), F.col("a").alias("to")).groupBy("n").agg(F.min("to").alias("to")), f"{name}-hook")
        up = hook.select(F.col("n").alias("root"), "to")
        labels = written(labels.join(up, "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"{name}-labels")
        ha, hb = hook.select(F.col("n").alias("a"), F.col("to").alias("x")), hook.select(F.col("n").alias("b"), F.col("to").alias("y"))
        live = written(live.join(ha, "a").join(hb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-edges")
    return labels
