"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of one type -> (node, label), the label being the least node reachable.

    A round hooks every label to the least label next to it, follows the hooks to
    their ends (doubling the reach each time), and contracts the edges. Only
    labels less than all beside them are left, at most half; so rounds, and the
    doublings in each, grow with the logarithm of the graph. All steps are joins on a label and minima,
    which combine before the shuffle; a hub's edges are an ordinary skewed join.
    Nodes without edges are not in the result; nulls and loops are ignored.
    """
    rest = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    rest = settled(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = rest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = settled(both.withColumn("label", F.col("node")))
    while not rest.isEmpty():
        turned = rest.union(rest.select("b", "a"))
        hooks = turned.groupBy("a").agg(F.min("b").alias("b"))
        hooks = settled(hooks.select(F.col("a").alias("old"), F.least("a", "b").alias("new")))
        moving = True
        while moving:
            onward = hooks.select(F.col("old").alias("at"), F.col("new").alias("end"))
            jumped = hooks.join(onward, F.col("new") == F.col("at"))
            jumped = settled(jumped.select("old", F.col("end").alias("new"), (F.col("end") != F.col("new")).alias("moved")))
            moving = not jumped.where("moved").isEmpty()
            hooks = jumped.drop("moved")
        labels = settled(
            labels.join(hooks, F.col("label") == F.col("old"), "left").select(
                "node", F.coalesce("new", "label").alias("label")
            )
        )
        left = hooks.select(F.col("old").alias("a"), F.col("new").alias("a_new"))
        right = hooks.select(F.col("old").alias("b"), F.col("new").alias("b_new"))
        rest = rest.join(left, "a").join(right, "b").where("a_new != b_new")
        rest = settled(rest.select(F.least("a_new", "b_new").alias("a"), F.greatest("a_new", "b_new").alias("b")).distinct())
    return labels
