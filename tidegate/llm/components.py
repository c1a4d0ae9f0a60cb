"""Connected components of a graph that is held as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.session import discard, store, workspace


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of `edges` (a, b); a component is named by its least vertex.

    Each round takes the least label among a vertex and its neighbours, then the label of that label.
    Labels only fall, so rounds end when their number of changes is 0. Every round is stored; no
    links or labels come to the driver. A vertex with many edges is combined before the shuffle.
    """
    with workspace(edges.sparkSession):
        both = store(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
        labels = store(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
        while True:
            near = both.join(labels, both["b"] == labels["vertex"]).groupBy(F.col("a").alias("of")).agg(F.min("component").alias("least"))
            lower = labels.join(near, labels["vertex"] == near["of"]).select(
                "vertex", F.col("component").alias("old"), F.least("component", "least").alias("component"),
            )
            ahead = labels.select(F.col("vertex").alias("at"), F.col("component").alias("further"))
            jumped = lower.join(ahead, lower["component"] == ahead["at"], "left").select(
                "vertex", "old", F.least("component", F.coalesce("further", "component")).alias("component"),
            )
            before, labels = labels, store(jumped, "labels")
            discard(before)
            changed = labels.filter("old <> component").limit(1).count()
            labels = labels.select("vertex", "component")
            if not changed:
                return store(labels, "components", outer=True)
