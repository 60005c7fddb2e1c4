"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.llm.rows import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge, the component being its least node.

    Each round a node takes the least label around it, then the label of that node, so labels travel twice as far with
    every round and a chain of n nodes takes about log n of them. Rounds end when no label changes. Null ends are left
    out; loops and repeated edges change nothing.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    both = stored(
        pairs.union(pairs.select("b", "a")).where("a <> b").distinct()
    )
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("least"))
        )
        lowered = stored(
            labels.join(around, labels["node"] == around["a"]).select(
                "node", "label", F.least("label", "least").alias("low")
            )
        )
        far = lowered.select(F.col("node").alias("at"), F.col("low").alias("lower"))
        jumped = stored(
            lowered.join(far, lowered["low"] == far["at"], "left").select(
                "node", "label", F.least("low", F.coalesce("lower", "low")).alias("new")
            )
        )
        labels = jumped.select("node", F.col("new").alias("label"))
        if jumped.where("new <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
