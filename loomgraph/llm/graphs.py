"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label: the smallest node that links (a, b) reach from it. Nodes without a link are left out.

    Each round a node takes the smallest label of its neighbours, then the label of that label; rounds grow with the logarithm of a
    component's diameter in the usual case. Labels are written each round, so that the plan stays short.
    """
    both = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).filter("u <> v").distinct(), "links")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), "labels")
    for _ in range(most_rounds):
        told = both.join(labels.withColumnRenamed("node", "u"), "u").groupBy(F.col("v").alias("node")).agg(F.min("label").alias("heard"))
        near = labels.join(told, "node").select("node", F.least("label", "heard").alias("low"), F.col("label").alias("was"))
        of = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        new = written(near.join(of, "low", "left").select("node", F.least("low", F.coalesce("lower", "low")).alias("label"), "was"), "labels")
        labels = new.select("node", "label")
        if new.filter("label <> was").isEmpty():
            return labels
    raise RuntimeError(f"components of more than {most_rounds} rounds")
