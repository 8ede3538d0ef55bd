"""Connected components of an edge table, by least labels and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``edges`` (a, b); the root is the least vertex of its component."""
    both = edges.select("a", "b").where("a <> b")
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("root").alias("m"))
        lower = labels.join(near, F.col("v") == F.col("a"), "left").select("v", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("root"))
        lower = materialize(lower, "labels-near")
        ends = lower.select(F.col("v").alias("at"), F.col("root").alias("next"))
        jumped = lower.join(ends, F.col("root") == F.col("at"), "left").select("v", "old", F.least("root", F.coalesce("next", "root")).alias("root"))
        jumped = materialize(jumped, "labels")
        if jumped.where("root <> old").limit(1).count() == 0:
            return jumped.select("v", "root")
        labels = jumped.select("v", "root")
