"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, component) for every id in links (a, b): the smallest id that it can reach.

    Each round takes the smallest label among the neighbours and then the label of that label, so that chains halve. The
    rounds are joins and minima with partial aggregation; labels are written to the shared folder after each, and the last ones go.
    """
    scratch = scratch or Scratch(links.sparkSession)
    both = scratch.write(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component"))
    held = scratch.write(labels)
    labels = held
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.least("component", "near").alias("label"), F.col("component").alias("old"))
        jump = labels.select(F.col("id").alias("label"), F.col("component").alias("far"))
        new = scratch.write(lower.join(jump, "label", "left").select("id", F.least("label", "far").alias("component"), "old"))
        scratch.drop(held)
        held, labels = new, new.drop("old")
        if not new.filter("component <> old").limit(1).count():
            scratch.drop(both)
            return labels
