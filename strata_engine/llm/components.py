"""Connected components of a link table, by label propagation with pointer
shortcuts. Nothing is collected; every round is one written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """id, component (its smallest reachable id) of every id in ``links``
    (columns a, b, any direction, repeats allowed). No links, no rows.

    A round takes the smallest label among a node and its neighbours, then
    the label of that label, so chains shrink by halves.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "cc-links")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "cc-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("near"))
        better = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        # the label's own label; labels are ids of the same table
        roots = labels.select(F.col("id").alias("mid"), F.col("component").alias("root"))
        labels = materialize(
            better.join(roots, "mid").select("id", F.least("mid", "root").alias("component"), "old"), "cc-labels"
        )
        if labels.where("component <> old").limit(1).count() == 0:
            return labels.select("id", "component")
        labels = labels.drop("old")
