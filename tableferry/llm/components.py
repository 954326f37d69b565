"""Connected components of link tables, in rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableferry.session import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``links`` (``a, b``): the smallest id reachable.

    Each round every id takes the smallest label among its own, its neighbours' and its label's
    label. Minima are combined in tasks before they are shuffled, and a label's label doubles the
    distance that a minimum has travelled, so chains need few rounds.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(),
                  "cc-links").where("a <> b")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "cc-labels")
    while True:
        heard = (both.join(labels, both["b"] == labels["id"]).groupBy("a")
                 .agg(F.min("component").alias("heard")))
        near = labels.join(heard, labels["id"] == heard["a"], "left").select(
            "id", F.col("component").alias("old"),
            F.least("component", F.coalesce("heard", "component")).alias("component"))
        near = stored(near, "cc-near")
        hop = near.select(F.col("id").alias("_id"), F.col("component").alias("_far"))
        labels = stored(near.join(hop, near["component"] == hop["_id"], "left").select(
            "id", "old", F.least("component", F.coalesce("_far", "component")).alias("component")),
            "cc-labels")
        if labels.where("component <> old").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
