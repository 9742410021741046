"""Connected components by least labels, with shortcuts, on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.sources.tables import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node reachable, for each node of ``links`` (a, b).

    Every round takes the least label among a node's neighbours, then the label of that label,
    so chains shorten by powers. Rounds end when the labels no longer change. Each is a stored
    table, so a lost executor costs a read, and both sides of a join come from a shuffle of
    their own, which lets adaptive execution split a label that very many nodes share.
    """
    both = materialize(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = labels.withColumnsRenamed({"node": "b", "label": "other"})
        least = (both.join(seen, "b").groupBy(F.col("a").alias("node"))
                 .agg(F.min("other").alias("other")))
        nearer = materialize(
            labels.join(least, "node")
            .select("node", "label", F.least("label", "other").alias("next")), "labels")
        there = nearer.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        after = materialize(
            nearer.join(there, "next").select("node", "label", F.col("beyond").alias("next")),
            "labels")
        labels = after.select("node", F.col("next").alias("label"))
        if not after.filter("next <> label").limit(1).count():
            return labels
