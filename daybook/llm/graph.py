"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import noted, removed, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``links(a, b)``.

    Every round takes the smallest label among the neighbours, then follows the
    label's own label, so the number of rounds grows with the logarithm of the
    longest path. Each round is written to the shared folder, where it takes the place
    of the one before; the driver only learns whether a label changed.
    """
    with noted() as made:
        labels = _rounds(links, made)
        kept = made.pop()
        removed(links.sparkSession, made)
        made.append(kept)
    return labels


def _rounds(links: DataFrame, made: list[str]) -> DataFrame:
    """``components``; the last of the tables ``made`` is the one it returns."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "edges")
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("component")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        closer = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        after = stored(
            closer.join(jump, "mid", "left").select(
                "node", "before", F.least("mid", F.coalesce("far", "mid")).alias("component")
            ),
            "labels",
        )
        removed(links.sparkSession, [made.pop(-2)])  # the round before
        changed = after.where("before <> component").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
