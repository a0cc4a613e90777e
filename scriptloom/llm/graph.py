"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scriptloom.session import dropped, written


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id in the links (a, b), which need no order and may repeat.

    Each round takes the least label among neighbours and then the label of that label, so distances halve; only
    labels are exchanged, nothing is gathered for a component. Rounds are written tables; a round's labels go when the
    next ones are written. Null ids link with nothing; an empty table has no components.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("_least"))
                     .select(F.col("a").alias("id"), F.least("a", "_least").alias("component")), "labels")
    last = labels
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("_near"))
        step = labels.join(near, labels.id == near.a, "left").select(
            "id", F.col("component").alias("_old"), F.least("component", "_near").alias("component"))
        top = labels.select(F.col("id").alias("_id"), F.col("component").alias("_top"))
        moved = written(step.join(top, F.col("component") == F.col("_id"), "left")
                        .select("id", "_old", F.least("component", "_top").alias("component")), "labels")
        dropped(last)
        labels, last = moved.select("id", "component"), moved
        if not moved.filter("component <> _old").limit(1).count():
            dropped(both)
            return labels
