"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every id that has a link; the component is the smallest id reachable.

    Each round takes the smallest label among a node's neighbours and then the label's own label, so chains shrink by
    half; rounds are written to the shared folder and end when nothing changes. Null ends and self-links do not count.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    links = stage(links.union(links.select("b", "a")), "links")
    labels = stage(links.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    labels = labels.select(F.col("a").alias("id"), "component")
    while True:
        near = (
            links.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("before"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        following = stage(
            lower.join(jump, "component", "left").select(
                "id", F.coalesce(F.least("component", "far"), "component").alias("component"), "before"
            ),
            "labels",
        )
        changed = not following.where(F.col("component") != F.col("before")).isEmpty()
        labels = following.select("id", "component")
        if not changed:
            return labels
