"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """Vertices of links (a, b) and the smallest vertex each one reaches: v, label.

    Each round takes the smallest label among a vertex's neighbours, then the label of its label, so the rounds grow
    with the logarithm of the longest way, not with the way.  A vertex with very many links is combined in each task
    before the shuffle.  Rounds are written tables; the driver sees only how many labels changed.
    """
    both = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select("b", "a")).where("v <> u").distinct()
    edges = stage(both, "edges")
    labels = stage(edges.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnsRenamed({"v": "u", "label": "l"}), "u").groupBy("v").agg(F.min("l").alias("near"))
        moved = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = moved.join(labels.select(F.col("v").alias("at"), F.col("label").alias("further")), F.col("label") == F.col("at"), "left")
        labels = stage(jumped.select("v", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("v", "label")
