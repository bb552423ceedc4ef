"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node in ``links`` (``a, b``): the least node of its component.

    Labels go along links and then along labels (a node takes its label's label), so the number of
    rounds grows with the logarithm of a component's width. Each round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "component-links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        .select("node", F.least("node", "label").alias("label")), "component-labels")
    while True:
        seen = both.join(labels.hint("merge"), F.col("b") == F.col("node")).select(
            F.col("a").alias("node"), "label")
        least = seen.union(labels).groupBy("node").agg(F.min("label").alias("label"))
        of_label = labels.select(F.col("node").alias("n"), F.col("label").alias("next"))
        moved = written(
            least.join(of_label.hint("merge"), F.col("label") == F.col("n"), "left")
            .select("node", F.least("label", "next").alias("label")), "component-labels")
        old = labels.select(F.col("node").alias("n"), F.col("label").alias("was"))
        changed = moved.join(old.hint("merge"), F.col("node") == F.col("n")).where("label <> was")
        if changed.isEmpty():
            return moved
        labels = moved
