"""Connected components of an edge table, by label spreading with short cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keelstone.llm.shared import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id on an edge; component_id is the smallest id reached.

    Each round hooks the root of every edge's larger side to the smaller root,
    then replaces labels by the labels of their labels until they stand still
    (pointer jumping), so the number of rounds grows with the logarithm of the
    longest chain. Labels and edges stay in staged tables; the driver sees one
    count per round. Rounds go on until no edge joins two labels.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    links = stage(links, "links")
    labels = (
        links.select(F.explode(F.array("a", "b")).alias("id"), F.least("a", "b").alias("low"))
        .groupBy("id").agg(F.min("low").alias("label"))
    )
    labels = stage(labels.select("id", F.least("id", "label").alias("label")), "labels")
    while True:
        labels = _shorten(labels)
        roots = stage(
            links.join(labels.select(F.col("id").alias("a"), F.col("label").alias("ra")), "a")
            .join(labels.select(F.col("id").alias("b"), F.col("label").alias("rb")), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "roots",
        )
        if roots.isEmpty():
            return labels.select("id", F.col("label").alias("component_id"))
        # From here on only edges between labels matter.
        links = roots
        hooks = roots.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("hook"))
        labels = stage(
            labels.join(hooks, "id", "left")
            .select("id", F.coalesce(F.least("label", "hook"), "label").alias("label")),
            "labels",
        )


def _shorten(labels: DataFrame) -> DataFrame:
    """Replace labels by their roots. A label is never larger than its id."""
    while True:
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("up"))
        nxt = stage(
            labels.join(up, "label", "left")
            .select("id", F.coalesce("up", "label").alias("label"),
                    (F.coalesce("up", "label") != F.col("label")).alias("moved")),
            "labels",
        )
        still = nxt.where("moved").isEmpty()
        labels = nxt.select("id", "label")
        if still:
            return labels
