"""Connected components of a table of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveband.llm.shared import written


def relabelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The rows with the column's value, a node, replaced by its label in ``labels(node, label)``, where it has one."""
    of = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return rows.join(of, column, "left").withColumn(column, F.coalesce("_label", column)).select(*rows.columns)


def _between(links: DataFrame) -> DataFrame:
    """Each link of two nodes once, the smaller first."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``: the smallest node that it reaches.

    A round gives each node that is its own label the smallest of its neighbours, if that is smaller, then every node the
    label of its label, so that chains shorten by half. The links are then between labels, and those
    within one are gone, so a group that has met costs nothing more. A round is two written tables. The loop ends when
    no links are left and no label has changed. Every aggregate is a minimum, which combines before its shuffle.
    """
    links, labels = written(_between(links), "links"), None
    while True:
        near = links.select(F.col("b").alias("node"), F.col("a").alias("near"))
        if labels is None:
            every = near.union(links.select(F.col("a").alias("node"), F.col("a").alias("near")))
            hooked = every.groupBy("node").agg(F.min("near").alias("label")).withColumn("old", F.col("label"))
        else:
            lower = near.groupBy("node").agg(F.min("near").alias("near"))
            label = F.when(F.col("node") == F.col("label"), F.coalesce("near", "label")).otherwise(F.col("label"))
            hooked = labels.join(lower, "node", "left").select("node", label.alias("label"), F.col("label").alias("old"))
        following = written(relabelled(hooked, hooked.select("node", "label"), "label"), "labels")
        labels = following.select("node", "label")
        links = written(_between(relabelled(relabelled(links, labels, "a"), labels, "b")), "links")
        if links.isEmpty() and following.where("old <> label").isEmpty():
            return labels
