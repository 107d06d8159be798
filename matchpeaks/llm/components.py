"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    A round gives a node the least label among its neighbours' and then the label of that
    label, so chains shrink quickly. Each round is written down, and nothing is collected.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a")).distinct()
    both = stored(both, "edges")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("component"))
    labels = stored(labels, "labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("component").alias("told"))
        lower = labels.join(told, "node").select("node", "component", F.least("component", "told").alias("lower"))
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("jump"))
        moved = lower.join(jump, "lower", "left").select("node", F.least("lower", "jump").alias("now"), (F.least("lower", "jump") < F.col("component")).alias("moved"))
        moved = stored(moved, "labels")
        labels = moved.select("node", F.col("now").alias("component"))
        if moved.where("moved").isEmpty():
            return labels


def contracted(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components ``found`` (node, component) after further links (a, b); only links between components count.

    The links become links between component labels, mostly far fewer, and only those go through the rounds.
    """
    if found is None:
        return components(links)
    for side in ("a", "b"):
        label = found.select(F.col("node").alias(side), "component")
        links = links.join(label, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
    edges = stored(links.where("a <> b").distinct(), "edges")
    if edges.isEmpty():
        return found
    joined = components(edges)
    lower = joined.select(F.col("node").alias("component"), F.col("component").alias("lower"))
    moved = found.join(lower, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
    return stored(moved.union(joined.join(found.select("node"), "node", "left_anti").select("node", "component")), "labels")
