"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import saved, saved_counted


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b): comp is the
    smallest node reachable. Smallest-neighbour propagation with pointer
    jumping; each round is written to the shared folder, and the write itself
    counts the labels that moved. An empty edge table gives an empty result."""
    both, seen = saved_counted(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", n=F.count(F.lit(1))
    )
    if not seen["n"]:
        return both.toDF("node", "comp")
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        )
        low = labels.join(near, labels.node == near.a).select("node", "comp", F.least("comp", "m").alias("low"))
        step = labels.select(F.col("node").alias("low"), F.col("comp").alias("jump"))
        jumped = low.join(step, "low").select("node", F.least("low", "jump").alias("comp"), (F.col("comp") != F.least("low", "jump")).alias("moved"))
        new, seen = saved_counted(jumped, "labels", moved=F.count_if("moved"))
        labels = new.select("node", "comp")
        if not seen["moved"]:
            return labels


def extended(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """``comp`` (node, comp) after adding ``edges`` (columns a, b), whose nodes
    may be new: only the graph between components is searched."""
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(comp.toDF(end, "c"), end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    moved = components(ends.where("a <> b"))
    old = comp.join(moved.toDF("comp", "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return saved(old.unionByName(moved.join(comp.select("node"), "node", "left_anti")), "labels")


def lowest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each node's component over the links i-j of n nodes."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new
