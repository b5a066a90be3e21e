"""Connected components of a table of links, in rounds of joins over written tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import Workspace, join_unique


def _contract(batches):
    """The links of one partition as stars around the smallest node they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = list(parent)
    if nodes:
        yield pa.RecordBatch.from_arrays(
            [pa.array([root(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())],
            ["a", "b"])


def components(workspace: Workspace, links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected to, for linked nodes.

    Links are first contracted inside each partition.  Each round then takes the
    smallest label among the neighbours and follows that label's own label, so
    long chains halve in length.  A node with many neighbours, and a label of many nodes, is
    joined by ``join_unique``.  An empty table of links gives an empty table.
    """
    links = workspace.save(links.mapInArrow(_contract, "a bigint, b bigint"), f"{name}-links")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    labels = workspace.save(both.groupBy("node").agg(
        F.least("node", F.min("other")).alias("component")), f"{name}-0")
    degrees = workspace.save(both.groupBy("other").agg(F.count(F.lit(1)).alias("degree")), f"{name}-degrees")
    rows, nodes = both.count(), degrees.count()
    number = 0
    while True:
        number += 1
        near = (join_unique(both, labels.toDF("other", "label").join(degrees, "other"), ["other"],
                            "degree", rows).groupBy("node").agg(F.min("label").alias("label")))
        lower = workspace.save(labels.join(near, "node").select(
            "node", "component", F.least("component", "label").alias("label")), f"{name}-{number}-lower")
        jump = (lower.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"))
                .join(labels.toDF("label", "next"), "label"))
        following = join_unique(lower, jump, ["label"], "nodes", nodes).select(
            "node", F.least("label", "next").alias("component"),
            (F.least("label", "next") < F.col("component")).alias("moved"))
        following = workspace.save(following, f"{name}-{number}")
        moved = not following.where("moved").isEmpty()
        workspace.drop(f"{name}-{number - 1}", f"{name}-{number}-lower")
        labels = following.select("node", "component")
        if not moved:
            return labels
