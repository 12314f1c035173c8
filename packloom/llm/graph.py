"""Connected components of edge lists: local union-find, then hooking and contraction between partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm._store import cut


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: each node with the smallest node that it reaches here."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(find(x), x) for x in list(parent) if find(x) != x]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component): every node of ``edges`` (u, v: longs) that isn't itself the smallest node that it reaches, with that node.

    Each round hooks every node to the smallest of its neighbours and itself and contracts the edges along the hooks, which keeps what
    is connected connected; each keeps only nodes that still have edges. Nodes' hooks are followed as they are found. Joins
    are with written tables, whose sizes are known: Spark carries a side to all tasks only if it is below its threshold, and can split shuffled ones at hubs.
    """
    e = cut(edges.where("u <> v").select("u", "v").mapInArrow(_forest, "u long, v long").distinct())
    root = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
        if root is None:
            root = low.select(F.col("u").alias("id"), F.col("m").alias("component"))
        else:
            hook = low.select(F.col("u").alias("component"), F.col("m").alias("m"))
            root = cut(root.join(hook, "component", "left").select("id", F.coalesce("m", "component").alias("component")))
        to = low.select(F.col("u").alias("v"), F.col("m").alias("mv"))
        e = e.join(low, "u").join(to, "v").where("m <> mv")
        e = cut(e.select(F.least("m", "mv").alias("u"), F.greatest("m", "mv").alias("v")).distinct())
    if root is None:
        return e.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return root.where("id <> component")
