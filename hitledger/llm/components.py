"""Connected components of edge tables: union-find inside tasks, smallest labels between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.stages import drop_stage, shared


def forest(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union-find: (node, smallest node reachable) for all nodes but the roots."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's edges as a spanning forest: no more rows than came in, fewer in dense groups."""
    for batch in batches:
        found = forest(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
        nodes, roots = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) long pairs; the smallest node names a component.

    Rounds of smallest neighbour labels with pointer jumping, so long chains need few. Every round
    is a table in the shared folder. A node with very many neighbours makes a skewed join, which
    adaptive execution splits.
    """
    reduced = shared(edges.select("a", "b").where("a <> b").mapInArrow(_reduced, "a long, b long"))
    both = shared(reduced.union(reduced.select("b", "a")).distinct())
    labels = shared(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        offered = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("offer"))
        )
        lower = labels.join(offered, labels["node"] == offered["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "offer").alias("component")
        )
        lower = shared(lower)
        up = lower.select(F.col("node").alias("up"), F.col("component").alias("jump"))
        jumped = lower.join(up, lower["component"] == up["up"], "left").select(
            "node", F.coalesce("jump", "component").alias("component"), "old"
        )
        jumped = shared(jumped)
        changed = not jumped.where("component <> old").isEmpty()
        drop_stage(lower)
        labels = jumped.select("node", "component")
        if not changed:
            return labels
