"""Connected components of a large graph by alternating star steps.

Large-star links every larger neighbour of a node to the smallest node in
reach; small-star does it for the smaller neighbours.  Both keep components as
they are and end in one star per component, after a number of rounds that
grows with the logarithm of the graph.  Every step is an aggregate with
partial sums and a join, and every round is written once to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stored


def spanning_forest(pairs) -> dict[int, int]:
    """Root by node for the nodes of ``pairs``; the smallest node is the root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for u, v in pairs:
        a, b = find(u), find(v)
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = spanning_forest(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        a = [x for x, r in roots.items() if x != r]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(a, pa.int64()), "b": pa.array([roots[x] for x in a], pa.int64())})


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns, either
    direction, repeats and loops allowed); the component is its smallest node.
    Nodes with loops only, or without edges, are left out."""
    u, v = edges.columns[:2]
    e = edges.filter(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("a"), F.least(u, v).alias("b"))
    e = stored(e.mapInArrow(_contract, "a long, b long").distinct(), "components")
    seen = None
    while True:
        # one small row: has the graph changed?
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        e = stored(_small_star(_large_star(e)), "components")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
