"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import cut


#: Nodes that a task holds at a time while it contracts its edges.
_AT_ONCE = 500_000


def _contracted(e: DataFrame) -> DataFrame:
    """Each task's edges replaced by stars around its smallest nodes: the same components, far fewer rounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def top(x: int) -> int:
            root = x
            while (above := up.get(root, root)) != root:
                root = above
            while up.get(x, root) != root:
                up[x], x = root, up[x]
            return root

        def stars() -> pa.RecordBatch:
            pairs = [(x, top(x)) for x in list(up)]
            pairs = [(x, r) for x, r in pairs if x != r]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())],
                                              names=["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = top(u), top(v)
                if a != b:
                    a, b = max(a, b), min(a, b)
                    up[a] = up[b] = b
            if len(up) > _AT_ONCE:
                yield stars()
                up.clear()
        yield stars()

    return e.select("u", "v").mapInArrow(run, "u long, v long")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v; longs, not null), component = its smallest node.

    Each round joins the edges with the smallest neighbour of every node (one row per node), so a node with very many
    neighbours meets one row, never its neighbours among themselves; rounds grow with the logarithm of the longest
    path, after each task has contracted the edges that it holds. Every round is checkpointed, so the plan stays short
    and a lost executor costs one round. The driver sees two numbers per round. Empty edges give an empty result; self-loops are ignored.
    """
    e = cut(edges.where("u != v").select("u", "v"))
    before = None
    while True:
        after = _state(e)
        if after == before:
            break
        few = e.coalesce(1 + after[0] // _AT_ONCE)  # a task holds about that many edges; small lists need no more tasks
        before, e = after, cut(_small_star(_large_star(_contracted(few))))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
