"""Connected components of an edge table: in one task if the edges are few, else by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard
from .common import written

FEW_EDGES = 1 << 20  # so many edges (16 MB) are joined in one task at most


def least_nodes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up, x, y = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while True:
        one, two = up[x], up[y]
        open_ = one != two
        if not open_.any():
            return nodes, nodes[up]
        np.minimum.at(up, np.maximum(one, two)[open_], np.minimum(one, two)[open_])
        while (up[up] != up).any():
            up = up[up]


def components(edges: DataFrame, most: int = 50, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) of every node of edges(a, b) but the roots: root is the smallest node of its component. Written.

    More than `few` edges go through rounds, each written to the shared folder; the rounds are
    about the logarithm of the longest path, and more than `most` are an error. Self loops
    and repeated edges do no harm.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if now.count() <= few:

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                node, root = least_nodes(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(2)))
                use = node != root
                yield pa.RecordBatch.from_arrays([pa.array(node[use]), pa.array(root[use])], names=["node", "root"])

        out = written(now.coalesce(1).mapInArrow(join, "node long, root long"), "roots")
        discard(now)
        return out
    before = None
    for _ in range(most):
        # large star: every larger neighbour of a node goes to the least of its neighbourhood
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        last, now = now, written(small.where("a <> b").distinct(), "edges")
        discard(last)
        state = tuple(now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            out.written_to = now.written_to
            return out
        before = state
    raise RuntimeError(f"components: not done after {most} rounds")
