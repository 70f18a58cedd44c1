"""Connected components of an undirected graph held as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from climgrid.llm.store import written

MOST = 1 << 16  # edges that a task contracts at once, 1 MB


def _largest_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b")


def _smallest_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def _star_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges' components as stars: each node but the least, with the least."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, (x, y) = np.arange(len(nodes)), (code[: len(a)], code[len(a) :])
    while (root[x] != root[y]).any():
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[root[moved]], nodes[moved]


def _contracted(edges: DataFrame, most: int) -> DataFrame:
    """The edges, of which each task turns every ``most`` that it has into stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ends(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            a, b = _star_ends(t.column("a").to_numpy(), t.column("b").to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if rows + part.num_rows > most:
                    yield ends(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield ends(held)

    return edges.mapInArrow(run, "a long, b long")


def stars(edges: DataFrame, most: int = MOST) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)`` but the components themselves;
    a component is its least node.  Edges may repeat.

    At most ``most`` edges are contracted by one task.  More are first contracted by as many
    tasks as they need; if too many are left, large and small stars alternate until nothing
    moves: edges shrink to one per node; hot nodes only take part in minima, which combine
    before the shuffle, and in joins that split.  Each round is a written table.
    """
    one = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    now = written(one, "edges")
    rows = now.count()
    if rows > most:
        now = written(_contracted(now.coalesce(ceil(rows / most)), most), "edges")
        rows = now.count()
    while rows > most and not _are_stars(now):
        now = written(_smallest_star(_largest_star(now)), "edges")
        rows = now.count()
    if rows <= most:
        now = written(_contracted(now.coalesce(1), most), "edges")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component"))


def components(edges: DataFrame, most: int = MOST) -> DataFrame:
    """``stars`` and the components themselves: all nodes of ``edges(a, b)``."""
    found = stars(edges, most)
    return found.union(found.select("component", "component").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Each node has one end that is smaller, and that one has none."""
    inner = edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").select("b")
    return inner.limit(1).union(edges.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select("b").limit(1)).isEmpty()
