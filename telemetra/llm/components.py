"""Connected components by alternating large-star and small-star steps (Spark joins and sums)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import parts, stored

#: Edges that a task contracts at once, and that one task gets on average.
TASK_EDGES = 200_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of the piece that the edges tie each to)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    up = np.arange(len(nodes))
    while True:
        low = np.minimum(up[x], up[y])
        before = up.copy()
        np.minimum.at(up, up[x], low)
        np.minimum.at(up, up[y], low)
        np.minimum.at(up, x, low)
        np.minimum.at(up, y, low)
        up = up[up]
        if (up == before).all():
            return nodes, nodes[up]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of the edges, a bounded number of edges at a time."""
    held: list[pa.RecordBatch] = []

    def stars():
        a, b = (np.concatenate([np.asarray(x.column(i)) for x in held]) for i in (0, 1))
        nodes, root = roots(a, b)
        keep = nodes != root
        return pa.record_batch([pa.array(nodes[keep]), pa.array(root[keep])], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > 2 * TASK_EDGES:
            yield stars()
            held = []
    if held:
        yield stars()


def _round(edges: DataFrame) -> DataFrame:
    """A large-star step (larger neighbours are tied to the minimum of the neighbourhood), then a small-star
    step (not larger neighbours and the node itself are tied to their minimum). Edges: a > b."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    tied = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b long) -> (id, component): the smallest id reachable, for every id on an edge.

    Before each round every task contracts its own edges; the result is written to the shared
    folder. A forest of stars is the fixed point; its edges are the answer."""
    spark = edges.sparkSession
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.mapInArrow(_contract, "a long, b long"), "edges")
    last = None
    for _ in range(most_rounds):
        tasks = min(parts(spark), edges.count() // TASK_EDGES + 1)
        edges = stored(_round(edges).distinct().coalesce(tasks).mapInArrow(_contract, "a long, b long"), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == last:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")) \
                .union(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        last = state
    raise RuntimeError("components did not settle")
