"""Connected components by alternating large and small stars.

No neighbourhood is gathered anywhere: each step is a grouped minimum (combined before the shuffle) and a join. The
minima are written before the join, whose sides are then shuffled for it alone, so that adaptive execution can split a
hot vertex. Each step is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm.shared import forget, lean, written

EDGE = "a long, b long"


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (vertex, smallest vertex) with the same components as the edges given; no edge twice."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(ids))
    while True:
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(rx, ry)[apart], np.minimum(rx, ry)[apart])
        while not np.array_equal(step := root[root], root):
            root = step
    own = root != np.arange(len(ids))
    return ids[own], ids[root[own]]


def _contract(frames):
    """Each task keeps a forest of its own edges; bounded by flushing."""
    held: list[np.ndarray] = []
    size = 0
    for f in frames:
        held.append(f[["a", "b"]].to_numpy(np.int64))
        size += len(f)
        if size > 2_000_000:
            e = np.concatenate(held)
            a, b = spanning_forest(e[:, 0], e[:, 1])
            if len(a) > 1_000_000:
                yield pd.DataFrame({"a": a, "b": b})
                a = b = np.empty(0, np.int64)
            held, size = [np.stack([a, b], 1)], len(a)
    if held:
        e = np.concatenate(held)
        a, b = spanning_forest(e[:, 0], e[:, 1])
        yield pd.DataFrame({"a": a, "b": b})


def _large(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The step's edges, and the table of least neighbours that they read."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")), least


def _small(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same; edges come with a > b."""
    least = written(e.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = e.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))), least


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (vertex, component): for each vertex that is not the smallest of its component, the smallest.

    Self loops and repeated edges are ignored; an empty table gives an empty table.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(e.mapInPandas(lean(_contract), EDGE).distinct(), "edges")
    before = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
        if before == tuple(now) or now["n"] == 0:
            return e.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        before = tuple(now)
        for star in (_large, _small):
            edges, least = star(e)
            step = written(edges.distinct(), "edges")
            forget(e)
            forget(least)
            e = step
