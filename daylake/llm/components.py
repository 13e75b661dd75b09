"""Connected components of a graph of links, as Spark jobs.

Alternating stars: every node hands its greater neighbours to its least neighbour,
then every node hands itself and its lesser neighbours to the least of them.  When
nothing changes, each component is a star around its least node.  Each half step is
one grouping and one join of links; every full step is written to the shared folder,
so lost executors repeat at most one step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from daylake.session import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(links: DataFrame, max_steps: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links`` (u, v: long), root being its component's
    least node.

    Self links are ignored; repeated and reversed links are one.  No links: no rows.
    The number of steps grows with the logarithm of the longest chain; a graph that
    needs more than ``max_steps`` is an error, never a wrong result.
    """

    def normal(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct()

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    current = stage(normal(links), "links")
    before = mark(current)
    for _ in range(max_steps):
        if not before[0]:
            break
        current = stage(normal(_small_star(normal(_large_star(current)))), "stars")
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components are not complete after the allowed steps")
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each of n nodes' component under the links a[i]-b[i]."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while True:  # pointer jumping
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
