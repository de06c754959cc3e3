"""Connected components: of edge tables (distributed) and of one block of rows (numpy)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns ``a`` and ``b``);
    component is the smallest node reachable. Rows with a null end and loops link
    nothing; an empty table gives an empty table.

    Alternating large-star and small-star steps until the edge set stays the same:
    every step is an aggregate (pre-aggregated, so a hot node is no hot task) and an
    equi-join that AQE can split. Each round is checkpointed, so lost executors cost one
    round at most.
    """
    stars = cut_lineage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u != v").distinct())
    state = _state(stars)
    while state[0]:
        stars = cut_lineage(_small_star(_large_star(stars)))
        before, state = state, _state(stars)
        if state == before:
            break
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first())


def _large_star(stars: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node of u's neighbourhood."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.withColumnRenamed("m", "v")).distinct()


def local_roots(n: int, near: Callable[[np.ndarray, np.ndarray], np.ndarray], step: int = 256) -> np.ndarray:
    """Smallest index of each row's component, for ``n`` rows of one task.

    ``near(rows, others)`` gives the boolean matrix of links. Each row is compared with
    the rows not reached yet, ``step`` rows at a time, so no n x n matrix is kept.
    """
    root = np.arange(n)
    unseen = np.ones(n, dtype=bool)
    for i in range(n):
        if not unseen[i]:
            continue
        unseen[i] = False
        frontier = np.array([i])
        while frontier.size:
            others = np.flatnonzero(unseen)
            if not others.size:
                break
            hit = np.zeros(others.size, dtype=bool)
            for k in range(0, frontier.size, step):
                hit |= near(frontier[k:k + step], others).any(axis=0)
            frontier = others[hit]
            root[frontier] = i
            unseen[frontier] = False
    return root
