"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import stage


def _flat(parents: DataFrame) -> DataFrame:
    """Every id with its root, by pointer doubling; a root has no row of its own."""
    while True:
        above = parents.select(F.col("id").alias("up"), F.col("to").alias("top"))
        jumped = stage(
            parents.join(above, F.col("to") == F.col("up"), "left").select(
                "id", F.coalesce("top", "to").alias("to"), F.col("top").isNotNull().alias("moved")
            )
        )
        parents = jumped.select("id", "to")
        if jumped.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that is linked with a smaller one, directly or not.

    ``links`` has columns ``a`` and ``b``; the component is its smallest id. Ids
    without a row are their component's smallest, or have no link. Each round hangs
    every id under its smallest neighbour, flattens the trees and goes on with the
    links between their roots, at most half as many.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    labels = None
    while not edges.isEmpty():
        roots = _flat(edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("to")))
        if labels is None:
            labels = roots
        else:
            above = roots.select(F.col("id").alias("up"), F.col("to").alias("top"))
            moved = labels.join(above, F.col("to") == F.col("up"), "left").select("id", F.coalesce("top", "to").alias("to"))
            labels = stage(moved.unionByName(roots.join(labels.select("id"), "id", "left_anti")))
        hi, lo = (roots.select(F.col("id").alias(k), F.col("to").alias(f"{k}_root")) for k in ("hi", "lo"))
        ends = edges.join(hi, "hi", "left").join(lo, "lo", "left").select(F.coalesce("hi_root", "hi").alias("a"), F.coalesce("lo_root", "lo").alias("b"))
        edges = stage(ends.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    if labels is None:
        return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return labels.withColumnRenamed("to", "component")


def forest(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id with the smallest id it reaches inside a block of links (i, j)."""
    order = np.argsort(j, kind="stable")
    rows, row_start = np.unique(i, return_index=True)
    cols, col_start = np.unique(j[order], return_index=True)
    low, high = left.copy(), right.copy()
    while True:
        new_low = low.copy()
        new_low[rows] = np.minimum(low[rows], np.minimum.reduceat(high[j], row_start))
        new_high = high.copy()
        new_high[cols] = np.minimum(high[cols], np.minimum.reduceat(new_low[i[order]], col_start))
        if (new_low == low).all() and (new_high == high).all():
            return np.concatenate([left[rows], right[cols]]), np.concatenate([low[rows], high[cols]])
        low, high = new_low, new_high
