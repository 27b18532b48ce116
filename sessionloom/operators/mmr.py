"""Maximal marginal relevance: a diverse subset of each query's candidates.

Starting from one seed candidate, the candidate with the largest
``lam * sim(query, c) - (1 - lam) * max sim(c, chosen)`` is added until
``top_k_mmr`` are chosen. All queries of an Arrow batch advance together.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import SCORE_DECIMALS
from sessionloom.functions import vectors as V
from sessionloom.operators.knn import QUERY_KEYS, unit_rows

SEEDS = ("least_similar", "most_similar")

# Cells of the padded (queries, candidates, width) block worked on at a time.
_BLOCK_CELLS = 1 << 22


def mmr(
    candidates: DataFrame,
    items: DataFrame,
    metric: str = "cosine_sim",
    lam: float = 0.5,
    seed: str = "least_similar",
) -> DataFrame:
    """The chosen candidates with ``rank`` = pick order.

    ``candidates`` needs ``top_k_mmr`` and, unless the metric is cosine, the
    query's vector as ``query_embedding``. A query with ``top_k_mmr <= 0`` is
    returned as it is. Greedy scores are compared on nine decimals, ties fall to
    the lower rank.
    """
    if seed not in SEEDS:
        raise ValueError(f"unknown MMR seed {seed!r}")
    rest = [c for c in candidates.columns if c not in QUERY_KEYS]
    # Popular items skew this join; adaptive execution splits their partitions.
    with_vectors = candidates.join(items.select("id", "embedding"), "id")
    if metric == "cosine_sim":
        similarity = F.col("score")
    else:
        similarity = F.round(V.cosine("query_embedding", "embedding"), SCORE_DECIMALS)
    # A query holds at most its top_k candidates, so the lists are short.
    row = F.struct("rank", *[c for c in rest if c != "rank"])
    lists = with_vectors.groupBy(*QUERY_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("rank", similarity.alias("sim"), "embedding", row.alias("row")))).alias("c"),
        F.first("top_k_mmr").alias("n_wanted"),
    )
    packed = lists.select(
        *QUERY_KEYS,
        "n_wanted",
        F.col("c.sim").alias("sims"),
        F.flatten("c.embedding").alias("flat"),
        F.col("c.row").alias("rows"),
    )
    kept = [*QUERY_KEYS, "rows"]
    schema = T.StructType(
        [packed.schema[k] for k in kept] + [T.StructField("picks", T.ArrayType(T.IntegerType()))]
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [*[batch[k] for k in kept], picked(batch, lam, seed)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    chosen = packed.mapInArrow(choose, schema).select(*QUERY_KEYS, "rows", F.posexplode("picks").alias("n", "at"))
    taken = chosen.select(*QUERY_KEYS, (F.col("n") + 1).alias("n"), F.get("rows", "at").alias("row"))
    fields = [F.col("n").alias("rank") if c == "rank" else F.col(f"row.{c}").alias(c) for c in rest]
    return taken.select(*QUERY_KEYS, *fields)


def picked(batch: pa.RecordBatch, lam: float, seed: str) -> pa.ListArray:
    """Positions picked for each query of a batch, worked out in bounded blocks."""
    sizes = np.asarray(batch["sims"].value_lengths())
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    sims = batch["sims"].flatten().to_numpy()
    flat = batch["flat"].flatten().to_numpy()
    width = len(flat) // max(bounds[-1], 1)
    vectors = unit_rows(flat.reshape(-1, width).astype(np.float64))
    wanted = batch["n_wanted"].to_numpy()
    keep_all = wanted <= 0
    goal = np.where(keep_all, sizes, np.minimum(wanted, sizes))
    step = max(1, _BLOCK_CELLS // max(int(sizes.max()) * width, 1))
    pieces = []
    for a in range(0, len(sizes), step):
        b = min(a + step, len(sizes))
        lo, hi = bounds[a], bounds[b]
        row = np.repeat(np.arange(b - a), sizes[a:b])
        col = np.arange(hi - lo) - np.repeat(bounds[a:b] - lo, sizes[a:b])
        shape = (b - a, int(sizes[a:b].max()))
        block, sim = np.zeros((*shape, width)), np.full(shape, -np.inf)
        block[row, col] = vectors[lo:hi]
        sim[row, col] = sims[lo:hi]
        picks = greedy_picks(block, sim, goal[a:b], lam, seed)
        picks[keep_all[a:b]] = np.arange(picks.shape[1])
        pieces.append(picks[np.arange(picks.shape[1])[None, :] < goal[a:b, None]])
    offsets = np.concatenate([[0], np.cumsum(goal)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(pieces), pa.int32()))


def greedy_picks(block: np.ndarray, sim: np.ndarray, goal: np.ndarray, lam: float, seed: str) -> np.ndarray:
    """Positions picked per query, shape (queries, max goal)."""
    every = np.arange(len(block))
    real = np.isfinite(sim)
    if seed == "least_similar":
        pick = np.where(real, sim, np.inf).argmin(axis=1)
    else:
        pick = sim.argmax(axis=1)
    picks = np.zeros((len(block), int(goal.max())), dtype=np.int64)
    free = real.copy()
    redundancy = np.full(sim.shape, -np.inf)
    for n in range(picks.shape[1]):
        if n:
            with np.errstate(invalid="ignore"):
                worth = np.round(lam * sim - (1 - lam) * redundancy, SCORE_DECIMALS)
            pick = np.where(free, worth, -np.inf).argmax(axis=1)
        picks[:, n] = pick
        free[every, pick] = False
        to_pick = np.einsum("qnd,qd->qn", block, block[every, pick])
        redundancy = np.maximum(redundancy, np.round(to_pick, SCORE_DECIMALS))
    return picks


