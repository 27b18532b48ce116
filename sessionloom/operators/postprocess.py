"""What happens to candidates between the search and the served batch.

``candidates(session_id, q_idx, rank, id, score, ...)``; a query's parameters
travel as columns: ``top_k``, ``threshold`` (NULL = off), ``remove_duplicates``.
Groups are a query's top-k or a session's candidates, both bounded by the batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.config import SCORE_DECIMALS
from sessionloom.operators.knn import QUERY_KEYS, best_first
from sessionloom.operators.mmr import mmr


def apply_threshold(candidates: DataFrame, metric: str = "cosine_sim", threshold: Column | None = None) -> DataFrame:
    """Drop weak candidates; the limit is relaxed to the query's mean score.

    Scores are compared on nine decimals. The best score is part of the limit
    too, so that a query is never emptied by the rounding of a mean.
    """
    t = F.col("threshold") if threshold is None else threshold
    query = Window.partitionBy(*QUERY_KEYS)
    mean = F.round(F.avg("score").over(query), SCORE_DECIMALS)
    if metric == "euclidean_dist":
        passes = F.col("score") <= F.greatest(t, mean, F.min("score").over(query))
    else:
        passes = F.col("score") >= F.least(t, mean, F.max("score").over(query))
    return candidates.withColumn("_pass", t.isNull() | passes).where("_pass").drop("_pass")


def remove_ids(candidates: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop listed ids: ``ids(id)`` or, per session, ``ids(session_id, id)``."""
    keys = [c for c in ("session_id", "id") if c in ids.columns]
    return candidates.join(ids.select(*keys), keys, "left_anti")


def non_unique_ids(candidates: DataFrame) -> DataFrame:
    """Ids that occur more than once."""
    counts = candidates.groupBy("id").agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.where(F.col("occurrences") > 1)


def remove_duplicates(candidates: DataFrame) -> DataFrame:
    """Keep an id's first occurrence in a session: lowest query, then rank."""
    first = Window.partitionBy("session_id", "id").orderBy("q_idx", "rank")
    kept = candidates.withColumn("_n", F.row_number().over(first))
    wanted = F.col("_n") == 1
    if "remove_duplicates" in candidates.columns:
        wanted = wanted | ~F.col("remove_duplicates")
    return kept.where(wanted).drop("_n")


def rank_candidates(candidates: DataFrame, metric: str = "cosine_sim") -> DataFrame:
    """Number each query's candidates by score, best first, stable on ties."""
    order = Window.partitionBy(*QUERY_KEYS).orderBy(best_first(metric), F.asc("rank"))
    return candidates.withColumn("rank", F.row_number().over(order))


def truncate_per_query(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rank") <= F.col("top_k"))


def shuffle_pool(candidates: DataFrame, seed: int = 0) -> DataFrame:
    """A reproducible random order of each session's pool: column ``position``."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("session_id").cast("string"), F.col("id").cast("string")))
    order = Window.partitionBy("session_id").orderBy(draw, "q_idx")
    return candidates.withColumn("position", F.row_number().over(order))


def take_batch(shuffled: DataFrame, batch_size: int | Column) -> DataFrame:
    return shuffled.where(F.col("position") <= batch_size)


def concat_results(*results: DataFrame) -> DataFrame:
    """One result after the other; query numbers go on where the previous ended."""

    def append(left: DataFrame, right: DataFrame) -> DataFrame:
        ends = left.groupBy("session_id").agg((F.max("q_idx") + 1).alias("_base"))
        shifted = right.join(ends, "session_id", "left").withColumn(
            "q_idx", (F.col("q_idx") + F.coalesce("_base", F.lit(0))).cast("int")
        )
        return left.unionByName(shifted.drop("_base"))

    return reduce(append, results)


def flatten_results(candidates: DataFrame) -> DataFrame:
    """A session's results as one list, in query order."""
    order = Window.partitionBy("session_id").orderBy("q_idx", "rank")
    return candidates.withColumn("position", F.row_number().over(order))


def concat_queries(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join two query batches; a session's batch sizes have to agree."""
    sizes = left.select("session_id", "batch_size").union(right.select("session_id", "batch_size"))
    uneven = sizes.groupBy("session_id").agg(F.min("batch_size").alias("a"), F.max("batch_size").alias("b"))
    if not uneven.where("a <> b").isEmpty():
        raise ValueError("the batch sizes of the two query batches differ")
    return concat_results(left, right)


def apply_params(
    candidates: DataFrame,
    items: DataFrame,
    metric: str = "cosine_sim",
    seed: int = 0,
    mmr_seed: str = "least_similar",
    shuffle: bool = True,
) -> DataFrame:
    """The whole chain: threshold, MMR, dedup, sort, cut per query, shuffle."""
    # A session's candidates are few; together in one partition, they need no
    # further shuffle for the windows by query, by id and by session.
    kept = apply_threshold(candidates.repartition("session_id"), metric)
    plain = kept.where(~F.col("apply_mmr"))
    diverse = mmr(kept.where("apply_mmr"), items, metric=metric, seed=mmr_seed)
    unique = remove_duplicates(plain.unionByName(diverse).repartition("session_id"))
    ranked = truncate_per_query(rank_candidates(unique, metric))
    return shuffle_pool(ranked, seed) if shuffle else flatten_results(ranked)
