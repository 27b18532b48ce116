"""From query weights to the number of neighbours each query may fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.config import CONFIDENCE_INTERVAL_RATIO, MINIMUM_TOPK


def adjust_weights(queries: DataFrame, batch_size: int | Column, slack: float | None = None) -> DataFrame:
    """Adds ``budget``: integer weights that sum to about ``batch_size`` per request.

    The size is a number or a column with one value per session. Weights are lifted so that the smallest is at least 1, and scaled when their
    sum is off the batch size by more than ``slack``.
    """
    size = (batch_size if isinstance(batch_size, Column) else F.lit(batch_size)).cast("double")
    c = F.greatest(size * CONFIDENCE_INTERVAL_RATIO, F.lit(1.0)) if slack is None else F.lit(slack)
    request = Window.partitionBy("session_id")
    least = F.min("weight").over(request)
    lifted = F.when(least < 1, F.col("weight") + (1 - least)).otherwise(F.col("weight"))
    with_sum = queries.withColumn("_w", lifted).withColumn("_sum", F.sum("_w").over(request))
    factor = size / F.col("_sum")
    fits = F.col("_sum").between(size - c, size + c)
    scaled = F.when(fits, F.floor("_w")).otherwise(F.ceil(F.col("_w") * factor))
    return with_sum.withColumn("budget", scaled.cast("int")).drop("_w", "_sum")


def set_top_k(queries: DataFrame, apply_mmr: Column) -> DataFrame:
    """Adds ``top_k`` and ``top_k_mmr``; MMR chooses from twice as many candidates."""
    k = F.greatest(F.col("budget"), F.lit(MINIMUM_TOPK))
    return queries.withColumn("top_k_mmr", F.when(apply_mmr, k).otherwise(1)).withColumn(
        "top_k", F.when(apply_mmr, 2 * k).otherwise(k)
    )
