"""Equi-join that stays balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import broadcast_if_small, default_parallelism


def hot_keys(df: DataFrame, keys: list[str], shares: int) -> DataFrame:
    """Keys holding more than ``1/shares`` of the rows: fewer than ``shares`` rows,
    each with the number of slices its rows are to be cut into."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_one", F.lit(1))
    # One row, attached by a constant key.
    total = counts.groupBy("_one").agg((F.sum("_n") / F.lit(shares)).alias("_per_slice"))
    hot = counts.join(F.broadcast(total), "_one").where(F.col("_n") > F.col("_per_slice"))
    return hot.select(*keys, F.ceil(F.col("_n") / F.col("_per_slice")).cast("int").alias("_slices"))


def salted_join(
    facts: DataFrame, dims: DataFrame, key: str | list[str], spread: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to ``dims`` on ``key``, one or more columns; hot keys of ``facts`` are cut into slices.

    ``spread`` names fact columns whose hash assigns a row to its slice. Rows of
    ``dims`` are repeated for hot keys only, once per slice; ``how`` is ``inner``
    or ``left``.
    """
    keys = [key] if isinstance(key, str) else key
    hot = F.broadcast(hot_keys(facts, keys, default_parallelism(facts.sparkSession)))
    slices = F.coalesce("_slices", F.lit(1))
    left = (
        facts.join(hot, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), slices).cast("int"))
        .drop("_slices")
    )
    right = (
        dims.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def balanced_join(
    facts: DataFrame, dims: DataFrame, key: str | list[str], spread: list[str], how: str = "inner"
) -> DataFrame:
    """As ``salted_join``; ``dims`` are broadcast where they are few, and no keys are counted."""
    small = broadcast_if_small(dims)
    if small is not dims:
        return facts.join(small, key, how)
    return salted_join(facts, dims, key, spread, how)
