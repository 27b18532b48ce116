"""Running sums per key that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.config import stage


def running_sums(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each name, the sum of its expression over the key's earlier rows.

    Rows are dealt by ranges of key and order, so that a key of any size fills as many
    partitions as it needs; what its earlier partitions hold is one row for each.
    ``order`` should tell all rows of a key apart.
    """
    values = {f"_{name}": expr for name, expr in sums.items()}
    # Written down, so that the partitions stay what they are.
    dealt = stage(rows.withColumns(values).repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0)
    parts = dealt.groupBy(*keys, "_part").agg(*(F.sum(v).alias(v) for v in values))
    offsets = parts.select(*keys, "_part", *(F.coalesce(F.sum(v).over(earlier), nothing).alias(f"{v}_0") for v in values))
    summed = dealt.withColumns({name: F.coalesce(F.sum(f"_{name}").over(here), nothing) for name in sums})
    # A key's rows of one partition meet its one row for that partition.
    joined = summed.join(offsets, [*keys, "_part"])
    totals = {name: (F.col(name) + F.col(f"_{name}_0")).cast("long") for name in sums}
    return joined.withColumns(totals).drop("_part", *values, *(f"{v}_0" for v in values))
