"""History: what a session has been served or has signalled. Append-only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def history_of(rows: DataFrame, time_col: str | None = None) -> DataFrame:
    """``(session_id, history_value, served_ts)`` of served or signalled items."""
    served = F.col(time_col) if time_col else F.current_timestamp()
    return rows.select("session_id", "history_value", served.alias("served_ts"))


def append_history(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of history; writing the same batch again replaces it."""
    history_of(rows, "served_ts" if "served_ts" in rows.columns else None).write.mode("overwrite").parquet(
        f"{path}/batch_id={batch_id}"
    )


def read_history(spark: SparkSession, path: str, before_batch: int | None = None, enabled: bool = True) -> DataFrame:
    """All history of the table, or the snapshot before a batch; empty if disabled."""
    rows = spark.read.parquet(path)
    if before_batch is not None:
        rows = rows.where(F.col("batch_id") < before_batch)
    if not enabled:
        rows = rows.where(F.lit(False))
    return rows


def history_values(history: DataFrame) -> DataFrame:
    """Each session's distinct values: what a search has to leave out."""
    return history.select("session_id", "history_value").distinct()


def history_filter(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates ``(session_id, history_value, ...)`` not in their session's history.

    For candidates already at hand; a search takes the history as ``exclude``.
    """
    return candidates.join(history_values(history), ["session_id", "history_value"], "left_anti")
