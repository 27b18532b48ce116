"""Sessions: who is served by which blueprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.sources.blueprints import SIMPLE_BLUEPRINT, START_STATE
from sessionloom.sources.signals import BATCH

SIMPLE, CUSTOM, FACTORY = "SIMPLE", "CUSTOM", "FACTORY"


def create_sessions(requests: DataFrame, collection: str) -> DataFrame:
    """One record per session from requests ``(session_id, label[, custom_id, named])``.

    SIMPLE and CUSTOM keep their label, every other label names a built-in
    blueprint. A session is persistent where the caller chose its id (``named``,
    by default true). For repeated requests one record is made, of the smallest
    label.
    """
    custom = F.col("custom_id") if "custom_id" in requests.columns else F.lit(None).cast("string")
    named = F.col("named") if "named" in requests.columns else F.lit(True)
    asked = requests.select("session_id", "label", custom.alias("custom_id"), named.alias("named"))
    one = asked.groupBy("session_id").agg(F.min(F.struct("label", "custom_id", "named")).alias("r"))
    label = F.col("r.label")
    return one.select(
        "session_id",
        F.when(label.isin(SIMPLE, CUSTOM), label).otherwise(FACTORY).alias("algorithm"),
        F.when(~label.isin(SIMPLE, CUSTOM), label).alias("factory_id"),
        F.when(label == CUSTOM, F.col("r.custom_id")).alias("custom_id"),
        F.lit(collection).alias("collection"),
        F.lit(START_STATE).alias("state"),
        F.lit(False).alias("has_embeddings"),
        F.col("r.named").alias("is_persistent"),
    )


def route_algorithm(sessions: DataFrame) -> DataFrame:
    """Add the ``blueprint`` of each session; NULL marks a CUSTOM session without id."""
    algorithm = F.col("algorithm")
    blueprint = (
        F.when(algorithm == SIMPLE, F.lit(SIMPLE_BLUEPRINT))
        .when(algorithm == FACTORY, F.col("factory_id"))
        .when(algorithm == CUSTOM, F.col("custom_id"))
    )
    return sessions.withColumn("blueprint", blueprint)


def temporary_sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions of callers without a session id: activity without a longer pause.

    ``events(user_id, ts)`` to ``(user_id, session_no, started, ended, n_events)``.
    Events of one user in one span of the gap's length belong together, so they
    are reduced to a row before anything is ordered per user.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = F.floor(micros / F.lit(gap_seconds * 1_000_000))
    spans = events.groupBy("user_id", span.alias("span")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n")
    )
    by_time = Window.partitionBy("user_id").orderBy("span")
    pause = F.unix_micros(F.col("first_ts").cast("timestamp")) - F.unix_micros(
        F.lag("last_ts").over(by_time).cast("timestamp")
    )
    opens = F.when(pause.isNull() | (pause > gap_seconds * 1_000_000), 1).otherwise(0)
    numbered = spans.withColumn("_opens", opens).withColumn("session_no", F.sum("_opens").over(by_time))
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("first_ts").alias("started"), F.max("last_ts").alias("ended"), F.sum("n").alias("n_events")
    )


def update_states(sessions: DataFrame, trace: DataFrame) -> DataFrame:
    """Session records after the actions of ``trace(session_id, ts, seq, action, next_state)``."""
    latest = trace.groupBy("session_id").agg(
        F.max_by("next_state", F.struct("ts", "seq")).alias("_next"),
        F.max(F.col("action") != BATCH).alias("_signalled"),
    )
    joined = sessions.join(latest, "session_id", "left")
    return joined.withColumns(
        {
            "state": F.coalesce("_next", "state"),
            "has_embeddings": F.col("has_embeddings") | F.coalesce("_signalled", F.lit(False)),
        }
    ).drop("_next", "_signalled")
