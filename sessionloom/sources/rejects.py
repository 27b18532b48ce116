"""Actions that cannot be carried out, each with the first reason that applies.

Rejected rows must neither move a state nor enter a profile; accepted and rejected
rows together are the input. An action for which a node has no edge is accepted: the
session stays where it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import broadcast_if_small
from sessionloom.operators.skew import balanced_join
from sessionloom.sources.blueprints import START_STATE

UNKNOWN_ACTION = "unknown action"
UNKNOWN_SESSION = "unknown session"
NO_BLUEPRINT = "no blueprint"
UNKNOWN_STATE = "unknown state"
UNKNOWN_ITEM = "unknown item"
LATE = "late"
REPEATED = "repeated"
NO_BIAS = "no bias"


def session_problems(sessions: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(session_id, problem)``; the problem is NULL where the session can go on."""
    known = broadcast_if_small(nodes.select("blueprint", F.lit(True).alias("_known")).distinct())
    places = broadcast_if_small(nodes.select("blueprint", F.col("name").alias("state"), F.lit(True).alias("_there")).distinct())
    found = sessions.select("session_id", "blueprint", "state").join(known, "blueprint", "left").join(places, ["blueprint", "state"], "left")
    there = F.coalesce(F.col("state") == START_STATE, F.lit(False)) | F.col("_there").isNotNull()
    problem = F.when(F.col("_known").isNull(), NO_BLUEPRINT).when(~there, UNKNOWN_STATE)
    return found.select("session_id", problem.alias("problem"))


def checked_actions(actions: DataFrame, sessions: DataFrame, nodes: DataFrame, items: DataFrame) -> DataFrame:
    """``actions`` with the ``reason`` they cannot be carried out for, or NULL.

    ``actions`` are parsed ones (``known``, ``is_batch``, ``item_id``). On a stream the
    tables are joined as they are; elsewhere sessions and items that hold a large share of
    the actions are spread, unless there are few of them.
    """
    of_session = session_problems(sessions, nodes).withColumn("_session", F.lit(True))
    of_item = items.select(F.col("id").alias("item_id"), F.lit(True).alias("_item"))
    if actions.isStreaming:
        checked = actions.join(of_session, "session_id", "left").join(of_item, "item_id", "left")
    else:
        checked = balanced_join(actions, of_session, "session_id", ["seq"], "left")
        checked = balanced_join(checked, of_item, "item_id", ["session_id", "seq"], "left")
    reason = (
        F.when(~F.coalesce("known", F.lit(False)), UNKNOWN_ACTION)
        .when(F.col("_session").isNull(), UNKNOWN_SESSION)
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(~F.col("is_batch") & F.col("_item").isNull(), UNKNOWN_ITEM)
    )
    return checked.withColumn("reason", reason).select(*actions.columns, "reason")


def split_actions(
    actions: DataFrame, sessions: DataFrame, nodes: DataFrame, items: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Accepted actions and ``rejects(session_id, seq, reason)``."""
    checked = checked_actions(actions, sessions, nodes, items)
    accepted = checked.where("reason IS NULL").select(*actions.columns)
    return accepted, checked.where("reason IS NOT NULL").select("session_id", "seq", "reason")
