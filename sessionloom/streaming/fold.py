"""The states of all sessions of a stream, without answers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sessionloom.streaming.events import run_available
from sessionloom.streaming.serving import Fold, Tables


def signal_stream(
    actions: DataFrame, sessions: DataFrame, items: DataFrame, nodes: DataFrame, edges: DataFrame, path: str, **options
) -> Tables:
    """Fold what there is of a stream of ``actions(session_id, ts, seq, action, weight, item_id)``.

    Returns tables under ``path`` with ``steps`` (each action, the states before and after it and the
    size of the session's profile) and ``rejects`` (those that weren't carried out, and why).
    """
    types = {"session": _type(actions, "session_id"), "item": _type(actions, "item_id")}
    tables = Tables(path, **types).create(actions.sparkSession)
    run_available(actions, Fold(tables, sessions, items, nodes, edges, **options), "fold")
    return tables


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
