"""Fold every session's actions through its blueprint.

An action is a function from node to node, and functions compose associatively.
So the log is range-partitioned by (session, time) - a session of any size is
spread over as many partitions as it fills - each partition composes what it
holds, and only sessions that cross a partition border exchange one function per
partition before all partitions replay their rows.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import broadcast_if_small, local_table, stage
from sessionloom.operators.skew import balanced_join, salted_join
from sessionloom.sources.blueprints import START_STATE, step_maps
from sessionloom.sources.signals import BATCH, DEFAULT

ORDER = ["session_id", "ts", "seq"]


def session_state_trace(actions: DataFrame, sessions: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """State before and after each action.

    ``actions(session_id, ts, seq, action)``, ``sessions(session_id, blueprint,
    state)``. Returns the actions with ``state``, ``next_state`` and the batch
    type and parameters of the node the action left. Sessions without a known
    blueprint or state have no trace; ``split_actions`` tells their actions apart.
    """
    nodes = broadcast_if_small(nodes)
    resolved, table = resolve_steps(actions, sessions, nodes, edges)
    ordered = stage(
        resolved.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id())
    )
    traced = replay(ordered, incoming_states(ordered, table), table)
    spec = nodes.select("blueprint", "node_ord", "name", "batch_type", "params")
    left = spec.withColumnsRenamed({"node_ord": "state_ord", "name": "state"})
    reached = spec.select("blueprint", F.col("node_ord").alias("next_ord"), F.col("name").alias("next_state"))
    return (
        traced.join(left, ["blueprint", "state_ord"])
        .join(reached, ["blueprint", "next_ord"])
        .drop("state_ord", "next_ord")
    )


def resolve_steps(
    actions: DataFrame, sessions: DataFrame, nodes: DataFrame, edges: DataFrame, keep: list[str] | None = None
) -> tuple[DataFrame, np.ndarray | None]:
    """Attach each action's ``step`` and the session's first state.

    Where the blueprints are few, ``step`` is a row number of the returned table
    of step functions, so that long logs carry a number; else it is the function.
    """
    maps = step_maps(nodes, edges)
    steps, table = broadcast_if_small(maps), None
    if steps is not maps:
        rows = steps.collect()
        table = step_matrix(pa.array([r["step"] for r in rows], pa.list_(pa.int32())))
        numbered = [(r["blueprint"], r["action"], i) for i, r in enumerate(rows)]
        steps = F.broadcast(local_table(nodes.sparkSession, numbered, "blueprint string, action string, step int"))
    else:
        # Joined twice, and its keys are counted.
        steps = stage(maps)
    own = steps.select("blueprint", "action", F.col("step").alias("_own"))
    default = steps.where(F.col("action") == DEFAULT).select("blueprint", F.col("step").alias("_default"))
    ordinals = nodes.select("blueprint", F.col("name").alias("state"), F.col("node_ord").alias("first_state"))
    states = sessions.select("session_id", "blueprint", "state").join(ordinals, ["blueprint", "state"], "left")
    states = states.where(F.col("first_state").isNotNull() | (F.col("state") == START_STATE))
    # An unknown blueprint has no steps.
    states = states.join(nodes.select("blueprint").distinct(), "blueprint", "left_semi")
    states = states.select("session_id", "blueprint", F.coalesce("first_state", F.lit(0)).alias("first_state"))
    wanted = actions.select(*ORDER, F.upper("action").alias("action"), *(keep or []))
    if actions.isStreaming:
        placed = wanted.join(states, "session_id")
    else:
        placed = balanced_join(wanted, states, "session_id", ["ts", "seq"])
    if table is None and not actions.isStreaming:
        found = salted_join(placed, own, ["blueprint", "action"], ["session_id", "seq"], "left")
        found = salted_join(found, default, "blueprint", ["session_id", "seq"], "left")
    else:
        found = placed.join(own, ["blueprint", "action"], "left").join(default, "blueprint", "left")
    return found.withColumn("step", F.coalesce("_own", "_default")).drop("_own", "_default"), table


def incoming_states(ordered: DataFrame, table: np.ndarray | None) -> dict[int, int]:
    """For partitions that begin inside a session: the state it arrives in.

    What reaches the driver is two session ids per partition and, for sessions
    that cross a border, one short function per partition.
    """
    ends = ordered.groupBy("part").agg(F.min("session_id").alias("lo"), F.max("session_id").alias("hi")).collect()
    ends.sort(key=lambda r: r["part"])
    crossing = {b["lo"] for a, b in zip(ends, ends[1:]) if a["hi"] == b["lo"]}
    if not crossing:
        return {}
    key = ordered.schema["session_id"].dataType
    crossing_rows = local_table(ordered.sparkSession, [(s,) for s in crossing], T.StructType([T.StructField("session_id", key)]))
    rows = ordered.join(F.broadcast(crossing_rows), "session_id", "left_semi")
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("session_id", key),
            T.StructField("first_state", T.IntegerType()),
            T.StructField("step", T.ArrayType(T.IntegerType())),
        ]
    )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from compose_partition(batches, table, schema.names)

    pieces = rows.mapInArrow(compose, schema).collect()
    arriving, state, session = {}, 0, None
    for p in sorted(pieces, key=lambda r: (r["session_id"], r["part"])):
        if p["session_id"] == session:
            arriving[p["part"]] = state
        else:
            session, state = p["session_id"], p["first_state"]
        state = p["step"][state]
    return arriving


def compose_partition(
    batches: Iterator[pa.RecordBatch], table: np.ndarray | None, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """One row per session of the partition: the composition of its steps."""
    held: tuple | None = None  # (part, session, first state, composed step)
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = segment_starts(batch["session_id"])
        composed = prefix_compose(steps_of(batch["step"], table), starts)
        lasts = np.append(starts[1:], len(composed)) - 1
        for start, last in zip(starts, lasts):
            row = (
                batch["part"][start].as_py(),
                batch["session_id"][start].as_py(),
                batch["first_state"][start].as_py(),
                composed[last],
            )
            if held and held[1] == row[1]:
                held = (*held[:3], row[3][held[3]])
            else:
                if held:
                    yield _piece(held, batch, names)
                held = row
            types = batch
    if held:
        yield _piece(held, types, names)


def _piece(held: tuple, batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    part, session, first, step = held
    columns = [
        pa.array([part], pa.int32()),
        pa.array([session], batch["session_id"].type),
        pa.array([first], pa.int32()),
        pa.array([step.tolist()], pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def replay(ordered: DataFrame, arriving: dict[int, int], table: np.ndarray | None) -> DataFrame:
    """State ordinals before and after every row."""
    kept = [f for f in ordered.schema if f.name not in ("step", "part", "first_state")]
    schema = T.StructType(
        kept + [T.StructField("state_ord", T.IntegerType()), T.StructField("next_ord", T.IntegerType())]
    )
    carried = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from replay_partition(batches, arriving, table, carried)

    return ordered.mapInArrow(run, schema)


def replay_partition(
    batches: Iterator[pa.RecordBatch], arriving: dict[int, int], table: np.ndarray | None, carried: list[str]
) -> Iterator[pa.RecordBatch]:
    session, state, fresh = None, None, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        starts = segment_starts(batch["session_id"])
        sizes = np.diff(np.append(starts, n))
        entry = batch["first_state"].to_numpy()[starts].copy()
        if fresh:
            entry[0] = arriving.get(batch["part"][0].as_py(), entry[0])
        elif batch["session_id"][0].as_py() == session:
            entry[0] = state
        fresh = False
        composed = prefix_compose(steps_of(batch["step"], table), starts)
        after = composed[np.arange(n), np.repeat(entry, sizes)]
        before = np.roll(after, 1)
        before[starts] = entry
        session, state = batch["session_id"][n - 1].as_py(), after[-1]
        columns = [batch[c] for c in carried] + [pa.array(before, pa.int32()), pa.array(after, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=[*carried, "state_ord", "next_ord"])


def segment_starts(sessions: pa.Array) -> np.ndarray:
    """Positions where a new session begins."""
    changes = pc.not_equal(sessions.slice(1), sessions.slice(0, len(sessions) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(changes) + 1])


def steps_of(column: pa.Array, table: np.ndarray | None) -> np.ndarray:
    """The step function of each row."""
    return step_matrix(column) if table is None else table[column.to_numpy()]


def step_matrix(steps: pa.Array) -> np.ndarray:
    """Step functions as rows; shorter ones are filled up with 'stay'."""
    sizes = np.asarray(steps.value_lengths())
    out = np.tile(np.arange(int(sizes.max()), dtype=np.int32), (len(sizes), 1))
    row = np.repeat(np.arange(len(sizes)), sizes)
    col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, col] = steps.flatten().to_numpy()
    return out


def prefix_compose(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row i becomes the composition of its segment's rows up to i, in log n rounds."""
    n = len(steps)
    begin = np.repeat(starts, np.diff(np.append(starts, n)))
    at = np.arange(n)
    longest = int((at - begin).max()) if n else 0
    out, reach = steps, 1
    while reach <= longest:
        here = np.flatnonzero(at - reach >= begin)
        merged = out.copy()
        merged[here] = np.take_along_axis(out[here], out[here - reach], axis=1)
        out, reach = merged, reach * 2
    return out


def has_embeddings(actions: DataFrame) -> DataFrame:
    """Mark each action by whether its session had given a signal before it."""
    order = F.struct("ts", "seq")
    first = actions.where(F.col("action") != BATCH).groupBy("session_id").agg(F.min(order).alias("_first"))
    # A session with a large share of the log must not meet its row in one task.
    joined = salted_join(actions, first, "session_id", ["ts", "seq"], "left")
    return joined.withColumn("has_embeddings", F.coalesce(order > F.col("_first"), F.lit(False))).drop("_first")
