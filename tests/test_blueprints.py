import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.operators import states
from sessionloom.operators.states import prefix_compose
from sessionloom.sources import blueprints as B
from sessionloom.sources import sessions, signals

TWO_NODES = {
    "signals": [{"label": "new_signal", "weight": 1.5}],
    "nodes": [
        {"name": "A", "batch_type": "random", "params": {"apply_threshold": [True, 0.4], "apply_mmr": 1}},
        {"name": "B", "batch_type": "personalized", "params": {"apply_threshold": [False, 0.4], "last_n": 3}},
    ],
    "edges": [
        {"name": "1", "edge_type": "NEW_SIGNAL", "start": "A", "end": "A"},
        {"name": "2", "edge_type": "DEFAULT", "start": "A", "end": "B"},
        {"name": "3", "edge_type": "BATCH", "start": "A", "end": "B"},
        {"name": "4", "edge_type": "BATCH", "start": "A", "end": "A"},
        {"name": "5", "edge_type": "DEFAULT", "start": "B", "end": "B"},
        {"name": "6", "edge_type": "BATCH", "start": "B", "end": "A"},
    ],
}


def load(spark, **docs):
    rows = [(k, json.dumps(v)) for k, v in docs.items()]
    return B.load_blueprints(local_table(spark, rows, "blueprint string, doc string"))


def problems(spark, doc):
    nodes, edges, added = load(spark, bp=doc)
    found = B.validate_blueprints(nodes, edges, signals.vocabulary(spark), added)
    return {(r["subject"], r["problem"]) for r in found.collect()}


def test_builtins_are_valid(spark):
    nodes, edges, added = B.load_blueprints(B.builtin_documents(spark))
    assert B.validate_blueprints(nodes, edges, signals.vocabulary(spark), added).isEmpty()
    sizes = {r["blueprint"]: r["count"] for r in nodes.groupBy("blueprint").count().collect()}
    assert sizes["NAVIGABLE_UX"] == 6 and sizes["USER_INTENT_AI_AGENTS"] == 4


def test_parameters(spark):
    nodes, _, added = load(spark, bp=TWO_NODES)
    a, b = (r["params"] for r in nodes.orderBy("node_ord").collect())
    assert (a["threshold"], a["apply_mmr"], a["last_n"], a["remove_duplicates"]) == (0.4, True, 0, True)
    assert (b["threshold"], b["apply_mmr"], b["last_n"]) == (None, False, 3)
    assert [tuple(r) for r in added.select("label", "weight").collect()] == [("new_signal", 1.5)]


def test_validation(spark):
    assert problems(spark, TWO_NODES) == set()
    broken = json.loads(json.dumps(TWO_NODES))
    broken["nodes"][1]["batch_type"] = "odd"
    broken["nodes"][1]["params"]["gamma"] = 1
    broken["edges"] = [e for e in broken["edges"] if e["name"] not in ("5", "6")]
    broken["edges"].append({"name": "7", "edge_type": "NO_SUCH", "start": "A", "end": "Nowhere"})
    assert problems(spark, broken) == {
        ("B", "no BATCH edge"),
        ("B", "signals not covered"),
        ("B", "unknown batch type"),
        ("B", "unknown parameter"),
        ("Nowhere", "edge end is not a node"),
        ("NO_SUCH", "unknown action"),
    }


def test_covering_every_signal_replaces_the_default_edge(spark):
    doc = json.loads(json.dumps(TWO_NODES))
    doc["edges"] = [e for e in doc["edges"] if e["name"] != "5"]
    labels = [label for label, _ in signals.SIGNALS if label != "DEFAULT"]
    doc["edges"] += [{"name": "x", "edge_type": x, "start": "B", "end": "A"} for x in labels]
    assert problems(spark, doc) == {("B", "signals not covered")}
    doc["edges"] += [{"name": "x", "edge_type": x, "start": "B", "end": "A"} for x in ("DEFAULT", "NEW_SIGNAL")]
    assert problems(spark, doc) == set()


def step(spark, state, action):
    nodes, edges, _ = load(spark, bp=TWO_NODES)
    asked = local_table(spark, [("bp", state, action)], "blueprint string, state string, action string")
    r = B.transition_lookup(asked, nodes, edges).first()
    return r["next_state"], r["batch_type"]


def test_transitions(spark):
    # The first state, an edge of its own, the default edge, the first of two edges.
    assert step(spark, "0", "NEW_SIGNAL") == ("A", "random")
    assert step(spark, "A", "LIKE") == ("B", "random")
    assert step(spark, "A", "BATCH") == ("B", "random")
    assert step(spark, "B", "BATCH") == ("A", "personalized")


def test_without_an_edge_a_session_stays(spark):
    nodes, edges, _ = load(spark, bp=TWO_NODES)
    asked = local_table(
        spark,
        [("bp", "B", "BATCH"), ("bp", "B", "LIKE"), ("bp", "0", "BATCH"), ("bp", "C", "BATCH"), ("none", "B", "BATCH")],
        "blueprint string, state string, action string",
    )
    found = B.transition_lookup(asked, nodes, edges.where("start = 'nowhere'"))
    got = {(r.blueprint, r.state, r.action): r.next_state for r in found.collect()}
    assert got == {
        ("bp", "B", "BATCH"): "B",
        ("bp", "B", "LIKE"): "B",
        ("bp", "0", "BATCH"): "A",
        ("bp", "C", "BATCH"): None,
        ("none", "B", "BATCH"): None,
    }


def walk(doc, actions):
    """One action at a time."""
    state, out = doc["nodes"][0]["name"], []
    for action in actions:
        own = [e["end"] for e in doc["edges"] if e["start"] == state and e["edge_type"] == action]
        default = [e["end"] for e in doc["edges"] if e["start"] == state and e["edge_type"] == "DEFAULT"]
        to = (own or default)[0]
        out.append((state, to))
        state = to
    return out


def test_trace_of_sessions_that_span_partitions(spark):
    """One session holds most of the log."""
    rng = np.random.default_rng(0)
    docs = {"bp": TWO_NODES, "NAVIGABLE_UX": B.BLUEPRINTS["NAVIGABLE_UX"]}
    nodes, edges, _ = load(spark, **docs)
    lengths = {0: 3000, 1: 5, 2: 900, 3: 40}
    blueprint = {0: "NAVIGABLE_UX", 1: "bp", 2: "bp", 3: "NAVIGABLE_UX"}
    rows, expected = [], []
    for s, n in lengths.items():
        actions = rng.choice(["BATCH", "LIKE", "NEW_SIGNAL"], n, p=[0.7, 0.1, 0.2]).tolist()
        rows += [(s, t, t, a) for t, a in enumerate(actions)]
        expected += [(s, t, *x) for t, x in enumerate(walk(docs[blueprint[s]], actions))]
    log = local_table(spark, [rows[i] for i in rng.permutation(len(rows))], "session_id long, ts long, seq long, action string")
    who = local_table(spark, [(s, b, "0") for s, b in blueprint.items()], "session_id long, blueprint string, state string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        trace = states.session_state_trace(log, who, nodes, edges).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r["session_id"], r["seq"], r["state"], r["next_state"]) for r in trace) == sorted(expected)


def test_trace_with_many_blueprints(spark, monkeypatch):
    """Where blueprints are too many to be broadcast, rows carry their step functions."""
    from sessionloom import config

    nodes, edges, _ = load(spark, **{f"bp{i}": TWO_NODES for i in range(30)})
    monkeypatch.setattr(config.broadcast_if_small, "__defaults__", (10,))
    rng = np.random.default_rng(4)
    rows, expected = [], []
    for s in range(60):
        actions = rng.choice(["BATCH", "LIKE", "NEW_SIGNAL"], 20).tolist()
        rows += [(s, t, t, a) for t, a in enumerate(actions)]
        expected += [(s, t, *x) for t, x in enumerate(walk(TWO_NODES, actions))]
    log = local_table(spark, rows, "session_id long, ts long, seq long, action string")
    # A third of the sessions shares one blueprint.
    names = [(s, f"bp{0 if s % 3 == 0 else s % 30}", "0") for s in range(60)]
    who = local_table(spark, names, "session_id long, blueprint string, state string")
    trace = states.session_state_trace(log, who, nodes, edges).collect()
    assert sorted((r["session_id"], r["seq"], r["state"], r["next_state"]) for r in trace) == sorted(expected)


def test_trace_starts_in_the_stored_state(spark):
    nodes, edges, _ = load(spark, bp=TWO_NODES)
    log = local_table(spark, [(1, 1, 1, "BATCH")], "session_id long, ts long, seq long, action string")
    who = local_table(spark, [(1, "bp", "B")], "session_id long, blueprint string, state string")
    r = states.session_state_trace(log, who, nodes, edges).first()
    assert (r["state"], r["next_state"], r["batch_type"]) == ("B", "A", "personalized")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.tuples(*[st.integers(0, 3)] * 4)), min_size=1, max_size=40))
def test_prefix_compose(rows):
    steps = np.array([s for _, s in rows])
    starts = np.array([i for i, (new, _) in enumerate(rows) if new or i == 0])
    got = prefix_compose(steps, starts)
    for first in range(4):
        state = first
        for i, s in enumerate(steps):
            state = s[first if i in starts else state]
            assert got[i, first] == state


def test_signals_last_definition_wins(spark, tmp_path):
    added = [{"label": "like", "weight": 3}, {"label": "Fresh", "weight": 2}, {"label": "LIKE", "weight": 5}]
    path = tmp_path / "signals.json"
    path.write_text(json.dumps(added))
    vocabulary = signals.vocabulary(spark)
    for source in (
        signals.definitions_from_list(spark, added),
        signals.definitions_from_file(spark, str(path)),
    ):
        found = {r["label"]: r["weight"] for r in signals.load_signals(vocabulary, source).collect()}
        assert found["LIKE"] == 5 and found["FRESH"] == 2 and len(found) == len(signals.SIGNALS) + 1
    scoped = signals.definitions_from_list(spark, added).withColumn("blueprint", F.lit("bp"))
    assert signals.load_signals(vocabulary, scoped, ["blueprint"]).count() == 2


def test_actions(spark):
    rows = local_table(spark, [("like",), ("BATCH",), ("nothing",)], "action string")
    parsed = signals.parse_actions(rows, signals.vocabulary(spark))
    assert {(r["action"], r["weight"], r["known"]) for r in parsed.collect()} == {
        ("LIKE", 8.0, True), ("BATCH", None, True), ("NOTHING", None, False)
    }
    good, bad = signals.signal_guard(parsed)
    assert [r["action"] for r in good.collect()] == ["LIKE"] and bad.count() == 2


def test_routing(spark):
    asked = local_table(
        spark,
        [(1, "SIMPLE", None), (2, "CUSTOM", "mine"), (3, "NAVIGABLE_UX", None), (4, "CUSTOM", None), (1, "SIMPLE", None)],
        "session_id long, label string, custom_id string",
    )
    made = sessions.create_sessions(asked, "c")
    routed = {r["session_id"]: r["blueprint"] for r in sessions.route_algorithm(made).collect()}
    assert routed == {1: B.SIMPLE_BLUEPRINT, 2: "mine", 3: "NAVIGABLE_UX", 4: None}


@pytest.mark.parametrize("gap", [60, 3600])
def test_temporary_sessions(spark, gap):
    rng = np.random.default_rng(2)
    times = {u: np.sort(rng.integers(0, 40_000, 60)) for u in range(3)}
    rows = [(u, int(t)) for u, ts in times.items() for t in ts]
    log = local_table(spark, rows, "user_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r["user_id"], r["n_events"]) for r in sessions.temporary_sessions(log, gap).collect())
    expected = []
    for u, ts in times.items():
        cuts = np.flatnonzero(np.diff(ts) > gap) + 1
        expected += [(u, len(x)) for x in np.split(ts, cuts)]
    assert got == sorted(expected)


def test_own_blueprints_are_read_once(spark, sf_dir, monkeypatch):
    """A trace joins nodes and edges several times; documents are parsed before it."""
    from sessionloom.operators import states
    from sessionloom.plans import catalog

    plans, trace = [], states.session_state_trace

    def seen(actions, sessions, nodes, edges):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (nodes, edges))
        return trace(actions, sessions, nodes, edges)

    monkeypatch.setattr(states, "session_state_trace", seen)
    assert catalog.QUERIES["custom_state_trace"](spark, sf_dir).count()
    assert len(plans) == 2 and not any("from_json" in p or "Generate" in p for p in plans)
