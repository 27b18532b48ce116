"""Blueprints: declarative state machines that decide what a session is served.

A blueprint is a JSON document of nodes (batch type and parameters) and edges
(an action that leads from node to node). It is loaded into two tables,
``bp_nodes`` and ``bp_edges``; everything after that is a join.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import broadcast_if_small, local_table
from sessionloom.sources.signals import BATCH, DEFAULT

BATCH_TYPES = ("personalized", "biased", "sampled", "random")
START_STATE = "0"

# The built-in blueprints. The first node is the start state.
BLUEPRINTS = {
    "UNIQUE_JOURNEYS": {
        "nodes": [
            {"name": "Welcome", "batch_type": "biased", "params": {"r": 0.2, "mu": 0.2, "alpha": 0.4, "apply_threshold": 0.7, "apply_mmr": False, "last_n": 5}},
            {"name": "Exploration", "batch_type": "personalized", "params": {"r": 0.3, "mu": 0.6, "alpha": 0.7, "apply_threshold": 0.3, "apply_mmr": True, "last_n": 8}},
            {"name": "Discovery", "batch_type": "personalized", "params": {"r": 0.2, "mu": 0.4, "alpha": 0.5, "apply_threshold": 0.3, "apply_mmr": True, "last_n": 6}},
            {"name": "Dedicated", "batch_type": "personalized", "params": {"r": 0.1, "mu": 0.2, "alpha": 0.4, "apply_threshold": 0.5, "apply_mmr": True, "last_n": 5}},
            {"name": "Focus", "batch_type": "personalized", "params": {"r": 0.1, "mu": 0.05, "alpha": 0.1, "apply_threshold": 0.6, "apply_mmr": False, "last_n": 4}},
            {"name": "Hyper_Focus", "batch_type": "personalized", "params": {"r": 0, "mu": 0, "alpha": 0, "apply_threshold": 0.7, "apply_mmr": False, "last_n": 2}},
        ],
        "edges": [
            {"edge_type": "DEFAULT", "start": "Welcome", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Exploration", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Discovery", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Dedicated", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Focus", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Hyper_Focus", "end": "Hyper_Focus"},
            {"edge_type": "BATCH", "start": "Welcome", "end": "Exploration"},
            {"edge_type": "BATCH", "start": "Exploration", "end": "Welcome"},
            {"edge_type": "BATCH", "start": "Discovery", "end": "Exploration"},
            {"edge_type": "BATCH", "start": "Dedicated", "end": "Discovery"},
            {"edge_type": "BATCH", "start": "Focus", "end": "Dedicated"},
            {"edge_type": "BATCH", "start": "Hyper_Focus", "end": "Focus"},
        ],
    },
    "USER_CENTRIC_PROMOTED_CONTENT_CURATIONS": {
        "nodes": [
            {"name": "Exploration", "batch_type": "sampled", "params": {"n_topics": 8, "last_n": 3}},
            {"name": "Curated", "batch_type": "personalized", "params": {"r": 0, "mu": 0.1, "alpha": 0.3, "apply_threshold": 0.6, "apply_mmr": False, "last_n": 1}},
        ],
        "edges": [
            {"edge_type": "DEFAULT", "start": "Exploration", "end": "Curated"},
            {"edge_type": "DEFAULT", "start": "Curated", "end": "Curated"},
            {"edge_type": "BATCH", "start": "Exploration", "end": "Exploration"},
            {"edge_type": "BATCH", "start": "Curated", "end": "Curated"},
        ],
    },
    # The signal edges end in Focus: the node they were meant for does not exist.
    "USER_INTENT_AI_AGENTS": {
        "nodes": [
            {"name": "Welcome", "batch_type": "biased", "params": {"r": 0, "mu": 0.1, "alpha": 0.4, "apply_threshold": 0.8, "apply_mmr": False, "last_n": 12}},
            {"name": "Expansion", "batch_type": "personalized", "params": {"r": 0, "mu": 0.2, "alpha": 0.6, "apply_threshold": 0.6, "apply_mmr": True, "last_n": 12}},
            {"name": "Exploration", "batch_type": "personalized", "params": {"r": 0, "mu": 0.5, "alpha": 0.6, "apply_threshold": 0.5, "apply_mmr": True, "last_n": 12}},
            {"name": "Focus", "batch_type": "personalized", "params": {"r": 0, "mu": 0, "alpha": 0, "apply_threshold": 0.8, "apply_mmr": False, "last_n": 6}},
        ],
        "edges": [
            {"edge_type": "DEFAULT", "start": "Welcome", "end": "Focus"},
            {"edge_type": "DEFAULT", "start": "Expansion", "end": "Focus"},
            {"edge_type": "DEFAULT", "start": "Exploration", "end": "Focus"},
            {"edge_type": "DEFAULT", "start": "Focus", "end": "Focus"},
            {"edge_type": "BATCH", "start": "Welcome", "end": "Welcome"},
            {"edge_type": "BATCH", "start": "Expansion", "end": "Exploration"},
            {"edge_type": "BATCH", "start": "Exploration", "end": "Exploration"},
            {"edge_type": "BATCH", "start": "Focus", "end": "Expansion"},
        ],
    },
    "INDIVIDUALLY_CRAFTED_RECOMMENDATIONS": {
        "nodes": [
            {"name": "Recommendation", "batch_type": "personalized", "params": {"r": 0, "mu": 0.0, "alpha": 0, "apply_threshold": 0.7, "apply_mmr": False, "last_n": 1}},
            {"name": "Expansion", "batch_type": "personalized", "params": {"r": 0, "mu": 0.05, "alpha": 0.4, "apply_threshold": 0.7, "apply_mmr": True, "last_n": 2}},
            {"name": "Discovery", "batch_type": "personalized", "params": {"r": 0, "mu": 0.1, "alpha": 1, "apply_threshold": 0.6, "apply_mmr": True, "last_n": 4}},
        ],
        "edges": [
            {"edge_type": "DEFAULT", "start": "Discovery", "end": "Recommendation"},
            {"edge_type": "DEFAULT", "start": "Expansion", "end": "Recommendation"},
            {"edge_type": "DEFAULT", "start": "Recommendation", "end": "Recommendation"},
            {"edge_type": "BATCH", "start": "Recommendation", "end": "Expansion"},
            {"edge_type": "BATCH", "start": "Expansion", "end": "Discovery"},
            {"edge_type": "BATCH", "start": "Discovery", "end": "Discovery"},
        ],
    },
    "NAVIGABLE_UX": {
        "nodes": [
            {"name": "Exploration", "batch_type": "random", "params": {"last_n": 8}},
            {"name": "Browsing", "batch_type": "sampled", "params": {"n_topics": 12, "last_n": 8}},
            {"name": "Discovery", "batch_type": "personalized", "params": {"r": 0.2, "mu": 0.5, "alpha": 0.7, "apply_threshold": 0.3, "apply_mmr": True}},
            {"name": "Dedicated", "batch_type": "personalized", "params": {"r": 0.1, "mu": 0.2, "alpha": 0.4, "apply_threshold": 0.5, "apply_mmr": True, "last_n": 5}},
            {"name": "Focus", "batch_type": "personalized", "params": {"r": 0.1, "mu": 0.05, "alpha": 0.1, "apply_threshold": 0.6, "apply_mmr": False, "last_n": 4}},
            {"name": "Hyper_Focus", "batch_type": "personalized", "params": {"r": 0, "mu": 0, "alpha": 0, "apply_threshold": 0.7, "apply_mmr": False, "last_n": 2}},
        ],
        "edges": [
            {"edge_type": "DEFAULT", "start": "Exploration", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Browsing", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Discovery", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Dedicated", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Focus", "end": "Hyper_Focus"},
            {"edge_type": "DEFAULT", "start": "Hyper_Focus", "end": "Hyper_Focus"},
            {"edge_type": "BATCH", "start": "Exploration", "end": "Browsing"},
            {"edge_type": "BATCH", "start": "Browsing", "end": "Browsing"},
            {"edge_type": "BATCH", "start": "Discovery", "end": "Discovery"},
            {"edge_type": "BATCH", "start": "Dedicated", "end": "Discovery"},
            {"edge_type": "BATCH", "start": "Focus", "end": "Dedicated"},
            {"edge_type": "BATCH", "start": "Hyper_Focus", "end": "Focus"},
        ],
    },
}

# Fixed value: the blueprint behind the label SIMPLE.
SIMPLE_BLUEPRINT = "USER_CENTRIC_PROMOTED_CONTENT_CURATIONS"

PARAM_NAMES = ["mu", "alpha", "r", "last_n", "n_topics", "remove_duplicates", "apply_threshold", "apply_mmr"]

_DOC = (
    "signals array<struct<label string, weight double>>, "
    "nodes array<struct<name string, batch_type string, params string>>, "
    "edges array<struct<name string, edge_type string, start string, `end` string>>"
)
_PARAMS = (
    "mu double, alpha double, r double, last_n int, n_topics int, "
    "remove_duplicates boolean, apply_threshold string, apply_mmr string"
)


def builtin_documents(spark: SparkSession) -> DataFrame:
    """The built-in blueprints as documents ``(blueprint, doc)``."""
    return local_table(spark, [(k, json.dumps(v)) for k, v in BLUEPRINTS.items()], "blueprint string, doc string")


def normalise_params(raw):
    """A node's JSON parameters as a typed struct with the defaults filled in.

    A threshold is a number (active above 0) or ``[flag, number]``; NULL is off.
    MMR is a boolean or 0/1. ``unknown`` lists keys that are not parameters.
    """
    raw = F.coalesce(raw, F.lit("{}"))
    p = F.from_json(raw, _PARAMS)
    listed = F.from_json(p["apply_threshold"], "array<string>")
    number = p["apply_threshold"].try_cast("double")
    on = F.lower(F.trim(F.get(listed, F.lit(0)))).isin("true", "1", "1.0")
    threshold = F.when(F.startswith(F.ltrim(p["apply_threshold"]), F.lit("[")), F.when(on, F.get(listed, F.lit(1)).try_cast("double")))
    mmr = F.lower(p["apply_mmr"]).isin("true", "1", "1.0")
    keys = F.map_keys(F.from_json(raw, "map<string,string>"))
    return F.struct(
        F.coalesce(p["mu"], F.lit(0.0)).alias("mu"),
        F.coalesce(p["alpha"], F.lit(0.0)).alias("alpha"),
        F.coalesce(p["r"], F.lit(0.0)).alias("r"),
        F.coalesce(p["last_n"], F.lit(0)).alias("last_n"),
        F.coalesce(p["n_topics"], F.lit(0)).alias("n_topics"),
        F.coalesce(p["remove_duplicates"], F.lit(True)).alias("remove_duplicates"),
        F.coalesce(threshold, F.when(number > 0, number)).alias("threshold"),
        F.coalesce(mmr, F.lit(False)).alias("apply_mmr"),
        F.array_except(keys, F.array(*[F.lit(n) for n in PARAM_NAMES])).alias("unknown"),
    )


def load_blueprints(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents ``(blueprint, doc)`` to ``bp_nodes``, ``bp_edges`` and added signals.

    Ordinals are declaration order.
    """
    parsed = docs.select("blueprint", F.from_json("doc", _DOC).alias("d"))
    nodes = parsed.select("blueprint", F.posexplode("d.nodes").alias("node_ord", "n")).select(
        "blueprint", "node_ord", "n.name", "n.batch_type", normalise_params(F.col("n.params")).alias("params")
    )
    edges = parsed.select("blueprint", F.posexplode("d.edges").alias("edge_ord", "e")).select(
        "blueprint", "edge_ord", "e.start", F.upper("e.edge_type").alias("action"), "e.end"
    )
    signals = parsed.select("blueprint", F.posexplode("d.signals").alias("ord", "s")).select(
        "blueprint", "ord", "s.label", "s.weight"
    )
    return nodes, edges, signals


def validate_blueprints(nodes: DataFrame, edges: DataFrame, vocabulary: DataFrame, added: DataFrame) -> DataFrame:
    """Violations ``(blueprint, subject, problem)``; a valid blueprint has none.

    A node needs a BATCH edge, and a DEFAULT edge unless its edges cover every
    signal the blueprint knows. Edge ends have to be nodes.
    """
    n_vocabulary = vocabulary.count()
    new = added.select("blueprint", F.upper("label").alias("label")).distinct()
    new = new.join(vocabulary.select("label"), "label", "left_anti")
    n_signals = new.groupBy("blueprint").agg(F.count(F.lit(1)).alias("n_new"))

    is_batch = F.col("action") == BATCH
    out = edges.groupBy("blueprint", F.col("start").alias("name")).agg(
        F.max(is_batch).alias("has_batch"),
        F.max(F.col("action") == DEFAULT).alias("has_default"),
        F.count_distinct(F.when(~is_batch, F.col("action"))).alias("n_covered"),
    )
    checked = nodes.join(out, ["blueprint", "name"], "left").join(n_signals, "blueprint", "left")
    covered = F.coalesce("n_covered", F.lit(0)) == n_vocabulary + F.coalesce("n_new", F.lit(0))
    problems = F.array_compact(
        F.array(
            F.when(~F.coalesce("has_batch", F.lit(False)), F.lit("no BATCH edge")),
            F.when(~F.coalesce("has_default", F.lit(False)) & ~covered, F.lit("signals not covered")),
            F.when(~F.col("batch_type").isin(*BATCH_TYPES), F.lit("unknown batch type")),
            F.when(F.size("params.unknown") > 0, F.lit("unknown parameter")),
        )
    )
    of_nodes = checked.select("blueprint", F.col("name").alias("subject"), F.explode(problems).alias("problem"))

    ends = edges.select("blueprint", F.explode(F.array("start", "end")).alias("name")).distinct()
    dangling = ends.join(nodes.select("blueprint", "name"), ["blueprint", "name"], "left_anti")
    of_ends = dangling.select("blueprint", F.col("name").alias("subject"), F.lit("edge end is not a node").alias("problem"))

    actions = edges.where(~is_batch).select("blueprint", F.col("action").alias("label")).distinct()
    unknown = actions.join(vocabulary.select("label"), "label", "left_anti").join(
        added.select("blueprint", F.upper("label").alias("label")), ["blueprint", "label"], "left_anti"
    )
    of_actions = unknown.select("blueprint", F.col("label").alias("subject"), F.lit("unknown action").alias("problem"))
    return of_nodes.unionByName(of_ends).unionByName(of_actions)


def _first_edges(edges: DataFrame) -> DataFrame:
    """One edge per (blueprint, start, action): the first declared."""
    return edges.groupBy("blueprint", "start", "action").agg(F.min_by("end", "edge_ord").alias("end"))


def transition_lookup(requests: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Resolve ``(blueprint, state, action)``: adds ``next_state`` and the *source*
    node's ``batch_type`` and ``params``.

    An action without an edge of its own takes the DEFAULT edge, BATCH included; where
    there is none either, the session stays where it is. ``next_state`` is NULL for an
    unknown blueprint or state only.
    """
    first = broadcast_if_small(_first_edges(edges))
    nodes = broadcast_if_small(nodes)
    own = first.withColumnsRenamed({"start": "_at", "end": "_own"})
    default = first.where(F.col("action") == DEFAULT).select("blueprint", F.col("start").alias("_at"), F.col("end").alias("_default"))
    start = nodes.where("node_ord = 0").select("blueprint", F.col("name").alias("_start"))
    spec = nodes.select("blueprint", F.col("name").alias("_at"), "batch_type", "params")
    return (
        requests.join(start, "blueprint", "left")
        .withColumn("_at", F.when(F.col("state") == START_STATE, F.col("_start")).otherwise(F.col("state")))
        .join(own, ["blueprint", "_at", "action"], "left")
        .join(default, ["blueprint", "_at"], "left")
        .join(spec, ["blueprint", "_at"], "left")
        # Only nodes of the blueprint have a batch type.
        .withColumn("next_state", F.coalesce("_own", "_default", F.when(F.col("batch_type").isNotNull(), F.col("_at"))))
        .drop("_start", "_at", "_own", "_default")
    )


def step_maps(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """For each (blueprint, action) the function node -> next node.

    ``step[i]`` is the ordinal of the node that node ``i`` goes to; a node without
    a matching edge stays. Rows exist for the actions a blueprint names, DEFAULT
    (every other signal) and BATCH.
    """
    actions = edges.select("blueprint", "action").union(
        nodes.select("blueprint", F.explode(F.array(F.lit(BATCH), F.lit(DEFAULT))))
    ).distinct()
    first = _first_edges(edges)
    own = first.withColumnsRenamed({"start": "name", "end": "own"})
    default = own.where(F.col("action") == DEFAULT).select("blueprint", "name", F.col("own").alias("fallback"))
    ends = nodes.select("blueprint", F.col("name").alias("target"), F.col("node_ord").alias("target_ord"))
    return (
        nodes.select("blueprint", "name", "node_ord")
        .join(actions, "blueprint")
        .join(own, ["blueprint", "name", "action"], "left")
        .join(default, ["blueprint", "name"], "left")
        .withColumn("target", F.coalesce("own", "fallback"))
        .join(ends, ["blueprint", "target"], "left")
        .groupBy("blueprint", "action")
        .agg(F.array_sort(F.collect_list(F.struct("node_ord", F.coalesce("target_ord", "node_ord").alias("to")))).alias("s"))
        .select("blueprint", "action", F.col("s.to").alias("step"))
    )
