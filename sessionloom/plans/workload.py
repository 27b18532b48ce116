"""The given tables in the roles of the library's inputs.

``embeddings`` are the items; ``events`` are the actions of sessions (one per
user): a view asks for a batch, click, purchase and signup are signals on the
item named in ``props``, an error is no valid action.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import USER_EMBEDDINGS_LAST_N, broadcast_if_small, stage
from sessionloom.operators.profiles import label_topics, latest_signals, profile_depth, user_embeddings
from sessionloom.operators.states import session_state_trace
from sessionloom.sources import blueprints, signals
from sessionloom.sources.items import load_items
from sessionloom.sources.sessions import create_sessions, route_algorithm, update_states

DIM = 64

ACTION_OF_EVENT = {"view": "BATCH", "click": "CLICK_LINK", "purchase": "PURCHASE", "signup": "SUBSCRIBE"}

# A session's algorithm label, by its id modulo their number.
LABELS = [
    "SIMPLE",
    "UNIQUE_JOURNEYS",
    "USER_CENTRIC_PROMOTED_CONTENT_CURATIONS",
    "USER_INTENT_AI_AGENTS",
    "INDIVIDUALLY_CRAFTED_RECOMMENDATIONS",
    "NAVIGABLE_UX",
]

BATCH_TYPE_OF_EVENT = {
    "click": "personalized",
    "error": "random",
    "purchase": "personalized",
    "signup": "biased",
    "view": "sampled",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_items(table(spark, sf_dir, "embeddings"), id_col="vec_id", dim=DIM)


def choose(column, mapping: dict, otherwise=None):
    out = F.when(F.lit(False), F.lit(None))
    for key, value in mapping.items():
        out = out.when(column == key, F.lit(value))
    return out.otherwise(otherwise)


def events_as_actions(events: DataFrame) -> DataFrame:
    """Events as ``(session_id, ts, seq, action, item_id)``; errors keep their name."""
    return events.select(
        F.col("user_id").alias("session_id"),
        "ts",
        F.col("event_id").alias("seq"),
        choose(F.col("event_type"), ACTION_OF_EVENT, F.upper("event_type")).alias("action"),
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
    )


def all_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_actions(table(spark, sf_dir, "events"))


def parsed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.parse_actions(all_actions(spark, sf_dir), signals.vocabulary(spark))


def valid_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_actions(spark, sf_dir).where("known")


def signals_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = signals.signal_guard(parsed_actions(spark, sf_dir))
    return good.select("session_id", "ts", "seq", F.col("action").alias("label"), "weight", "item_id")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sessions have signalled."""
    log = signals_log(spark, sf_dir)
    return stage(log.select("session_id", F.col("item_id").alias("history_value"), F.col("ts").alias("served_ts")))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = profile_depth(builtin(spark)[0])
    return stage(user_embeddings(signals_log(spark, sf_dir), items(spark, sf_dir), depth))


@lru_cache(maxsize=1)
def builtin(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    nodes, edges, _ = blueprints.load_blueprints(blueprints.builtin_documents(spark))
    return broadcast_if_small(nodes), broadcast_if_small(edges)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new session per user, its label by user id."""
    labels = F.array(*[F.lit(x) for x in LABELS])
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"))
    label = F.element_at(labels, (F.col("session_id") % len(LABELS)).cast("int") + 1)
    return create_sessions(users.withColumn("label", label), "embeddings")


def trace(spark: SparkSession, sf_dir: str, new_sessions: DataFrame | None = None) -> DataFrame:
    nodes, edges = builtin(spark)
    new_sessions = sessions(spark, sf_dir) if new_sessions is None else new_sessions
    return session_state_trace(valid_actions(spark, sf_dir), route_algorithm(new_sessions), nodes, edges)


def current_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions after all their actions."""
    new_sessions = stage(sessions(spark, sf_dir))
    return update_states(new_sessions, trace(spark, sf_dir, new_sessions))


def bias(sessions: DataFrame, items: DataFrame) -> DataFrame:
    """Bias vectors of weight 1: every second topic of the collection, by the session's parity."""
    # One row per label.
    own = topics(items).select(
        (F.col("topic") % 2).alias("_parity"), F.floor(F.col("topic") / 2).cast("int").alias("bias_idx"), "embedding"
    )
    asked = sessions.select("session_id", (F.col("session_id") % 2).alias("_parity"))
    return asked.join(F.broadcast(own), "_parity").select("session_id", "bias_idx", "embedding", F.lit(1.0).alias("weight"))


def topics(items: DataFrame) -> DataFrame:
    return stage(label_topics(items, "label"))


def node_params(spark: SparkSession, blueprint: str, node: str) -> DataFrame:
    nodes, _ = builtin(spark)
    return nodes.where((F.col("blueprint") == blueprint) & (F.col("name") == node)).select("params")


def requests_in(spark: SparkSession, sf_dir: str, blueprint: str, node: str) -> DataFrame:
    """A request of every session, as if all were in one node."""
    params = node_params(spark, blueprint, node).select("params", F.lit(1).alias("_one"))
    ids = sessions(spark, sf_dir).select("session_id", F.lit(1).alias("_one"))
    return ids.join(F.broadcast(params), "_one").drop("_one")


def custom_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blueprint document per user, made of what the user did.

    A node per event type the user has; with n events of the type, some of the
    edges are left out, so that a part of the documents is invalid.
    """
    events = table(spark, sf_dir, "events")
    counts = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).cast("int").alias("n"))
    batch_type = choose(F.col("event_type"), BATCH_TYPE_OF_EVENT)
    share = F.format_string("%d.%02d", (F.col("n") / 100).cast("int"), F.col("n") % 100)
    flag = F.when(F.col("n") % 3 == 0, F.lit("true")).otherwise(F.lit("false"))
    threshold = F.when(F.col("n") % 2 == 0, share).otherwise(F.concat(F.lit("["), flag, F.lit(", "), share, F.lit("]")))
    mmr = F.when(F.col("n") % 4 == 0, F.lit("1")).otherwise(flag)
    extra = F.when(F.col("n") % 13 == 0, F.lit(', "gamma": 1')).otherwise(F.lit(""))
    node = F.format_string(
        '{"name": "%s", "batch_type": "%s", "params": {"last_n": %d, "mu": %s, "apply_threshold": %s, "apply_mmr": %s%s}}',
        "event_type", batch_type, F.col("n"), share, threshold, mmr, extra,
    )
    rows = counts.select("user_id", F.struct("event_type", "n", node.alias("node")).alias("r"))
    # At most one row per event type.
    users = rows.groupBy("user_id").agg(F.array_sort(F.collect_list("r")).alias("rs"))

    def edge(action: str, start, end):
        return F.format_string('{"name": "e", "edge_type": "' + action + '", "start": "%s", "end": "%s"}', start, end)

    rs = F.col("rs")
    first = rs[0]["event_type"]
    following = F.transform(rs, lambda r, i: F.struct(r.alias("r"), F.element_at(rs, (i + 1) % F.size(rs) + 1).alias("to")))
    own = F.transform(F.filter(rs, lambda r: r["n"] % 2 == 0), lambda r: edge("PURCHASE", r["event_type"], r["event_type"]))
    default = F.transform(F.filter(rs, lambda r: r["n"] % 11 != 0), lambda r: edge("DEFAULT", r["event_type"], first))
    batch = F.transform(
        F.filter(following, lambda x: x["r"]["n"] % 10 != 0),
        lambda x: edge("BATCH", x["r"]["event_type"], x["to"]["event_type"]),
    )
    doc = F.concat(
        F.lit('{"signals": [{"label": "user_signal", "weight": 1.5}], "nodes": ['),
        F.array_join(F.transform(rs, lambda r: r["node"]), ", "),
        F.lit('], "edges": ['),
        F.array_join(F.concat(own, default, batch), ", "),
        F.lit("]}"),
    )
    return users.select(F.col("user_id").cast("string").alias("blueprint"), doc.alias("doc"))


def latest_queries(spark: SparkSession, sf_dir: str, top_k: int = 8) -> DataFrame:
    """Queries of each session's whole profile."""
    rows = user_embeddings(signals_log(spark, sf_dir), items(spark, sf_dir), USER_EMBEDDINGS_LAST_N)
    return stage(rows.withColumn("top_k", F.lit(top_k)))


def latest_asked(spark: SparkSession, sf_dir: str, top_k: int = 8) -> DataFrame:
    """The same queries, their vectors named by the items' ids."""
    rows = latest_signals(signals_log(spark, sf_dir), USER_EMBEDDINGS_LAST_N)
    return stage(rows.select("session_id", "q_idx", F.col("item_id").alias("vector"), F.lit(top_k).alias("top_k")))


def item_vectors(items: DataFrame) -> DataFrame:
    return items.select(F.col("id").alias("vector"), "embedding")
