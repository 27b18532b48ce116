"""The batches a session can be served, for all sessions at once.

Requests are ``(session_id, params[, batch_size])`` with a node's typed parameters; the
result is ``served(session_id, position, id, score, q_idx)``. One search serves
all requests, whatever their batch type. Profiles, topics and histories are read
more than once, so they should be tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import BATCH_SIZE, MINIMUM_TOPK, stage
from sessionloom.functions import vectors as V
from sessionloom.operators import profiles
from sessionloom.operators.budgets import adjust_weights, set_top_k
from sessionloom.operators.knn import knn_join
from sessionloom.operators.postprocess import apply_params, take_batch
from sessionloom.sources.blueprints import transition_lookup
from sessionloom.sources.history import history_values
from sessionloom.sources.items import embedding_width, project_result
from sessionloom.sources.sessions import route_algorithm
from sessionloom.sources.signals import BATCH

_QUERY_COLUMNS = [
    "session_id",
    "q_idx",
    "embedding",
    "top_k",
    "top_k_mmr",
    "threshold",
    "apply_mmr",
    "remove_duplicates",
    "batch_size",
]


@dataclass
class Options:
    """How batches are made.

    ``search(queries, exclude=...)`` finds candidates under ``metric``; by default
    all items are searched, exactly. For a large collection give one that goes
    through an index, such as ``partial(ivf_join, index=..., n_probe=8)``.
    """

    batch_size: int = BATCH_SIZE
    policy: str = "plain"
    seed: int = 0
    metric: str = "cosine_sim"
    mmr_seed: str = "least_similar"
    search: Callable[..., DataFrame] | None = None


def _sized(requests: DataFrame, batch_size: int) -> DataFrame:
    """Requests with their parameters and batch size: their own, or the given one."""
    own = F.col("batch_size") if "batch_size" in requests.columns else F.lit(batch_size)
    return requests.select("session_id", "params", own.cast("int").alias("batch_size"))


def budgeted_queries(profile: DataFrame, requests: DataFrame, batch_size: int) -> DataFrame:
    """Queries of a weighted profile with budgets and the node's parameters."""
    asked = profile.join(_sized(requests, batch_size), "session_id")
    p = adjust_weights(asked, F.col("batch_size")).select(
        "batch_size",
        "session_id",
        "q_idx",
        _vector(asked).alias("embedding"),
        "budget",
        "params.threshold",
        "params.apply_mmr",
        "params.remove_duplicates",
    )
    return set_top_k(p, F.col("apply_mmr")).select(*_QUERY_COLUMNS)


def _vector(rows: DataFrame):
    """The vectors in DOUBLE; names that stand for vectors are left as they are."""
    is_vector = isinstance(rows.schema["embedding"].dataType, T.ArrayType)
    return V.as_double("embedding") if is_vector else F.col("embedding")


def random_batch_queries(requests: DataFrame, dim: int, batch_size: int, seed: int) -> DataFrame:
    """Random queries: neither threshold nor MMR, whatever the node says."""
    top_k = 2 * MINIMUM_TOPK
    asked = _sized(requests, batch_size)
    return profiles.random_profile(asked, dim, F.col("batch_size"), seed, keep=("params", "batch_size")).select(
        "session_id",
        "q_idx",
        "embedding",
        F.lit(top_k).alias("top_k"),
        F.lit(top_k // 2).alias("top_k_mmr"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(False).alias("apply_mmr"),
        "params.remove_duplicates",
        "batch_size",
    )


def serve(queries: DataFrame, items: DataFrame, options: Options, exclude: DataFrame | None = None) -> DataFrame:
    """Search, post-process and cut to the batch size."""
    if options.metric != "cosine_sim":
        # MMR compares by cosine; scores of other metrics do not tell it.
        queries = queries.withColumn("query_embedding", F.col("embedding"))
    exclude = None if exclude is None else stage(exclude)
    search = options.search or partial(knn_join, items=items, metric=options.metric)
    # MMR and the rest branch from the search; it is run once.
    candidates = stage(search(stage(queries), exclude=exclude))
    pool = apply_params(candidates, items, options.metric, options.seed, options.mmr_seed)
    batch = take_batch(pool, F.col("batch_size"))
    return batch.select("session_id", "position", "id", "score", "q_idx")


def _own_rows(profile: DataFrame, requests: DataFrame, items: DataFrame, options: Options) -> DataFrame:
    """What the requests' nodes look at of the profiles."""
    spread = {}
    if options.policy == "spread":
        spread = {"centroid": profiles.collection_centroid(items), "dim": embedding_width(items)}
    return profiles.personalized_profile(profile, requests, options.policy, seed=options.seed, **spread)


def random_batch(
    requests: DataFrame, items: DataFrame, options: Options = Options(), exclude: DataFrame | None = None
) -> DataFrame:
    """Neighbours of random vectors; history is left aside unless ``exclude`` is given."""
    queries = random_batch_queries(requests, embedding_width(items), options.batch_size, options.seed)
    return serve(queries, items, options, exclude)


def personalized_batch(
    requests: DataFrame,
    profile: DataFrame,
    items: DataFrame,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> DataFrame:
    """Neighbours of the profile; sessions without one get a random batch."""
    own = _own_rows(profile, requests, items, options)
    queries = budgeted_queries(own, requests, options.batch_size)
    cold = requests.join(profile.select("session_id").distinct(), "session_id", "left_anti")
    chance = random_batch_queries(cold, embedding_width(items), options.batch_size, options.seed)
    exclude = None
    if history is not None:
        exclude = history_values(history).join(cold.select("session_id"), "session_id", "left_anti")
    return serve(queries.unionByName(chance), items, options, exclude)


def biased_batch(
    requests: DataFrame,
    profile: DataFrame,
    bias: DataFrame,
    items: DataFrame,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> DataFrame:
    """Neighbours of profile and bias vectors; requests without bias get nothing."""
    own = _own_rows(profile, requests, items, options)
    asked = bias.join(requests.select("session_id"), "session_id", "left_semi")
    queries = budgeted_queries(profiles.biased_profile(own, asked), requests, options.batch_size)
    exclude = None if history is None else history_values(history)
    return serve(queries, items, options, exclude)


def sampled_batch(
    requests: DataFrame,
    topics: DataFrame,
    items: DataFrame,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> DataFrame:
    """Neighbours of topics drawn for each session."""
    drawn = profiles.sampled_profile(requests.select("session_id", "params.n_topics"), topics, options.seed)
    queries = budgeted_queries(drawn, requests, options.batch_size)
    exclude = None if history is None else history_values(history)
    return serve(queries, items, options, exclude)


def plan_requests(sessions: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """What a BATCH action does to every session: next state, batch type, parameters.

    Sessions without a known blueprint or state have none (``session_problems`` names them).
    """
    asked = route_algorithm(sessions).withColumn("action", F.lit(BATCH))
    return transition_lookup(asked, nodes, edges).where(F.col("next_state").isNotNull())


def next_batch(
    sessions: DataFrame,
    profile: DataFrame,
    items: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    topics: DataFrame,
    bias: DataFrame,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> tuple[DataFrame, DataFrame]:
    """The next batch of every session, and the requests with their ``next_state``."""
    requests = stage(plan_requests(sessions, nodes, edges))
    return serve_requests(requests, profile, items, topics, bias, history, options), requests


PROGRESS = {"states": "session_id {session}, state string", "served": "session_id {session}, history_value {value}"}


def create_progress(sessions: DataFrame, items: DataFrame, path: str) -> None:
    """Empty tables of states and served items, as batch -1."""
    types = {
        "session": sessions.schema["session_id"].dataType.simpleString(),
        "value": items.schema["history_value"].dataType.simpleString(),
    }
    for name, schema in PROGRESS.items():
        empty = sessions.sparkSession.createDataFrame([], schema.format(**types)).coalesce(1)
        empty.write.mode("overwrite").parquet(f"{path}/{name}/batch_id=-1")


def recorded_next_batch(
    sessions: DataFrame,
    profile: DataFrame,
    items: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    topics: DataFrame,
    bias: DataFrame,
    path: str,
    batch_id: int,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> DataFrame:
    """The next batch of every session, with the items' metadata, written down under ``path``.

    States and served items of earlier batches are taken from there; ``history`` is
    what else sessions have seen. Running a batch again replaces what it wrote.
    """
    spark = sessions.sparkSession
    earlier = F.col("batch_id") < batch_id
    states = spark.read.parquet(f"{path}/states").where(earlier).groupBy("session_id")
    known = states.agg(F.max_by("state", "batch_id").alias("_state"))
    current = sessions.join(known, "session_id", "left").withColumn("state", F.coalesce("_state", "state")).drop("_state")
    seen = spark.read.parquet(f"{path}/served").where(earlier).select("session_id", "history_value")
    if history is not None:
        seen = seen.unionByName(history_values(history))
    found, requests = next_batch(stage(current), profile, items, nodes, edges, topics, bias, stage(seen), options)
    found = stage(found)
    values = items.select("id", "history_value")
    found.join(values, "id").select("session_id", "history_value").write.mode("overwrite").parquet(f"{path}/served/batch_id={batch_id}")
    moved = requests.select("session_id", F.col("next_state").alias("state"))
    moved.write.mode("overwrite").parquet(f"{path}/states/batch_id={batch_id}")
    return project_result(found, items, include_values=False)


def serve_requests(
    requests: DataFrame,
    profile: DataFrame,
    items: DataFrame,
    topics: DataFrame,
    bias: DataFrame,
    history: DataFrame | None = None,
    options: Options = Options(),
) -> DataFrame:
    """Batches for requests ``(session_id, batch_type, params, has_embeddings)`` of any type.

    Requests are split by batch type; their queries share one search. A biased
    request without a bias gets nothing, a personalized one without a profile a
    random batch.
    """
    queries = request_queries(requests, profile, items, topics, bias, options)
    exclude = None
    if history is not None:
        exclude = history_values(history).join(requests.where(left_to_chance()).select("session_id"), "session_id", "left_anti")
    return serve(queries, items, options, exclude)


def left_to_chance():
    """Which requests get random vectors, and take no notice of history."""
    cold = (F.col("batch_type") == "personalized") & ~F.col("has_embeddings")
    return (F.col("batch_type") == "random") | cold


def request_queries(
    requests: DataFrame, profile: DataFrame, items: DataFrame, topics: DataFrame, bias: DataFrame, options: Options = Options()
) -> DataFrame:
    """The budgeted queries of requests of any type.

    Profile, topics and bias may name vectors instead of holding them, under policy
    ``plain`` and without requests left to chance.
    """
    chance = requests.where(left_to_chance())
    warm = requests.where(~left_to_chance())
    asked = bias.join(warm.where("batch_type = 'biased'").select("session_id"), "session_id", "left_semi")
    personal = warm.where("batch_type = 'personalized'")
    biased = warm.where("batch_type = 'biased'").join(asked.select("session_id").distinct(), "session_id", "left_semi")
    sampled = warm.where("batch_type = 'sampled'").select("session_id", "params.n_topics")

    own = _own_rows(profile, personal.unionByName(biased), items, options)
    drawn = profiles.sampled_profile(sampled, topics, options.seed)
    parts = [own, profiles.numbered_bias(own, asked), drawn]
    weighted = reduce(DataFrame.unionByName, [x.withColumn("embedding", _vector(x)) for x in parts])
    queries = budgeted_queries(weighted, warm, options.batch_size)
    if not isinstance(queries.schema["embedding"].dataType, T.ArrayType):
        return queries
    return queries.unionByName(
        random_batch_queries(chance, embedding_width(items), options.batch_size, options.seed)
    )
