"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import new_table_path, stage
from sessionloom.functions import vectors as V
from sessionloom.operators import budgets, ivf, knn, postprocess, product, profiles, quantize, shared, states
from sessionloom.operators.mmr import mmr
from sessionloom.plans import batches, sketch
from sessionloom.plans import workload as w
from sessionloom.sources import blueprints, history, items, rejects, sessions, signals
from sessionloom.streaming import events, fold, serving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SIMPLE_BLUEPRINT = blueprints.SIMPLE_BLUEPRINT


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(name: str):
    return F.round(name, 6).alias(name)


def _component(vector: str, i: int, name: str):
    return F.round(F.col(vector)[i].cast("double"), 6).alias(name)


def checksum(vector: str):
    """A whole number of all components, on six decimals, and of their places."""
    scaled = F.transform(vector, lambda x, i: (i + 1) * F.round(x.cast("double") * 1e6).cast("long"))
    return F.aggregate(scaled, F.lit(0).cast("long"), lambda total, x: total + x).alias("checksum")


def shown(candidates: DataFrame, *more: str) -> DataFrame:
    return candidates.select("session_id", "q_idx", "rank", "id", rounded("score"), *more)


def served(batch: DataFrame) -> DataFrame:
    return batch.select("session_id", "position", "id", rounded("score"))


def latest_candidates(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """Neighbours of each session's latest signals."""
    return shared.handed_out(*_latest_by_vector(spark, sf_dir), together)


def _latest_by_vector(spark: SparkSession, sf_dir: str, metric: str = "cosine_sim") -> tuple[DataFrame, DataFrame]:
    """The sessions' latest signals as queries, and the neighbours of each signalled item."""
    all_items, asked = w.items(spark, sf_dir), w.latest_asked(spark, sf_dir)
    search = partial(knn.knn_join, items=all_items, metric=metric)
    return asked, shared.by_vector(asked, w.item_vectors(all_items), search)


def _latest_unseen(spark: SparkSession, sf_dir: str, found_items: DataFrame, search, exclude: DataFrame) -> DataFrame:
    """Neighbours of each session's latest signals, without what it must not see."""
    vectors = w.item_vectors(w.items(spark, sf_dir))
    return shared.shared_search_unseen(w.latest_asked(spark, sf_dir), vectors, found_items, search, exclude)


# --- sources ---------------------------------------------------------------


@query
def load_items(spark, sf_dir):
    return w.items(spark, sf_dir).select("id", "label", F.size("embedding").alias("dim"))


@query
def load_signals(spark, sf_dir):
    log = w.table(spark, sf_dir, "events")
    added = log.select(
        F.struct("ts", "event_id").alias("ord"), F.col("event_type").alias("label"), F.col("value").alias("weight")
    )
    return signals.load_signals(signals.vocabulary(spark), added)


@query
def load_blueprints(spark, sf_dir):
    nodes, _, _ = blueprints.load_blueprints(w.custom_documents(spark, sf_dir))
    return nodes.select("blueprint", "node_ord", "name", "batch_type")


@query
def load_blueprint_edges(spark, sf_dir):
    _, edges, _ = blueprints.load_blueprints(w.custom_documents(spark, sf_dir))
    return edges.select("blueprint", "edge_ord", "start", "action", F.col("end").alias("target"))


@query
def normalise_params(spark, sf_dir):
    nodes, _, _ = blueprints.load_blueprints(w.custom_documents(spark, sf_dir))
    fields = ["mu", "alpha", "r", "last_n", "n_topics", "remove_duplicates", "threshold", "apply_mmr"]
    return nodes.select("blueprint", "name", *[f"params.{f}" for f in fields], F.size("params.unknown").alias("n_unknown"))


@query
def validate_blueprints(spark, sf_dir):
    nodes, edges, added = blueprints.load_blueprints(w.custom_documents(spark, sf_dir))
    return blueprints.validate_blueprints(nodes, edges, signals.vocabulary(spark), added)


@query
def create_sessions(spark, sf_dir):
    users = w.table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"))
    labels = F.array(*[F.lit(x) for x in [*w.LABELS, "CUSTOM"]])
    asked = users.select(
        "session_id",
        F.element_at(labels, (F.col("session_id") % 7).cast("int") + 1).alias("label"),
        F.concat_ws("-", F.lit("bp"), F.col("session_id").cast("string")).alias("custom_id"),
        (F.col("session_id") % 2 == 0).alias("named"),
    )
    return sessions.create_sessions(asked, "embeddings")


@query
def route_algorithm(spark, sf_dir):
    return sessions.route_algorithm(create_sessions(spark, sf_dir)).select("session_id", "algorithm", "blueprint")


@query
def temporary_sessions(spark, sf_dir):
    return sessions.temporary_sessions(w.table(spark, sf_dir, "events"), gap_seconds=6 * 3600)


@query
def append_history(spark, sf_dir):
    """Two batches, the first written twice: it counts once."""
    path = new_table_path(spark, "history")
    rows = w.history(spark, sf_dir)
    half = F.dayofmonth("served_ts") <= 15
    history.append_history(rows.where(half), path, 0)
    history.append_history(rows.where(half), path, 0)
    history.append_history(rows.where(~half), path, 1)
    stored = history.read_history(spark, path)
    return stored.groupBy("session_id", "batch_id").agg(F.count(F.lit(1)).alias("n"))


@query
def read_history(spark, sf_dir):
    path = new_table_path(spark, "history")
    rows = w.history(spark, sf_dir)
    for day in range(2):
        history.append_history(rows.where(F.dayofmonth("served_ts") % 2 == day), path, day)
    return history.history_values(history.read_history(spark, path, before_batch=1))


# --- projections, filters --------------------------------------------------


@query
def fetch(spark, sf_dir):
    """The item most often signalled."""
    counts = w.signals_log(spark, sf_dir).groupBy("item_id").count()
    top = counts.orderBy(F.desc("count"), "item_id").first()["item_id"]
    return items.fetch(w.items(spark, sf_dir), top).select("id", "label", checksum("embedding"))


@query
def multi_fetch(spark, sf_dir):
    ids = w.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return items.multi_fetch(w.items(spark, sf_dir), ids).select("id", "label")


@query
def missing_ids(spark, sf_dir):
    ids = w.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return items.missing_ids(w.items(spark, sf_dir), ids)


@query
def history_filter(spark, sf_dir):
    """Items of a session's failed actions it has not signalled."""
    failed = w.parsed_actions(spark, sf_dir).where("not known")
    candidates = failed.select("session_id", "seq", F.col("item_id").alias("history_value"))
    return history.history_filter(candidates, w.history(spark, sf_dir))


@query
def history_search(spark, sf_dir):
    """Nearest items to each session's latest signals, without its history."""
    all_items, seen = w.items(spark, sf_dir), history.history_values(w.history(spark, sf_dir))
    return shown(_latest_unseen(spark, sf_dir, all_items, partial(knn.knn_join, items=all_items), seen))


@query
def history_prior_filter(spark, sf_dir):
    """The same, with a caller's predicate on the items."""
    some = items.restrict(w.items(spark, sf_dir), F.col("label") % 2 == 0)
    seen = history.history_values(w.history(spark, sf_dir))
    return shown(_latest_unseen(spark, sf_dir, some, partial(knn.knn_join, items=some), seen))


@query
def history_by_field(spark, sf_dir):
    """History by another field than the id: a seen label excludes its items."""
    labelled = items.load_items(w.table(spark, sf_dir, "embeddings"), "vec_id", dim=w.DIM, history_field="label")
    log = w.signals_log(spark, sf_dir)
    recent = profiles.latest_signals(log, 3)
    seen = recent.join(labelled.select(F.col("id").alias("item_id"), "history_value"), "item_id")
    search = partial(knn.knn_join, items=labelled)
    return shown(_latest_unseen(spark, sf_dir, labelled, search, history.history_values(seen)))


@query
def result_projection(spark, sf_dir):
    asked, found = _latest_by_vector(spark, sf_dir)
    out = items.project_result(found, w.items(spark, sf_dir), include_values=False, return_fields=["label"])
    return shown(shared.handed_out(asked, out), "label")


@query
def apply_threshold(spark, sf_dir):
    asked, found = _latest_by_vector(spark, sf_dir)
    return shown(shared.handed_out(asked, postprocess.apply_threshold(found, threshold=F.lit(0.33))))


@query
def apply_threshold_euclidean(spark, sf_dir):
    metric = "euclidean_dist"
    asked, found = _latest_by_vector(spark, sf_dir, metric)
    return shown(shared.handed_out(asked, postprocess.apply_threshold(found, metric, F.lit(1.1))))


@query
def remove_ids(spark, sf_dir):
    bought = w.signals_log(spark, sf_dir).where("label = 'PURCHASE'").select("session_id", F.col("item_id").alias("id"))
    return shown(postprocess.remove_ids(latest_candidates(spark, sf_dir), bought))


@query
def parse_action(spark, sf_dir):
    return w.parsed_actions(spark, sf_dir).select("seq", "action", "weight", "is_batch", "known")


@query
def signal_guard(spark, sf_dir):
    _, refused = signals.signal_guard(w.parsed_actions(spark, sf_dir))
    return refused.select("session_id", "seq", "action")


# --- joins -----------------------------------------------------------------


@query
def search(spark, sf_dir):
    """Neighbours of the item most often signalled."""
    all_items = w.items(spark, sf_dir)
    counts = w.signals_log(spark, sf_dir).groupBy("item_id").count()
    top = counts.orderBy(F.desc("count"), "item_id").first()["item_id"]
    vector = items.fetch(all_items, top).first()["embedding"]
    return knn.search(all_items, vector, 10).select("rank", "id", rounded("score"))


def _item_queries(all_items: DataFrame) -> DataFrame:
    return all_items.select(
        F.col("id").alias("session_id"), F.lit(0).alias("q_idx"), "embedding", F.lit(10).alias("top_k")
    )


def _all_items_as_queries(spark, sf_dir, metric):
    all_items = w.items(spark, sf_dir)
    return shown(knn.knn_join(_item_queries(all_items), all_items, metric))


@query
def multi_search(spark, sf_dir):
    return _all_items_as_queries(spark, sf_dir, "cosine_sim")


@query
def multi_search_euclidean(spark, sf_dir):
    return _all_items_as_queries(spark, sf_dir, "euclidean_dist")


@query
def multi_search_dot(spark, sf_dir):
    return _all_items_as_queries(spark, sf_dir, "dot_product")


@query
def indexed_search(spark, sf_dir):
    """The same result as ``multi_search``, through an index."""
    all_items = w.items(spark, sf_dir)
    index = ivf.build_index(all_items, ivf.train_cells(all_items, 16))
    return shown(ivf.ivf_join(_item_queries(all_items), index))


@query
def indexed_history_search(spark, sf_dir):
    """The same result as ``history_search``, through an index."""
    all_items = w.items(spark, sf_dir)
    index = ivf.build_index(all_items, ivf.train_cells(all_items, 16))
    seen = history.history_values(w.history(spark, sf_dir))
    return shown(_latest_unseen(spark, sf_dir, all_items, partial(ivf.ivf_join, index=index), seen))


@query
def approximate_search(spark, sf_dir):
    """Recall of a search that visits half of the cells."""
    all_items = w.items(spark, sf_dir)
    index = ivf.build_index(all_items, ivf.train_cells(all_items, 16))
    queries = _item_queries(all_items)
    found = ivf.recall(ivf.ivf_join(queries, index, n_probe=8), knn.knn_join(queries, all_items))
    return found.select("expected", rounded("recall"))


@query
def stored_index_search(spark, sf_dir):
    """Neighbours of every item through an index that an earlier job has stored."""
    all_items = w.items(spark, sf_dir)
    path = new_table_path(spark, "index")
    ivf.write_index(ivf.build_index(all_items, ivf.train_cells(all_items, 16)), path)
    return shown(ivf.ivf_join(_item_queries(all_items), ivf.read_index(spark, path)))


@query
def indexed_dot_search(spark, sf_dir):
    """The same result as ``multi_search_dot``, through an index."""
    all_items = w.items(spark, sf_dir)
    index = ivf.build_index(all_items, ivf.train_cells(all_items, 16, "dot_product"), "dot_product")
    return shown(ivf.ivf_join(_item_queries(all_items), index))


@query
def indexed_prior_filter(spark, sf_dir):
    """The same result as ``history_prior_filter``, through a stored index that keeps the column."""
    all_items = w.items(spark, sf_dir)
    path = new_table_path(spark, "index")
    ivf.write_index(ivf.build_index(all_items, ivf.train_cells(all_items, 16), keep=["label"]), path)
    some = ivf.restrict_index(ivf.read_index(spark, path), F.col("label") % 2 == 0)
    seen = history.history_values(w.history(spark, sf_dir))
    return shown(_latest_unseen(spark, sf_dir, all_items, partial(ivf.ivf_join, index=some), seen))


@query
def signal_item_join(spark, sf_dir):
    joined = signals.signal_item_join(w.signals_log(spark, sf_dir), w.items(spark, sf_dir))
    return joined.select(
        "session_id", "seq", "label", "weight", "item_id", "history_value", checksum("embedding")
    )


@query
def transition_lookup(spark, sf_dir):
    """What every action does to a session that is in its first state."""
    nodes, edges = w.builtin(spark)
    routed = sessions.route_algorithm(w.sessions(spark, sf_dir)).select("session_id", "blueprint", "state")
    asked = w.valid_actions(spark, sf_dir).select("session_id", "seq", "action").join(routed, "session_id")
    found = blueprints.transition_lookup(asked, nodes, edges)
    return found.select("session_id", "seq", "next_state", "batch_type", "params.last_n", "params.threshold")


# --- aggregations ----------------------------------------------------------


def _vector_ends(rows: DataFrame) -> DataFrame:
    return rows.select(
        "session_id",
        "q_idx",
        rounded("weight"),
        _component("embedding", 0, "first_x"),
        _component("embedding", w.DIM - 1, "last_x"),
        checksum("embedding"),
    )


@query
def user_embeddings(spark, sf_dir):
    return _vector_ends(profiles.user_embeddings(w.signals_log(spark, sf_dir), w.items(spark, sf_dir)))


@query
def has_embeddings(spark, sf_dir):
    return states.has_embeddings(w.valid_actions(spark, sf_dir)).select("session_id", "seq", "has_embeddings")


def _requests(spark, sf_dir, batch_types: tuple[str, ...]) -> DataFrame:
    nodes, edges = w.builtin(spark)
    planned = batches.plan_requests(w.current_sessions(spark, sf_dir), nodes, edges)
    return planned.where(F.col("batch_type").isin(*batch_types))


@query
def personalized_profile(spark, sf_dir):
    asked = _requests(spark, sf_dir, ("personalized",))
    return _vector_ends(profiles.personalized_profile(w.profile(spark, sf_dir), asked))


@query
def personalized_profile_spread(spark, sf_dir):
    all_items = w.items(spark, sf_dir)
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Exploration")
    spread = profiles.personalized_profile(
        w.profile(spark, sf_dir), asked, "spread", profiles.collection_centroid(all_items), w.DIM
    )
    return _vector_ends(spread)


@query
def biased_profile(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Welcome")
    own = profiles.personalized_profile(w.profile(spark, sf_dir), asked)
    return _vector_ends(profiles.biased_profile(own, w.bias(asked, w.items(spark, sf_dir))))


@query
def sampled_profile(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, SIMPLE_BLUEPRINT, "Exploration").select("session_id", "params.n_topics")
    return _vector_ends(profiles.sampled_profile(asked, w.topics(w.items(spark, sf_dir))))


@query
def kmeans_topics(spark, sf_dir):
    found = profiles.kmeans_topics(w.items(spark, sf_dir), k=10, seed=7)
    return found.select("topic", F.round(V.l2_norm(F.col("embedding")), 6).alias("norm"))


@query
def adjust_weights(spark, sf_dir):
    recent = profiles.latest_signals(w.signals_log(spark, sf_dir), 5)
    return budgets.adjust_weights(recent, 10).select("session_id", "q_idx", "weight", "budget")


@query
def adjust_fractional_weights(spark, sf_dir):
    """Weights below one are lifted first."""
    recent = profiles.latest_signals(w.signals_log(spark, sf_dir), 7)
    recent = recent.withColumn("weight", (F.col("weight") - 6) / 4)
    found = budgets.set_top_k(budgets.adjust_weights(recent, 20), F.col("seq") % 2 == 0)
    return found.select("session_id", "q_idx", "budget", "top_k", "top_k_mmr")


@query
def non_unique_ids(spark, sf_dir):
    return postprocess.non_unique_ids(latest_candidates(spark, sf_dir))


@query
def training_sample(spark, sf_dir):
    sample = sketch.training_sample(w.items(spark, sf_dir), seed=3)
    return sample.select("q_idx", "rank", "id")


@query
def train_scalar_quantizer(spark, sf_dir):
    return quantize.train_scalar_quantizer(w.items(spark, sf_dir)).select("level", F.round("cut", 9).alias("cut"))


@query
def train_scalar_quantizer_sketch(spark, sf_dir):
    return quantize.train_scalar_quantizer(w.items(spark, sf_dir), method="sketch")


@query
def sketch_rank_error(spark, sf_dir):
    """Whether each of the sketch's cut points has about the rank it should have among all
    components: within a hundredth, several times the sketch's own error."""
    all_items = w.items(spark, sf_dir)
    cuts = quantize.train_scalar_quantizer(all_items, method="sketch")
    return quantize.rank_errors(all_items, cuts).select("level", (F.col("error") <= 0.01).alias("close"))


@query
def train_product_quantizer(spark, sf_dir):
    book = product.train_product_quantizer(w.items(spark, sf_dir), n_slices=8, n_codes=16, rounds=5)
    return book.select("stage", "m", "code", F.size("centroid").alias("width"))


# --- windows, sorts, set operations ----------------------------------------


@query
def rank_candidates(spark, sf_dir):
    """Ranks by score after a threshold has thinned the candidates."""
    asked, found = _latest_by_vector(spark, sf_dir)
    kept = postprocess.apply_threshold(found, threshold=F.lit(0.33))
    return shown(shared.handed_out(asked, postprocess.rank_candidates(kept)))


@query
def remove_duplicates(spark, sf_dir):
    return shown(postprocess.remove_duplicates(latest_candidates(spark, sf_dir, together=True)))


@query
def session_state_trace(spark, sf_dir):
    return w.trace(spark, sf_dir).select("session_id", "seq", "action", "state", "next_state", "batch_type")


def _custom_blueprints(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sessions' own blueprints, read from their documents once: a trace joins them several times."""
    nodes, edges, added = blueprints.load_blueprints(stage(w.custom_documents(spark, sf_dir)))
    return stage(nodes), stage(edges), added


@query
def custom_state_trace(spark, sf_dir):
    """Every session through the blueprint document made for it."""
    nodes, edges, _ = _custom_blueprints(spark, sf_dir)
    own = w.sessions(spark, sf_dir).select("session_id", F.col("session_id").cast("string").alias("blueprint"), "state")
    found = states.session_state_trace(w.valid_actions(spark, sf_dir), own, nodes, edges)
    return found.select("session_id", "seq", "action", "state", "next_state")


def _custom_actions(spark, sf_dir) -> DataFrame:
    """All events; an error is the signal each session's blueprint document defines."""
    _, _, added = blueprints.load_blueprints(w.custom_documents(spark, sf_dir))
    actions = w.all_actions(spark, sf_dir).withColumn("blueprint", F.col("session_id").cast("string"))
    action = F.when(F.col("action") == "ERROR", F.lit("user_signal")).otherwise(F.col("action"))
    return signals.parse_actions(actions.withColumn("action", action), signals.vocabulary(spark), added)


@query
def custom_signals(spark, sf_dir):
    return _custom_actions(spark, sf_dir).select("session_id", "seq", "action", "weight", "known")


@query
def custom_signal_trace(spark, sf_dir):
    """Sessions through their own blueprints, their own signals included."""
    nodes, edges, _ = _custom_blueprints(spark, sf_dir)
    own = w.sessions(spark, sf_dir).select("session_id", F.col("session_id").cast("string").alias("blueprint"), "state")
    actions = _custom_actions(spark, sf_dir).where("known").drop("blueprint")
    found = states.session_state_trace(actions, own, nodes, edges)
    return found.select("session_id", "seq", "action", "state", "next_state")


@query
def custom_signal_profile(spark, sf_dir):
    """Profiles with the signals' own weights."""
    log, _ = signals.signal_guard(_custom_actions(spark, sf_dir))
    return _vector_ends(profiles.user_embeddings(log, w.items(spark, sf_dir)))


@query
def maximal_marginal_relevance(spark, sf_dir):
    asked, found = _latest_by_vector(spark, sf_dir)
    return shown(shared.handed_out(asked, mmr(found.withColumn("top_k_mmr", F.lit(4)), w.items(spark, sf_dir))))


@query
def maximal_marginal_relevance_most_similar(spark, sf_dir):
    asked, found = _latest_by_vector(spark, sf_dir)
    chosen = mmr(found.withColumn("top_k_mmr", F.lit(4)), w.items(spark, sf_dir), seed="most_similar")
    return shown(shared.handed_out(asked, chosen))


@query
def truncate_per_query(spark, sf_dir):
    unique = postprocess.remove_duplicates(latest_candidates(spark, sf_dir, together=True))
    ranked = postprocess.rank_candidates(unique).withColumn("top_k", F.lit(3))
    return shown(postprocess.truncate_per_query(ranked))


@query
def shuffle_pool(spark, sf_dir):
    unique = postprocess.remove_duplicates(latest_candidates(spark, sf_dir, together=True))
    return served(postprocess.shuffle_pool(unique, seed=5))


@query
def take_batch(spark, sf_dir):
    unique = postprocess.remove_duplicates(latest_candidates(spark, sf_dir, together=True))
    return served(postprocess.take_batch(postprocess.shuffle_pool(unique, seed=5), 10))


@query
def concat_results(spark, sf_dir):
    """Search results of the latest signals, followed by those of earlier ones."""
    all_items = w.items(spark, sf_dir)
    recent = w.latest_asked(spark, sf_dir, 4)
    found = stage(shared.by_vector(recent, w.item_vectors(all_items), partial(knn.knn_join, items=all_items)))
    late = shared.handed_out(recent.where("q_idx < 2"), found)
    early = shared.handed_out(recent.where("q_idx >= 2").withColumn("q_idx", F.col("q_idx") - 2), found)
    joined = postprocess.concat_results(late, early)
    return shown(postprocess.flatten_results(joined), "position")


@query
def concat_queries(spark, sf_dir):
    recent = w.latest_queries(spark, sf_dir).withColumn("batch_size", F.lit(10))
    late = recent.where("q_idx < 2")
    early = recent.where("q_idx >= 2").withColumn("q_idx", F.col("q_idx") - 2)
    return _vector_ends(postprocess.concat_queries(late, early))


# --- scalar and vector functions -------------------------------------------


def _pairs(spark, sf_dir) -> DataFrame:
    """Each item next to the one with the following id."""
    left = w.items(spark, sf_dir).select(F.col("id").alias("a"), F.col("embedding").alias("va"))
    right = w.items(spark, sf_dir).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"), F.col("embedding").alias("vb"))
    return left.join(right, "a")


@query
def vector_similarity(spark, sf_dir):
    va, vb = F.col("va"), F.col("vb")
    return _pairs(spark, sf_dir).select(
        "a",
        "b",
        F.round(V.dot(va, vb), 6).alias("dot"),
        F.round(V.cosine(va, vb), 6).alias("cosine"),
        F.round(V.euclidean(va, vb), 6).alias("euclidean"),
        F.round(V.l2_norm(va), 6).alias("norm"),
    )


@query
def vector_concat(spark, sf_dir):
    joined = V.vector_concat(F.col("va"), F.col("vb"))
    return _pairs(spark, sf_dir).select(
        V.concat_ids(F.col("a"), F.col("b")).alias("id"),
        F.size(joined).alias("dim"),
        F.round(joined[w.DIM].cast("double"), 6).alias("x"),
    )


@query
def random_queries(spark, sf_dir):
    return _vector_ends(profiles.random_profile(w.sessions(spark, sf_dir), w.DIM, 10, seed=1))


def _quantized(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    all_items = w.items(spark, sf_dir).select("id", "embedding")
    model = stage(quantize.train_scalar_quantizer(all_items))
    return quantize.quantize(all_items, model), model


@query
def quantize_scalar(spark, sf_dir):
    codes, _ = _quantized(spark, sf_dir)
    return codes.select("id", F.array_join("codes", ",").alias("codes"))


@query
def dequantize_scalar(spark, sf_dir):
    decoded = quantize.dequantize(*_quantized(spark, sf_dir))
    return decoded.select("id", F.posexplode("decoded").alias("pos", "x")).select("id", "pos", rounded("x"))


@query
def reconstruction_error(spark, sf_dir):
    found = quantize.reconstruction_error(quantize.dequantize(*_quantized(spark, sf_dir)))
    return found.select("vectors", rounded("mean_l1"), rounded("max_l1"))


def _product_coded(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    all_items = w.items(spark, sf_dir).select("id", "embedding")
    book = product.train_product_quantizer(all_items, n_slices=8, n_codes=16, rounds=5)
    return product.pq_encode(all_items, book), book


@query
def product_encode(spark, sf_dir):
    codes, _ = _product_coded(spark, sf_dir)
    return codes.select("id", F.array_join("codes", ",").alias("codes"), F.array_join("residual_codes", ",").alias("rest"))


@query
def product_decode(spark, sf_dir):
    found = quantize.reconstruction_error(product.pq_decode(*_product_coded(spark, sf_dir)))
    return found.select("vectors", rounded("mean_l1"), rounded("max_l1"))


@query
def sketch_collection(spark, sf_dir):
    codes, _ = sketch.sketch_collection(w.items(spark, sf_dir), "embeddings", seed=3)
    return codes.select("q_idx", "rank", "id", F.array_join("codes", ",").alias("codes"))


# --- batches ---------------------------------------------------------------


@query
def random_batch(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, "NAVIGABLE_UX", "Exploration")
    return served(batches.random_batch(asked, w.items(spark, sf_dir)))


@query
def personalized_batch(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, SIMPLE_BLUEPRINT, "Curated")
    return served(
        batches.personalized_batch(asked, w.profile(spark, sf_dir), w.items(spark, sf_dir), w.history(spark, sf_dir))
    )


@query
def personalized_batch_spread(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Focus")
    return served(
        batches.personalized_batch(
            asked,
            w.profile(spark, sf_dir),
            w.items(spark, sf_dir),
            w.history(spark, sf_dir),
            batches.Options(policy="spread"),
        )
    )


@query
def biased_batch(spark, sf_dir):
    all_items = w.items(spark, sf_dir)
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Welcome")
    found = batches.biased_batch(
        asked, w.profile(spark, sf_dir), w.bias(asked, all_items), all_items, w.history(spark, sf_dir)
    )
    return served(found)


@query
def sampled_batch(spark, sf_dir):
    all_items = w.items(spark, sf_dir)
    asked = w.requests_in(spark, sf_dir, "NAVIGABLE_UX", "Browsing")
    return served(batches.sampled_batch(asked, w.topics(all_items), all_items, w.history(spark, sf_dir)))


def _next_batch(spark, sf_dir, options: batches.Options = batches.Options()) -> tuple[DataFrame, DataFrame]:
    all_items = w.items(spark, sf_dir)
    nodes, edges = w.builtin(spark)
    current = stage(w.current_sessions(spark, sf_dir))
    return batches.next_batch(
        current,
        w.profile(spark, sf_dir),
        all_items,
        nodes,
        edges,
        w.topics(all_items),
        w.bias(current, all_items),
        w.history(spark, sf_dir),
        options,
    )


@query
def next_batch_indexed(spark, sf_dir):
    """The same result as ``next_batch``, searched through an index."""
    all_items = w.items(spark, sf_dir)
    index = ivf.build_index(all_items, ivf.train_cells(all_items, 16))
    found, _ = _next_batch(spark, sf_dir, batches.Options(search=partial(ivf.ivf_join, index=index)))
    return served(found)


@query
def next_batch(spark, sf_dir):
    found, _ = _next_batch(spark, sf_dir)
    return served(found)


def _recorded(spark, sf_dir, number: int) -> DataFrame:
    """The last of ``number`` batches in a row."""
    all_items = w.items(spark, sf_dir)
    current = stage(w.current_sessions(spark, sf_dir))
    path = new_table_path(spark, "progress")
    batches.create_progress(current, all_items, path)
    nodes, edges = w.builtin(spark)
    fixed = (nodes, edges, w.topics(all_items), w.bias(current, all_items), path)
    profile, seen = w.profile(spark, sf_dir), w.history(spark, sf_dir)
    found = None
    for batch_id in range(number):
        found = batches.recorded_next_batch(current, profile, all_items, *fixed, batch_id, seen)
    return found


@query
def next_batch_twice(spark, sf_dir):
    """The second of two batches: states have moved, what the first showed is left out."""
    return _recorded(spark, sf_dir, 2).select("session_id", "position", "id", rounded("score"), "label")


@query
def next_batch_requests(spark, sf_dir):
    nodes, edges = w.builtin(spark)
    asked = batches.plan_requests(w.current_sessions(spark, sf_dir), nodes, edges)
    return asked.select("session_id", "blueprint", "state", "batch_type", "next_state")


@query
def apply_params(spark, sf_dir):
    """The chain after the search, in one node's parameters."""
    params = {
        "threshold": F.lit(0.3),
        "apply_mmr": F.col("session_id") % 2 == 0,
        "remove_duplicates": F.col("session_id") % 3 != 0,
        "top_k_mmr": F.lit(4),
    }
    found = stage(latest_candidates(spark, sf_dir)).withColumns(params)
    pool = postprocess.apply_params(found, w.items(spark, sf_dir), seed=2)
    return pool.select("session_id", "q_idx", "rank", "position", "id", rounded("score"))


def _faulty_actions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Actions of which some name no item, for sessions of which some have no place."""
    parsed = w.parsed_actions(spark, sf_dir).withColumn("item_id", F.col("item_id") * (F.col("seq") % 13 + 1))
    routed = sessions.route_algorithm(w.sessions(spark, sf_dir)).where("session_id % 17 <> 3")
    blueprint = F.when(F.col("session_id") % 11 != 5, F.col("blueprint"))
    state = F.when(F.col("session_id") % 7 == 2, F.lit("nowhere")).otherwise(F.col("state"))
    return parsed, routed.withColumns({"blueprint": blueprint, "state": state})


@query
def rejected_actions(spark, sf_dir):
    parsed, routed = _faulty_actions(spark, sf_dir)
    return rejects.split_actions(parsed, routed, w.builtin(spark)[0], w.items(spark, sf_dir))[1]


@query
def accepted_state_trace(spark, sf_dir):
    """The trace of what is not rejected."""
    parsed, routed = _faulty_actions(spark, sf_dir)
    nodes, edges = w.builtin(spark)
    accepted, _ = rejects.split_actions(parsed, routed, nodes, w.items(spark, sf_dir))
    found = states.session_state_trace(stage(accepted), routed, nodes, edges)
    return found.select("session_id", "seq", "action", "state", "next_state", "batch_type")


# --- streaming -------------------------------------------------------------


def _action_stream(spark, sf_dir) -> DataFrame:
    schema = w.table(spark, sf_dir, "events").schema
    stream = events.read_stream(spark, sf_dir, schema, pathGlobFilter="events.parquet")
    return signals.parse_actions(w.events_as_actions(stream), signals.vocabulary(spark)).where("known")


@query
def dedup_signals(spark, sf_dir):
    """Every event arrives twice."""
    path = new_table_path(spark, "dedup")
    twice = _action_stream(spark, sf_dir).unionByName(_action_stream(spark, sf_dir))
    events.run_available(twice, events.Arrivals(path, "seq"), "dedup")
    return spark.read.parquet(f"{path}/accepted").select("session_id", "seq", "action")


@query
def dedup_watermark(spark, sf_dir):
    """Every event arrives twice, and the stream itself forgets what is older than its watermark."""
    path = new_table_path(spark, "dedup")
    twice = _action_stream(spark, sf_dir).unionByName(_action_stream(spark, sf_dir))
    events.run_available(events.dedup_signals(twice, "seq"), events.table_sink(path), "dedup")
    return spark.read.parquet(path).select("session_id", "seq", "action")


@query
def arrival_verdicts(spark, sf_dir):
    """Events that come in four runs of a job, some of them a run or two late, some of them twice."""
    log = w.table(spark, sf_dir, "events").withColumn("run", F.floor((F.dayofmonth("ts") - 1) / 8).cast("int"))
    late = log.withColumn("run", F.least(F.col("run") + F.when(F.col("event_id") % 7 == 0, 2).when(F.col("event_id") % 3 == 0, 1).otherwise(0), F.lit(3)))
    again = late.where("event_id % 5 = 0").withColumn("run", F.least(F.col("run") + 1, F.lit(3)))
    arriving = stage(late.unionByName(again))
    path, source, progress = (new_table_path(spark, name) for name in ("arrivals", "arriving", "arrivals-progress"))
    for run in range(4):
        arriving.where(F.col("run") == run).write.mode("append").parquet(source)
        stream = events.read_stream(spark, source, arriving.schema)
        events.run_available(stream, events.Arrivals(path, "event_id", lateness="6 DAYS"), "arrivals", progress)
    rows = [spark.read.parquet(f"{path}/{name}") for name in ("accepted", "rejects")]
    both = rows[0].withColumn("reason", F.lit("accepted")).unionByName(rows[1])
    return both.select(F.col("event_id").alias("seq"), F.col("batch_id").cast("int").alias("run"), "reason")


@query
def signal_stream(spark, sf_dir):
    nodes, edges = w.builtin(spark)
    routed = sessions.route_algorithm(w.sessions(spark, sf_dir))
    path = new_table_path(spark, "fold")
    tables = fold.signal_stream(_action_stream(spark, sf_dir), stage(routed), w.items(spark, sf_dir), nodes, edges, path)
    steps = tables.read(spark, "steps")
    return steps.select("session_id", "seq", "action", "state", "next_state", "has_embeddings", "profile_size")


def _faulty_fold(spark, sf_dir) -> serving.Tables:
    """The stream of actions of which some cannot be carried out."""
    schema = w.table(spark, sf_dir, "events").schema
    stream = events.read_stream(spark, sf_dir, schema, pathGlobFilter="events.parquet")
    parsed = signals.parse_actions(w.events_as_actions(stream), signals.vocabulary(spark))
    _, routed = _faulty_actions(spark, sf_dir)
    parsed = parsed.withColumn("item_id", F.col("item_id") * (F.col("seq") % 13 + 1))
    nodes, edges = w.builtin(spark)
    return fold.signal_stream(parsed, stage(routed), w.items(spark, sf_dir), nodes, edges, new_table_path(spark, "fold"))


@query
def signal_stream_accepted(spark, sf_dir):
    """States of a stream that holds actions that cannot be carried out."""
    steps = _faulty_fold(spark, sf_dir).read(spark, "steps")
    return steps.select("session_id", "seq", "action", "state", "next_state")


@query
def signal_stream_rejects(spark, sf_dir):
    """Actions of the stream that cannot be carried out."""
    return _faulty_fold(spark, sf_dir).read(spark, "rejects").select("session_id", "seq", "reason")


@lru_cache(maxsize=1)
def _serving_tables(spark, sf_dir) -> serving.Tables:
    """What one run of the serving stream has written."""
    all_items = w.items(spark, sf_dir)
    nodes, edges = w.builtin(spark)
    routed = stage(sessions.route_algorithm(w.sessions(spark, sf_dir)))
    tables = serving.Tables(new_table_path(spark, "serving")).create(spark)
    server = serving.Server(
        tables, routed, all_items, nodes, edges, w.topics(all_items), w.bias(routed, all_items)
    )
    events.run_available(_action_stream(spark, sf_dir), server, "serving")
    return tables


@query
def update_state(spark, sf_dir):
    """States after the stream; answers don't move them, so that none are worked out."""
    routed, path = stage(sessions.route_algorithm(w.sessions(spark, sf_dir))), new_table_path(spark, "fold")
    tables = fold.signal_stream(_action_stream(spark, sf_dir), routed, w.items(spark, sf_dir), *w.builtin(spark), path, steps=False)
    return serving.latest_states(tables.read(spark, "states")).select("session_id", "state", "has_embeddings")


@query
def batch_stream(spark, sf_dir):
    """The answer to every request of the stream, each without what the session was given before."""
    answers = _serving_tables(spark, sf_dir).read(spark, "served")
    return answers.select(serving.request_key().alias("request"), "position", "id", rounded("score"))


@query
def stream_requests(spark, sf_dir):
    """All requests of the stream; an empty pool is an empty batch."""
    asked = _serving_tables(spark, sf_dir).read(spark, "requests")
    return asked.select(serving.request_key().alias("request"), "state", "batch_type", "n_served")
