"""Query vectors of a request: from signals, bias vectors, topics or chance.

All results are ``queries(session_id, q_idx, embedding, weight)``.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.config import SCORE_DECIMALS, USER_EMBEDDINGS_LAST_N, broadcast_if_small, default_parallelism, local_table
from sessionloom.functions import vectors as V
from sessionloom.functions.permutations import permuted, pivots

POLICIES = ("plain", "spread")

# Topic vectors up to which the topic table is broadcast.
MAX_LOCAL_TOPICS = 2048


def latest_signals(signals_log: DataFrame, last_n: int = USER_EMBEDDINGS_LAST_N) -> DataFrame:
    """Each session's most recent signals, numbered from the latest (``q_idx`` 0)."""
    newest = Window.partitionBy("session_id").orderBy(F.desc("ts"), F.desc("seq"))
    numbered = signals_log.withColumn("q_idx", F.row_number().over(newest))
    # The filter on the window's own column lets Spark keep last_n rows per
    # session before the shuffle.
    return numbered.where(F.col("q_idx") <= last_n).withColumn("q_idx", F.col("q_idx") - 1)


def profile_depth(nodes: DataFrame) -> int:
    """How many signals profiles have to hold for the nodes: the most any node looks at."""
    asked = nodes.agg(F.max("params.last_n")).first()[0] or 0
    return max(USER_EMBEDDINGS_LAST_N, asked)


def user_embeddings(signals_log: DataFrame, items: DataFrame, last_n: int = USER_EMBEDDINGS_LAST_N) -> DataFrame:
    """The session's profile: vectors and weights of its latest signals."""
    vectors = items.select(F.col("id").alias("item_id"), "embedding")
    # Popular items skew this join; adaptive execution splits their partitions.
    joined = latest_signals(signals_log, last_n).join(vectors, "item_id")
    return joined.select("session_id", "q_idx", "embedding", "weight")


def personalized_profile(
    profile: DataFrame,
    requests: DataFrame,
    policy: str = "plain",
    centroid: DataFrame | None = None,
    dim: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The part of a profile a node looks at: ``requests(session_id, params)``.

    ``last_n`` = 0 means the default length; more than the profile holds is not
    there (``profile_depth`` tells how long it has to be). Policy ``plain`` takes the vectors as
    they are; ``spread`` moves them towards the collection's ``centroid`` by
    ``mu``, evens out weights by ``alpha`` and adds a share ``r`` of random vectors.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    last_n = F.col("params.last_n")
    wanted = F.when(last_n > 0, last_n).otherwise(USER_EMBEDDINGS_LAST_N)
    rows = profile.join(requests.select("session_id", "params"), "session_id").where(F.col("q_idx") < wanted)
    if policy == "plain":
        return rows.select("session_id", "q_idx", "embedding", "weight")

    mu = F.col("params.mu")
    pulled = F.zip_with("embedding", "centroid", lambda x, c: (1 - mu) * x.cast("double") + mu * c)
    weight = F.round(F.pow("weight", 1 - F.col("params.alpha")), SCORE_DECIMALS)
    # The centroid is one row; a constant key attaches it to every vector.
    one = F.lit(1).alias("_one")
    own = rows.select("*", one).join(F.broadcast(centroid.limit(1).select("*", one)), "_one").select(
        "session_id", "q_idx", V.unit(pulled).alias("embedding"), weight.alias("weight"), "params"
    )
    totals = own.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("q_idx").alias("last"),
        F.avg("weight").alias("weight"),
        F.first("params.r").alias("r"),
    )
    extra = F.ceil(F.col("r") * F.col("n")).cast("int")
    added = totals.where(extra > 0).withColumn("i", F.explode(F.sequence(F.lit(1), extra)))
    added = added.withColumn("q_idx", (F.col("last") + F.col("i")).cast("int"))
    vector = V.random_unit_vector(dim, seed, F.col("session_id"), F.col("q_idx"))
    return own.drop("params").unionByName(added.select("session_id", "q_idx", vector.alias("embedding"), "weight"))


def biased_profile(profile: DataFrame, bias: DataFrame) -> DataFrame:
    """Profile plus the caller's bias vectors ``(session_id, bias_idx, embedding, weight)``.

    Bias queries are numbered after the profile's; a session without a profile
    has its bias alone.
    """
    biased = bias.select("session_id").distinct()
    return profile.join(biased, "session_id", "left_semi").unionByName(numbered_bias(profile, bias))


def numbered_bias(profile: DataFrame, bias: DataFrame) -> DataFrame:
    """The bias queries, numbered on from the end of each session's profile."""
    length = profile.groupBy("session_id").agg((F.max("q_idx") + 1).alias("_base"))
    number = (F.coalesce("_base", F.lit(0)) + F.col("bias_idx")).cast("int")
    numbered = bias.join(length, "session_id", "left").withColumn("q_idx", number)
    return numbered.select("session_id", "q_idx", "embedding", "weight")


def missing_bias(requests: DataFrame, bias: DataFrame) -> DataFrame:
    """Requests for a biased batch that came without bias vectors: rejected."""
    return requests.join(bias.select("session_id").distinct(), "session_id", "left_anti")


def label_topics(items: DataFrame, label_col: str) -> DataFrame:
    """One topic per label: the mean vector, numbered in label order."""
    mean = Summarizer.mean(array_to_vector("embedding"))
    topics = items.groupBy(label_col).agg(vector_to_array(mean).alias("embedding"))
    # One row per label.
    number = F.row_number().over(Window.orderBy(label_col)) - 1
    rounded = F.transform("embedding", lambda x: F.round(x, SCORE_DECIMALS))
    return topics.select(number.alias("topic"), rounded.alias("embedding"))


def kmeans_topics(items: DataFrame, k: int, seed: int = 0, max_iter: int = 20) -> DataFrame:
    """Topics as the centres of a k-means clustering of the collection."""
    points = items.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter).fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return local_table(items.sparkSession, rows, "topic int, embedding array<double>")


def collection_centroid(items: DataFrame) -> DataFrame:
    mean = items.agg(vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("centroid"))
    return mean.select(F.transform("centroid", lambda x: F.round(x, SCORE_DECIMALS)).alias("centroid"))


def sampled_profile(requests: DataFrame, topics: DataFrame, seed: int = 0) -> DataFrame:
    """``n_topics`` different topics per request, weight 1; all topics if there are no more.

    ``requests(session_id, n_topics)``, ``topics(topic, embedding)`` numbered from 0. A
    session's draw is the beginning of its own permutation of the topics, worked out place
    by place, so a request costs what it draws, however many topics there are.
    """
    n = topics.count()
    topics = broadcast_if_small(topics, MAX_LOCAL_TOPICS)
    prefix = F.concat_ws(":", F.lit(str(seed)), F.col("session_id").cast("string"))
    wanted = F.when(F.col("n_topics") > n, n).otherwise(F.col("n_topics"))
    asked = requests.where(wanted > 0).select("session_id", wanted.alias("_n"), pivots(prefix, max(n, 1)).alias("_pivots"))
    places = asked.select("session_id", "_pivots", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("q_idx"))
    drawn = places.select("session_id", "q_idx", permuted(F.col("q_idx"), F.col("_pivots"), prefix, max(n, 1)).alias("topic"))
    return drawn.join(topics, "topic").select("session_id", "q_idx", "embedding", F.lit(1.0).alias("weight"))


def random_profile(
    requests: DataFrame, dim: int, n: int | Column, seed: int = 0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``n`` random unit vectors for each request; ``keep`` names request columns to carry."""
    # A request is a short row but much work: spread it before it grows.
    spread = requests.repartition(default_parallelism(requests.sparkSession), "session_id")
    last = (n if isinstance(n, Column) else F.lit(n)).cast("int") - 1
    rows = spread.select("session_id", *keep, F.explode(F.sequence(F.lit(0), last)).alias("q_idx"))
    drawn = rows.withColumn("_u", V.uniforms(dim, seed, F.col("session_id"), F.col("q_idx")))
    return drawn.select("session_id", "q_idx", V.unit(F.col("_u")).alias("embedding"), F.lit(1.0).alias("weight"), *keep)


def random_queries(spark: SparkSession, n: int, dim: int, top_k: int, seed: int = 0) -> DataFrame:
    """One request of ``n`` random unit vectors, independent of any session."""
    request = spark.range(1).select(F.col("id").alias("session_id"))
    rows = random_profile(request, dim, n, seed)
    return rows.withColumn("top_k", F.lit(top_k)).withColumn("top_k_mmr", F.lit(top_k // 2))
