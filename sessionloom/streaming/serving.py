"""Streams that fold and serve: micro-batches move states, keep history and answer requests.

State lives in tables in shared storage, one folder per micro-batch, so that a
repeated micro-batch replaces what its first try wrote:

``states``   node of each session the micro-batch touched, and its number of signals
``snapshots`` now and then, the node of every session so far
``newest``   the time of the micro-batch's last signal
``steps``    if wanted, each action with the states before and after it
``signals``  its signals
``served``   the batches it served, one for each request
``requests`` the requests it answered, with the number of items served
``rejects``  actions that were not carried out, each with its reason
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import USER_EMBEDDINGS_LAST_N, release, stage
from sessionloom.functions import vectors as V
from sessionloom.operators.knn import knn_join
from sessionloom.operators.postprocess import remove_duplicates, shuffle_pool, take_batch
from sessionloom.operators.profiles import profile_depth
from sessionloom.operators.running import running_sums
from sessionloom.operators.skew import balanced_join
from sessionloom.operators.states import session_state_trace
from sessionloom.plans.batches import Options, left_to_chance, random_batch_queries, request_queries
from sessionloom.sources.items import embedding_width
from sessionloom.sources.rejects import LATE, NO_BIAS, checked_actions
from sessionloom.sources.signals import BATCH
from sessionloom.streaming.lists import REQUEST, answer_from_lists, shared_lists, vector_name
from sessionloom.streaming.turns import TURNS, answer_in_turn

#: Numbers in the random vectors, and requests with searches of their own, of one slice.
CHANCE_FLOATS = 1 << 24
OWN_REQUESTS = 1 << 15

SCHEMAS = {
    "states": "session_id {session}, state string, has_embeddings boolean, n_signals long",
    "snapshots": "session_id {session}, state string, has_embeddings boolean, n_signals long",
    "steps": "session_id {session}, ts timestamp, seq long, action string, state string, next_state string, has_embeddings boolean, profile_size int",
    "newest": "ts timestamp",
    "signals": "session_id {session}, ts timestamp, seq long, label string, weight double, item_id {item}",
    "served": "session_id {session}, ts timestamp, seq long, position int, id {item}, score double, q_idx int",
    "requests": "session_id {session}, ts timestamp, seq long, state string, batch_type string, n_served int, problem string",
    "rejects": "session_id {session}, ts timestamp, seq long, action string, reason string",
}


@dataclass
class Tables:
    """The tables of one serving stream; ids of sessions and items are of the given types."""

    root: str
    session: str = "long"
    item: str = "long"

    def schema(self, name: str) -> str:
        return SCHEMAS[name].format(session=self.session, item=self.item)

    def read(self, spark: SparkSession, name: str, before: int | None = None) -> DataFrame:
        """Rows of all micro-batches, or of those before one."""
        written = spark.read.schema(self.schema(name) + ", batch_id int").option("basePath", f"{self.root}/{name}")
        rows = written.option("ignoreMissingFiles", "true").parquet(f"{self.root}/{name}")
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def create(self, spark: SparkSession) -> "Tables":
        """Empty tables, as micro-batch -1."""
        for name in SCHEMAS:
            self.write(spark.createDataFrame([], self.schema(name)).coalesce(1), name, -1)
        return self


def latest_states(states: DataFrame) -> DataFrame:
    """One row per session: what the last micro-batch that touched it left."""
    return states.groupBy("session_id").agg(
        *(F.max_by(c, "batch_id").alias(c) for c in ("state", "has_embeddings", "n_signals"))
    )


def states_before(spark: SparkSession, tables: Tables, batch_id: int, touched: DataFrame | None = None) -> DataFrame:
    """States before a micro-batch, of ``touched`` sessions or of all.

    Read from the last snapshot and the micro-batches after it.
    """
    snapshots = tables.read(spark, "snapshots", before=batch_id)
    # Of the folders' names only.
    last = snapshots.agg(F.max("batch_id")).first()[0]
    last = -1 if last is None else last
    recent = tables.read(spark, "states", before=batch_id).where(F.col("batch_id") > last)
    rows = snapshots.where(F.col("batch_id") == last).unionByName(recent)
    return latest_states(rows if touched is None else rows.join(touched, "session_id", "left_semi"))


def compact_states(spark: SparkSession, tables: Tables, upto: int, target: "Tables") -> None:
    """Write the states after micro-batch ``upto`` as the start of new tables."""
    target.write(latest_states(tables.read(spark, "states", before=upto + 1)), "states", -1)


def update_states(tables: Tables, trace: DataFrame, previous: DataFrame, batch_id: int) -> None:
    """Write the new state of every session in the micro-batch's trace."""
    new = trace.groupBy("session_id").agg(
        F.max_by("next_state", F.struct("ts", "seq")).alias("state"),
        F.sum((F.col("action") != BATCH).cast("long")).alias("signalled"),
    )
    known = previous.select("session_id", F.col("n_signals").alias("before"))
    n_signals = F.col("signalled") + F.coalesce("before", F.lit(0))
    merged = new.join(known, "session_id", "left").withColumn("n_signals", n_signals)
    tables.write(merged.select("session_id", "state", (F.col("n_signals") > 0).alias("has_embeddings"), "n_signals"), "states", batch_id)


class Fold:
    """Handles one micro-batch of ``actions(session_id, ts, seq, action, weight, item_id)``:
    each action moves its session's state.

    Actions that can't be carried out go to ``rejects`` before any state moves; ``known``
    and ``is_batch`` are taken from the actions where they have them. A session of any
    size is spread over as many partitions as it fills, and states lie in tables, so
    that no task holds a session. ``steps`` tells whether every action is written down.
    """

    def __init__(
        self,
        tables: Tables,
        sessions: DataFrame,
        items: DataFrame,
        nodes: DataFrame,
        edges: DataFrame,
        lateness: str | None = None,
        snapshot_every: int = 32,
        steps: bool = True,
    ):
        self.tables, self.sessions, self.items, self.nodes, self.edges = tables, sessions, items, nodes, edges
        self.lateness, self.snapshot_every, self.steps = lateness, snapshot_every, steps

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tables = batch.sparkSession, self.tables
        actions = stage(batch)
        touched = stage(actions.select("session_id").distinct())
        previous = stage(states_before(spark, tables, batch_id, touched))
        known = previous.select("session_id", F.col("state").alias("_state"))
        current = self.sessions.join(touched, "session_id", "left_semi").join(known, "session_id", "left")
        current = stage(current.withColumn("state", F.coalesce("_state", "state")).drop("_state"))
        actions = self.accepted(actions, current, batch_id)
        trace = stage(session_state_trace(actions, current, self.nodes, self.edges))
        new_signals = actions.where(F.col("action") != BATCH).withColumnRenamed("action", "label")
        tables.write(new_signals.select("session_id", "ts", "seq", "label", "weight", "item_id"), "signals", batch_id)
        if self.steps:
            self.write_steps(trace, previous, batch_id)
        self.answer(trace, actions, batch_id)
        update_states(tables, trace, previous, batch_id)
        tables.write(new_signals.agg(F.max("ts").alias("ts")), "newest", batch_id)
        if (batch_id + 1) % self.snapshot_every == 0:
            tables.write(states_before(spark, tables, batch_id + 1), "snapshots", batch_id)

    def accepted(self, actions: DataFrame, current: DataFrame, batch_id: int) -> DataFrame:
        """Set aside actions that can't be carried out, and those older than the newest
        signal of earlier micro-batches allows."""
        is_batch = F.upper("action") == BATCH
        for name, value in (("is_batch", is_batch), ("known", is_batch | F.col("weight").isNotNull())):
            if name not in actions.columns:
                actions = actions.withColumn(name, F.coalesce(value, F.lit(False)))
        checked = checked_actions(actions, current, self.nodes, self.items)
        oldest = self.oldest(actions.sparkSession, batch_id)
        if oldest is not None:
            checked = checked.withColumn("reason", F.coalesce("reason", F.when(F.col("ts") < oldest, LATE)))
        checked = stage(checked)
        self.tables.write(checked.where("reason IS NOT NULL").select("session_id", "ts", "seq", "action", "reason"), "rejects", batch_id)
        return checked.where("reason IS NULL").drop("reason")

    def oldest(self, spark: SparkSession, batch_id: int):
        """The time before which actions come too late, if lateness is limited."""
        if self.lateness is None:
            return None
        newest = self.tables.read(spark, "newest", before=batch_id).agg(F.max("ts")).first()[0]
        return None if newest is None else F.lit(newest) - F.expr(f"INTERVAL {self.lateness}")

    def write_steps(self, trace: DataFrame, previous: DataFrame, batch_id: int) -> None:
        """Each action with the states around it and the profile it leaves behind."""
        signal = (F.col("action") != BATCH).cast("long")
        steps = trace.select("session_id", "ts", "seq", "action", "state", "next_state")
        steps = running_sums(steps, ["session_id"], ["ts", "seq"], {"_seen": signal})
        steps = balanced_join(steps, previous.select("session_id", F.col("n_signals").alias("_before")), "session_id", ["seq"], "left")
        seen = F.col("_seen") + F.coalesce("_before", F.lit(0))
        size = F.least(seen + signal, F.lit(profile_depth(self.nodes))).cast("int")
        steps = steps.withColumns({"has_embeddings": seen > 0, "profile_size": size}).drop("_seen", "_before")
        self.tables.write(steps, "steps", batch_id)

    def answer(self, trace: DataFrame, actions: DataFrame, batch_id: int) -> None:
        """What is asked for in the micro-batch: nothing here."""


class Server(Fold):
    """A fold that also serves: every request is answered, as of its own time.

    It is answered from the session's node and signals at that time, without what those
    signals or its earlier requests have shown, in this micro-batch or before. So answers don't
    depend on how the stream is cut, as long as no action comes in a later
    micro-batch than one that follows it. A column ``batch_size`` of the actions sets the
    size of single batches.
    """

    def __init__(
        self,
        tables: Tables,
        sessions: DataFrame,
        items: DataFrame,
        nodes: DataFrame,
        edges: DataFrame,
        topics: DataFrame,
        bias: DataFrame,
        options: Options = Options(),
        lateness: str | None = None,
        snapshot_every: int = 32,
        steps: bool = False,
    ):
        super().__init__(tables, sessions, items, nodes, edges, lateness, snapshot_every, steps)
        self.topics, self.bias, self.options = topics, bias, options

    def answer(self, trace: DataFrame, actions: DataFrame, batch_id: int) -> None:
        """A batch for each request; a request is known by its session and number."""
        spark, tables, options = trace.sparkSession, self.tables, self.options
        asked = trace.where(F.col("action") == BATCH).select("session_id", "ts", "seq", "state", "batch_type", "params", request_key().alias("request"))
        size = F.lit(options.batch_size)
        if "batch_size" in actions.columns:
            own = actions.select("session_id", "ts", "seq", F.col("batch_size").alias("_size"))
            asked = asked.join(own, ["session_id", "ts", "seq"])
            size = F.coalesce("_size", size)
        asked = stage(asked.withColumn("batch_size", size.cast("int")).drop("_size"))
        asking = stage(asked.select("session_id").distinct())
        values = self.items.select(F.col("id").alias("item_id"), "history_value")

        log = tables.read(spark, "signals", before=batch_id + 1).join(asking, "session_id", "left_semi")
        signals, requests = self.in_order(log, asked)
        signals = stage(signals.join(values, "item_id", "left"))
        served = tables.read(spark, "served", before=batch_id).join(asking, "session_id", "left_semi")
        shown = stage(served.select("session_id", F.col("id").alias("item_id")).join(values, "item_id").select("session_id", "history_value"))
        with_bias = asked.where("batch_type = 'biased'").select("session_id").distinct()
        biased = stage(self.bias.join(with_bias, "session_id", "left_semi"))

        chance = F.coalesce(left_to_chance(), F.lit(False))
        requests = stage(requests.withColumn("has_embeddings", F.col("seen") > 0).withColumn("chance", chance))
        release(spark)
        answers = self.by_chance(requests.where("chance"))
        waiting = stage(requests.where("NOT chance"))
        queries, lists = self.from_lists(waiting, signals, biased)
        while not waiting.isEmpty():
            if lists is not None:
                known = self.hidden(signals, answers, values, shown)
                answers.append(stage(answer_from_lists(waiting, queries, known, self.items, lists, options)))
                waiting = self.unanswered(waiting, answers[-1:])
            # The next requests of sessions whose lists have run out.
            found = self.by_own_search(waiting, signals, biased, self.hidden(signals, answers, values), shown)
            answers, waiting = answers + found, self.unanswered(waiting, found)
        if lists is not None:
            lists.destroy()
        columns = ["session_id", "ts", "seq", "position", "id", "score", "q_idx"]
        empty = spark.createDataFrame([], tables.schema("served"))
        tables.write(reduce(DataFrame.unionByName, [a.where("position > 0").select(*columns) for a in answers], empty), "served", batch_id)
        sizes = tables.read(spark, "served").where(F.col("batch_id") == batch_id)
        sizes = sizes.groupBy("session_id", "ts", "seq").agg(F.count(F.lit(1)).cast("int").alias("n"))
        answered = asked.join(sizes, ["session_id", "ts", "seq"], "left").withColumn("n_served", F.coalesce("n", F.lit(0)))
        answered = answered.join(biased.select("session_id", F.lit(True).alias("_bias")).distinct(), "session_id", "left")
        problem = F.when((F.col("batch_type") == "biased") & F.col("_bias").isNull(), NO_BIAS)
        answered = answered.withColumn("problem", problem)
        tables.write(answered.select("session_id", "ts", "seq", "state", "batch_type", "n_served", "problem"), "requests", batch_id)

    def in_order(self, log: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Signals with their ``number`` in the session, requests with how many signals they have ``seen``,
        and both with the ``clock`` of the session's signals and requests together."""
        is_request = F.col("request").isNotNull()
        rows = log.select("session_id", "ts", "seq", "item_id", "weight").unionByName(asked, allowMissingColumns=True)
        counted = {"clock": F.lit(1), "seen": (~is_request).cast("long")}
        rows = stage(running_sums(rows, ["session_id"], ["ts", "seq"], counted))
        signals = rows.where(~is_request).select("session_id", F.col("seen").alias("number"), "clock", "item_id", "weight")
        return signals, rows.where(is_request).select(*asked.columns, "clock", "seen")

    def hidden(self, signals: DataFrame, answers: list[DataFrame], values: DataFrame, shown: DataFrame | None = None) -> DataFrame:
        """``(session_id, clock, history_value)``: what a session signals and is given, and when."""
        given = [a.where("position > 0").select("session_id", "clock", F.col("id").alias("item_id")) for a in answers]
        given = [g.join(values, "item_id") for g in given]
        if shown is not None:
            given.append(shown.withColumn("clock", F.lit(-1).cast("long")))
        columns = ["session_id", "clock", "history_value"]
        return reduce(DataFrame.unionByName, [x.select(*columns) for x in [signals, *given]])

    def unanswered(self, waiting: DataFrame, answers: list[DataFrame]) -> DataFrame:
        for a in answers:
            waiting = waiting.join(a.where("position = 0").select("session_id", "clock"), ["session_id", "clock"], "left_anti")
        return stage(waiting) if answers else waiting

    def by_chance(self, requests: DataFrame) -> list[DataFrame]:
        """Answers to requests of random vectors, which take no notice of the session, slice by slice."""
        width, size = embedding_width(self.items), self.options.batch_size
        numbers = (requests.agg(F.sum(F.col("batch_size").cast("long"))).first()[0] or 0) * width
        slices, answers = math.ceil(numbers / CHANCE_FLOATS), []
        for k in range(slices):
            own = requests.where(F.pmod(F.xxhash64("request"), F.lit(slices)) == k)
            asked = own.select(F.col("request").alias("session_id"), "params", "batch_size")
            found = self.search()(stage(random_batch_queries(asked, width, size, self.options.seed)), exclude=None)
            found = found.where(F.col("id").isNotNull()).select("session_id", "q_idx", "rank", "id", "score", "remove_duplicates", "batch_size")
            pool = shuffle_pool(remove_duplicates(found.repartition("session_id")), self.options.seed)
            batch = take_batch(pool, F.col("batch_size")).select(F.col("session_id").alias("request"), "position", "id", "score", "q_idx")
            answers.append(stage(own.select(*REQUEST).join(batch, "request")))
            release(requests.sparkSession)
        return answers

    def from_lists(self, waiting: DataFrame, signals: DataFrame, biased: DataFrame) -> tuple[DataFrame | None, Broadcast | None]:
        """All requests' queries by vectors' names, and the vectors' lists; none where vectors are
        made for a request, or too many."""
        if self.options.policy != "plain":
            return None, None
        queries = stage(self.queries(waiting, signals, biased, vector_name))
        signalled = self.items.join(signals.select(F.col("item_id").alias("id")).distinct(), "id", "left_semi")
        vectors = [x.select(vector_name("embedding").alias("name"), V.as_double("embedding").alias("embedding")) for x in (signalled, self.topics, biased)]
        return queries, shared_lists(queries, reduce(DataFrame.unionByName, vectors), self.items, self.search(), self.options.metric)

    def by_own_search(self, waiting: DataFrame, signals: DataFrame, biased: DataFrame, hidden: DataFrame, shown: DataFrame) -> list[DataFrame]:
        """Answers to the next requests of each session, slice by slice."""
        turn = running_sums(waiting, ["session_id"], ["clock"], {"place": F.lit(1)})
        turn = stage(turn.withColumn("place", F.col("place").cast("int")).where(F.col("place") < TURNS))
        slices, answers = math.ceil(turn.count() / OWN_REQUESTS), []
        for k in range(slices):
            here = F.pmod(F.xxhash64("session_id"), F.lit(slices)) == k
            found = self.answers(stage(turn.where(here)), *(x.where(here) for x in (signals, biased, hidden, shown)))
            answers.append(stage(found.join(turn.where(here).select(*REQUEST), "request")))
            if slices > 1:
                release(turn.sparkSession)
        return answers

    def search(self):
        return self.options.search or partial(knn_join, items=self.items, metric=self.options.metric)

    def queries(self, turn: DataFrame, signals: DataFrame, bias: DataFrame, vector) -> DataFrame:
        """Queries of requests; ``vector`` makes what stands for a vector of its column."""
        # What the request's node looks at, where it looks at signals.
        depth = F.when(F.col("params.last_n") > 0, F.col("params.last_n")).otherwise(USER_EMBEDDINGS_LAST_N)
        numbers = F.sequence(F.greatest(F.col("seen") - depth, F.lit(0)), F.col("seen") - 1)
        looking = turn.where("seen > 0 AND batch_type IN ('personalized', 'biased')")
        latest = looking.select("request", "session_id", "seen", F.explode(numbers).alias("number"))
        latest = latest.join(signals, ["session_id", "number"])
        wanted = signals.select("item_id").distinct()
        vectors = self.items.select(F.col("id").alias("item_id"), vector("embedding").alias("embedding")).join(wanted, "item_id", "left_semi")
        place = (F.col("seen") - 1 - F.col("number")).cast("int")
        # Many requests look at a popular item.
        latest = balanced_join(latest.select("request", place.alias("q_idx"), "item_id", "weight"), vectors, "item_id", ["request", "q_idx"])
        profile = stage(latest.select(F.col("request").alias("session_id"), "q_idx", "embedding", "weight"))
        own = turn.select(F.col("request").alias("session_id"), "batch_type", "params", "batch_size", "has_embeddings")
        by_request = bias.withColumn("embedding", vector("embedding"))
        by_request = by_request.join(turn.where("batch_type = 'biased'").select("session_id", "request"), "session_id")
        by_request = by_request.drop("session_id").withColumnRenamed("request", "session_id")
        topics = self.topics.withColumn("embedding", vector("embedding"))
        return request_queries(stage(own), profile, self.items, topics, by_request, self.options)

    def answers(self, turn: DataFrame, signals: DataFrame, bias: DataFrame, hidden: DataFrame, shown: DataFrame) -> DataFrame:
        """Answers to the next requests of each session."""
        queries = self.queries(turn, signals, bias, F.col)
        if self.options.metric != "cosine_sim":
            queries = queries.withColumn("query_embedding", F.col("embedding"))
        requests = turn.select("session_id", "request", "place", F.col("clock").alias("seen"), "chance", "batch_size")
        hidden = hidden.withColumnRenamed("clock", "number")
        return answer_in_turn(requests, queries.withColumnRenamed("session_id", "request").drop("batch_size"), hidden, shown, self.items, self.search(), self.options)


def request_key():
    """A request as text: session and number."""
    return F.concat_ws(":", F.col("session_id").cast("string"), F.col("seq").cast("string"))
