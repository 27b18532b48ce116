"""Answers to a session's requests from lists that all sessions have in common.

Requests look at signalled items, topics and bias vectors, so that their queries are far more
than their different vectors. Each vector is searched once, for all sessions, and every task
is given all lists; then each session's requests go one after the other through them, leaving
out what the session has signalled or been given by then. Candidates are not moved at all, and
a session of any length passes its task as a stream. A request whose list runs out stops
its session: it needs a search of its own (``turns``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionloom.config import default_parallelism, stage
from sessionloom.functions import vectors as V
from sessionloom.operators.knn import matrix, unit_rows
from sessionloom.sources.items import embedding_width
from sessionloom.streaming import turns

#: Entries of all lists, and numbers in the vectors of those to be diversified, up to which
#: every task is given them.
LIST_ENTRIES = 1 << 21
LIST_FLOATS = 1 << 23

#: What an answer says of its request; ``clock`` counts the session's signals and requests before it.
REQUEST = ["session_id", "clock", "ts", "seq", "request"]

_HIDDEN, _REQUEST, _QUERY = 0, 1, 2


def vector_name(embedding):
    """A name that equal vectors share; a broken vector has none, and finds nothing."""
    v = V.as_double(embedding)
    return F.when(V.finite(v), F.concat_ws(":", F.xxhash64(v), F.xxhash64(F.lit(1), v)))


class Lists:
    """The candidates of each vector, as Python workers hold them."""

    def __init__(self, found: pa.Table, lengths: dict, vectors: pa.Table, queries: pa.Table):
        found = found.sort_by([("name", "ascending"), ("rank", "ascending")])
        names = found["name"].to_pylist()
        starts = [k for k, x in enumerate(names) if not k or names[k - 1] != x]
        # Where a vector's list is, and whether there may be more than it holds.
        self.of = {names[a]: (a, b, b - a >= lengths[names[a]]) for a, b in zip(starts, [*starts[1:], len(names)])}
        self.ids, self.values, self.scores = found["id"].to_pylist(), found["value"].to_pylist(), found["score"].to_numpy()
        self.every_value = set(self.values)
        self.vector_of = {x: k for k, x in enumerate(vectors["id"].to_pylist())}
        self.vectors = unit_rows(matrix(vectors["embedding"])) if vectors.num_rows else None
        self.queries = dict(zip(queries["name"].to_pylist(), unit_rows(matrix(queries["embedding"])))) if queries.num_rows else {}


def shared_lists(queries: DataFrame, vectors: DataFrame, items: DataFrame, search, metric: str) -> Broadcast | None:
    """Lists for the named vectors of ``queries``, or none if they are too many for a task.

    ``vectors(name, embedding)`` may hold others, and some more than once.
    """
    spark = queries.sparkSession
    most = F.max("top_k") + turns.SPARE
    asked = queries.where("embedding IS NOT NULL").groupBy(F.col("embedding").alias("name"))
    asked = stage(asked.agg(most.cast("int").alias("top_k"), F.max("apply_mmr").alias("diverse")))
    if (asked.agg(F.sum(F.col("top_k").cast("long"))).first()[0] or 0) > LIST_ENTRIES:
        return None
    named = vectors.join(F.broadcast(asked), "name").groupBy("name")
    named = stage(named.agg(*(F.first(c).alias(c) for c in ("embedding", "top_k", "diverse"))))
    found = search(named.select(F.col("name").alias("session_id"), F.lit(0).alias("q_idx"), "embedding", "top_k"), exclude=None)
    found = stage(found.select(F.col("session_id").alias("name"), "rank", "id", "score").join(items.select("id", F.col("history_value").alias("value")), "id"))
    ids = found.join(F.broadcast(named.where("diverse").select("name")), "name", "left_semi").select("id").distinct()
    if ids.count() * embedding_width(items) > LIST_FLOATS:
        return None
    of_items = items.join(F.broadcast(ids), "id", "left_semi").select("id", V.as_double("embedding").alias("embedding")).toArrow()
    # By cosine, scores are all that is needed of a query's vector.
    of_queries = named.where(F.col("diverse") & F.lit(metric != "cosine_sim")).select("name", "embedding").toArrow()
    lengths = {r["name"]: r["top_k"] for r in named.select("name", "top_k").collect()}
    return spark.sparkContext.broadcast(Lists(found.toArrow(), lengths, of_items, of_queries))


class _Walk:
    """Sessions' requests in their order, each answered from the lists."""

    def __init__(self, lists: Lists, options):
        self.lists, self.options = lists, options
        self.ascending = options.metric == "euclidean_dist"
        self.session, self.shown, self.stopped = None, set(), False
        self.request, self.queries, self.out = None, [], []

    def step(self, session, kind, row) -> None:
        if kind != _QUERY:
            self.answer()
        if session != self.session:
            self.session, self.shown, self.stopped = session, set(), False
        if kind == _HIDDEN:
            # No list has the others.
            if row["value"] in self.lists.every_value:
                self.shown.add(row["value"])
        elif kind == _REQUEST:
            self.request = tuple(row[c] for c in REQUEST), row["batch_size"]
        else:
            self.queries.append(row)

    def answer(self) -> None:
        if self.request is not None and not self.stopped:
            lists = self._lists()
            if lists is None:
                self.stopped = True
            else:
                (asked, size), held = self.request, self.lists
                batch = self._batch(lists, asked[-1], size)
                self.out.append((*asked, 0, None, None, None))
                self.out += [(*asked, n + 1, held.ids[k], float(held.scores[k]), q) for n, (k, q) in enumerate(batch)]
                self.shown.update(held.values[k] for k, _ in batch)
        self.request, self.queries = None, []

    def _lists(self) -> list | None:
        """Each query with its best candidates; none at all if a list has run out."""
        values, shown, out = self.lists.values, self.shown, []
        for query in self.queries:
            at, end, more = self.lists.of.get(query["vector"], (0, 0, False))
            wanted, rows = query["top_k"], []
            while at < end and len(rows) < wanted:
                if values[at] not in shown:
                    rows.append(at)
                at += 1
            if len(rows) < wanted and more:
                return None
            if rows:
                out.append((query, np.array(rows)))
        return out

    def _batch(self, lists: list, request: str, size: int) -> list[tuple]:
        held, options = self.lists, self.options
        lists = [(q, rows[turns.passes(held.scores[rows], q["threshold"], self.ascending)]) for q, rows in lists]
        diverse = [k for k, (q, _) in enumerate(lists) if q["apply_mmr"]]
        if diverse:
            some = [lists[k] for k in diverse]
            sims = None
            if options.metric != "cosine_sim":
                sims = [held.queries[q["vector"]] for q, _ in some]
            chosen = turns.diverse(
                [held.vectors[[held.vector_of[held.ids[k]] for k in rows]] for _, rows in some],
                [held.scores[rows] for _, rows in some], sims, [q["top_k_mmr"] for q, _ in some], options.mmr_seed,
            )
            for k, picks in zip(diverse, chosen):
                lists[k] = lists[k][0], lists[k][1][picks]
        pool, met = [], set()
        for q, rows in lists:
            for k in rows:
                if held.ids[k] not in met or not q["remove_duplicates"]:
                    pool.append((turns.draw(options.seed, request, held.ids[k]), q["q_idx"], k))
                met.add(held.ids[k])
        pool.sort(key=lambda x: x[:2])
        return [(k, q) for _, q, k in pool[:size]]


def answer_from_lists(requests: DataFrame, queries: DataFrame, hidden: DataFrame, items: DataFrame, lists: Broadcast, options) -> DataFrame:
    """Answers to all requests up to the first of their session whose list has run out.

    ``requests`` have ``REQUEST`` and a ``batch_size``, ``queries`` are those of each ``request``, by
    vectors' names. ``hidden(session_id, clock, history_value)`` is what a session must not be
    shown from then on. Returns ``REQUEST``, ``position``, ``id``, ``score`` and ``q_idx``, and a row of position 0
    for each request that is answered.
    """
    keys = ["session_id", "clock"]
    marks = requests.withColumn("ts", F.unix_micros("ts")).select(*REQUEST, "batch_size", F.lit(_REQUEST).alias("kind"))
    asking = queries.select(
        F.col("session_id").alias("request"), "q_idx", F.col("embedding").alias("vector"), "top_k", "top_k_mmr", "threshold", "apply_mmr", "remove_duplicates"
    ).join(requests.select("request", *keys), "request").drop("request")
    left_out = hidden.select(*keys, F.col("history_value").alias("value"), F.lit(_HIDDEN).alias("kind"))
    rows = left_out.unionByName(marks, allowMissingColumns=True).unionByName(asking.withColumn("kind", F.lit(_QUERY)), allowMissingColumns=True)
    dealt = rows.repartition(default_parallelism(rows.sparkSession), "session_id").sortWithinPartitions(*keys, "kind", "q_idx")
    schema = T.StructType(
        [marks.schema[c] for c in REQUEST]
        + [
            T.StructField("position", T.IntegerType()),
            T.StructField("id", items.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("q_idx", T.IntegerType()),
        ]
    )
    types = to_arrow_schema(schema)

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(types), types)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(lists.value, options)
        for batch in batches:
            for row in batch.to_pylist():
                walk.step(row["session_id"], row["kind"], row)
            yield table(walk.out)
            walk.out = []
        walk.answer()
        yield table(walk.out)

    return dealt.mapInArrow(run, schema).withColumn("ts", F.timestamp_micros("ts"))
