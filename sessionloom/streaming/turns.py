"""Answers to a session's requests that know the answers before them.

Requests of one session must not be shown what an earlier one of them was given, and how
often a stream is cut into micro-batches must not matter. Searching after every answer
would take a search per request of the busiest session. Instead the next requests of all
sessions are searched together, with spare candidates; then each session's requests go
one after the other through its own lists, leaving out what has been shown by then. A
request whose list runs out waits, with those after it, for the next search, which leaves
out what is known by then. The first request of a search never has to wait.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionloom.config import SCORE_DECIMALS, stage
from sessionloom.operators.knn import matrix, unit_rows
from sessionloom.operators.mmr import greedy_picks

#: Requests of a session that are searched together, and candidates beyond a query's own.
TURNS = 32
SPARE = 64


def passes(scores: np.ndarray, threshold: float | None, ascending: bool) -> np.ndarray:
    """Which scores stay; the limit is relaxed to the mean, and never empties a query."""
    if threshold is None:
        return np.ones(len(scores), bool)
    mean = round(float(scores.mean()), SCORE_DECIMALS)
    if ascending:
        return scores <= max(threshold, mean, scores.min())
    return scores >= min(threshold, mean, scores.max())


def draw(seed: int, request: str, item) -> str:
    """What a candidate's place in its request's pool goes by."""
    return hashlib.md5(f"{seed}:{request}:{item}".encode()).hexdigest()


def diverse(vectors: list, scores: list, queries: list | None, wanted: list, mmr_seed: str, lam: float = 0.5) -> list:
    """MMR of all lists of a request together: the places of each list's picks.

    ``queries`` are the lists' own vectors, of length one, where scores are no cosines.
    """
    sizes, wanted = np.array([len(x) for x in scores]), np.array(wanted)
    block = np.zeros((len(scores), sizes.max(), vectors[0].shape[1]))
    sim = np.full(block.shape[:2], -np.inf)
    for q, (rows, score) in enumerate(zip(vectors, scores)):
        block[q, : len(rows)] = rows
        sim[q, : len(rows)] = score if queries is None else np.round(block[q, : len(rows)] @ queries[q], SCORE_DECIMALS)
    goal = np.where(wanted > 0, np.minimum(wanted, sizes), sizes)
    picks = greedy_picks(block, sim, goal, lam, mmr_seed)
    return [np.arange(n) if w <= 0 else picks[q, :g] for q, (n, w, g) in enumerate(zip(sizes, wanted, goal))]


class _Session:
    """One session's candidates of a search, in the order of its requests."""

    def __init__(self, rows: pa.Table, extras: pa.Table, metric: str, mmr_seed: str, seed: int, lam: float = 0.5):
        self.ascending, self.metric = metric == "euclidean_dist", metric
        self.mmr_seed, self.seed, self.lam = mmr_seed, seed, lam
        rows = rows.sort_by([("place", "ascending"), ("query", "ascending"), ("rank", "ascending")])
        self.table = rows
        self.ids, self.values = rows["id"].to_pylist(), rows["value"].to_pylist()
        self.scores = rows["score"].to_numpy()
        self.place, self.query, self.rank = (rows[c].to_numpy() for c in ("place", "query", "rank"))
        is_vector = pc.is_valid(extras["extra_embedding"])
        given, signals = extras.filter(is_vector), extras.filter(pc.invert(is_vector))
        self.vector_of = {x: k for k, x in enumerate(given["extra_id"].to_pylist())}
        self.vectors = unit_rows(matrix(given["extra_embedding"])) if given.num_rows else None
        self.signals: dict[int, set] = {}
        for place, value in zip(signals["extra_place"].to_pylist(), signals["extra_value"].to_pylist()):
            self.signals.setdefault(place, set()).add(value)

    def column(self, name: str, row: int):
        return self.table[name][row].as_py()

    def answers(self):
        """``(row of the request, rows of its batch)``, until one has to wait."""
        shown: set = set()
        limits = np.flatnonzero(np.append(True, np.diff(self.place) != 0))
        for start, end in zip(limits, np.append(limits[1:], len(self.place))):
            # The row of query -1 stands for the request itself.
            shown |= self.signals.get(int(self.place[start]), set())
            lists = self._lists(start + 1, end, None if self.column("chance", start) else shown)
            if lists is None:
                return
            batch = self._batch(start, lists)
            shown |= {self.values[k] for k in batch}
            yield start, batch

    def _lists(self, start: int, end: int, shown: set | None) -> list[np.ndarray] | None:
        """Each query's best candidates; none at all if a list has run out."""
        if start == end:
            return []
        limits = start + np.flatnonzero(np.append(True, np.diff(self.query[start:end]) != 0))
        out = []
        for lo, hi in zip(limits, np.append(limits[1:], end)):
            wanted = self.column("wanted", lo)
            if shown is None:
                out.append(np.arange(lo, min(hi, lo + wanted)))
                continue
            left = np.array([k for k in range(lo, hi) if self.values[k] not in shown], np.int64)
            if len(left) < wanted and hi - lo == self.column("top_k", lo):
                return None
            if len(left):
                out.append(left[:wanted])
        return out

    def _batch(self, request: int, lists: list[np.ndarray]) -> list[int]:
        lists = [rows[passes(self.scores[rows], self.column("threshold", rows[0]), self.ascending)] for rows in lists]
        chosen = [k for k, rows in enumerate(lists) if self.column("apply_mmr", rows[0])]
        if chosen:
            for k, rows in zip(chosen, self._diverse([lists[k] for k in chosen])):
                lists[k] = rows
        pool, met = [], set()
        for rows in lists:
            for k in rows:
                if self.ids[k] not in met or not self.column("remove_duplicates", k):
                    pool.append(k)
                met.add(self.ids[k])
        key = self.column("request", request)

        def place(k: int) -> tuple:
            return draw(self.seed, key, self.ids[k]), self.query[k]

        return sorted(pool, key=place)[: self.column("batch_size", request)]

    def _diverse(self, lists: list[np.ndarray]) -> list[np.ndarray]:
        queries = None
        if self.metric != "cosine_sim":
            queries = [unit_rows(np.array([self.column("query_embedding", rows[0])], np.float64))[0] for rows in lists]
        vectors = [self.vectors[[self.vector_of[self.ids[k]] for k in rows]] for rows in lists]
        wanted = [self.column("top_k_mmr", rows[0]) for rows in lists]
        picks = diverse(vectors, [self.scores[rows] for rows in lists], queries, wanted, self.mmr_seed, self.lam)
        return [rows[p] for rows, p in zip(lists, picks)]


def _answers(metric: str, mmr_seed: str, seed: int, schema: pa.Schema):
    def run(rows: pa.Table, extras: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows:
            session = _Session(rows, extras, metric, mmr_seed, seed)
            for start, batch in session.answers():
                request = session.column("request", start)
                out.append((request, 0, None, None, None))
                out += [(request, n + 1, session.ids[k], float(session.scores[k]), int(session.query[k])) for n, k in enumerate(batch)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 5, schema)], schema=schema)

    return run


def answer_in_turn(
    requests: DataFrame, queries: DataFrame, signals: DataFrame, shown: DataFrame, items: DataFrame, search, options
) -> DataFrame:
    """Answers to the next requests of every session, as far as they can be given at once.

    ``requests(session_id, request, place, seen, chance, batch_size)``: up to ``TURNS``
    of a session, numbered by ``place`` from 0; ``seen`` signals were there before.
    ``queries`` are those of each ``request``, ``signals(session_id, number,
    history_value)`` the sessions' numbered signals and ``shown(session_id,
    history_value)`` what has been served before. Requests of ``chance`` take no notice of
    what has been shown. Returns ``(request, position, id, score, q_idx)`` and a row
    of position 0 for each request that is answered. A session's candidates meet
    in one task: ``TURNS`` requests, a query's candidates each and ``SPARE`` more.
    """
    requests = stage(requests)
    own = requests.select("request", "session_id", "place", "chance", "batch_size")
    queries = stage(queries.join(own, "request"))
    width = (queries.agg(F.max("q_idx")).first()[0] or 0) + 1
    text = F.col("session_id").cast("string")
    # History is the session's; a random batch's queries have a key without history.
    key = F.when(F.col("chance"), F.concat(F.lit("request "), "request")).otherwise(F.concat(F.lit("session "), text))
    spare = F.when(F.col("chance"), 0).otherwise(F.least(F.col("place") * F.col("batch_size"), F.lit(SPARE)))
    asked = queries.select(
        key.alias("session_id"),
        (F.col("place") * width + F.col("q_idx")).cast("int").alias("q_idx"),
        "embedding",
        (F.col("top_k") + spare).cast("int").alias("top_k"),
        F.col("top_k").alias("wanted"),
        *(["query_embedding"] if "query_embedding" in queries.columns else []),
        "top_k_mmr",
        "threshold",
        "apply_mmr",
        "remove_duplicates",
        "batch_size",
        F.col("session_id").alias("own"),
        F.col("q_idx").alias("query"),
        "request",
        "place",
        "chance",
    )
    # At most TURNS numbers of a session.
    seen = requests.groupBy("session_id").agg(F.sort_array(F.collect_list("seen")).alias("seen"))
    # The first request that comes after the signal; those before all requests are history.
    placed = signals.join(seen, "session_id").withColumn("place", F.size(F.filter("seen", lambda s: s <= F.col("number"))))
    history = placed.where("place = 0").select("session_id", "history_value").unionByName(shown.select("session_id", "history_value"))
    exclude = stage(history.select(F.concat(F.lit("session "), text).alias("session_id"), "history_value").distinct())
    found = stage(search(asked, exclude=exclude).drop("session_id", "q_idx"))

    value_type, item_type = (items.schema[c].dataType for c in ("history_value", "id"))
    values = items.select("id", F.col("history_value").alias("value"))
    candidates = found.join(values, "id")
    markers = requests.select(F.col("session_id").alias("own"), "request", "place", "chance", "batch_size", F.lit(-1).alias("query"), F.lit(0).alias("rank"))
    candidates = candidates.unionByName(markers, allowMissingColumns=True)
    vectors = found.where("apply_mmr").select("own", "id").distinct().join(items.select("id", "embedding"), "id")
    later = placed.where((F.col("place") > 0) & (F.col("place") < F.size("seen")))
    extras = vectors.select(
        "own", F.lit(None).cast(value_type).alias("value"), F.lit(None).cast("int").alias("place"), "id", F.col("embedding").cast("array<double>").alias("embedding")
    ).unionByName(later.select(F.col("session_id").alias("own"), F.col("history_value").alias("value"), "place"), allowMissingColumns=True)
    # Own column names: cogroup mixes up columns both sides inherit from one table.
    extras = extras.select(*(F.col(c).alias(f"extra_{c}") for c in ("own", "value", "place", "id", "embedding")))

    schema = T.StructType(
        [
            T.StructField("request", T.StringType()),
            T.StructField("position", T.IntegerType()),
            T.StructField("id", item_type),
            T.StructField("score", T.DoubleType()),
            T.StructField("q_idx", T.IntegerType()),
        ]
    )
    run = _answers(options.metric, options.mmr_seed, options.seed, to_arrow_schema(schema))
    return candidates.groupBy("own").cogroup(extras.groupBy("extra_own")).applyInArrow(run, schema)
