"""Top-k nearest items for a table of weighted queries.

Items are cut into *units* and queries into *groups*, both of bounded size; the
pairs (unit, group) that have to meet are co-grouped, each pair is one matrix
product in a task, and a windowed merge keeps the best k of each query. Which
units a query visits is the only difference between the search modes: all of
them (here), or those an index selects (``operators.ivf``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sessionloom.config import BLOCK_FLOATS, SCORE_DECIMALS, broadcast_if_small, default_parallelism
from sessionloom.functions import vectors as V
from sessionloom.sources.items import embedding_width

METRICS = ("cosine_sim", "euclidean_dist", "dot_product")
QUERY_KEYS = ["session_id", "q_idx"]

# Queries of one session that stay together, and exclusion rows a task may hold.
QUERY_RUN = 1024
EXCLUSIONS_PER_TASK = 1 << 22

# Cells of the score matrix, and pairs scored exactly, that are held at a time.
TILE_CELLS = 1 << 23
RESCORE = 1 << 17


def score_column(a, b, metric: str):
    """The score of two vectors as an expression."""
    forms = {"cosine_sim": V.cosine, "euclidean_dist": V.euclidean, "dot_product": V.dot}
    return F.round(forms[metric](a, b), SCORE_DECIMALS)


def best_first(metric: str):
    """Sort order of scores: distances ascend, similarities descend."""
    return F.asc("score") if metric == "euclidean_dist" else F.desc("score")


def search(items: DataFrame, query: list[float], k: int, metric: str = "cosine_sim") -> DataFrame:
    """The k nearest items of one query vector: ``(rank, id, score)``.

    Broken items are never found; a broken query is refused.
    """
    if not all(math.isfinite(x) for x in query):
        raise ValueError("the query has a component that is no number")
    vector = F.array(*[F.lit(float(x)) for x in query])
    scored = items.where(V.finite("embedding")).select("id", score_column(F.col("embedding"), vector, metric).alias("score"))
    nearest = scored.orderBy(best_first(metric), "id").limit(k)
    # At most k rows reach this window.
    rank = F.row_number().over(Window.orderBy(best_first(metric), "id"))
    return nearest.select(rank.alias("rank"), "id", "score")


def knn_join(
    queries: DataFrame,
    items: DataFrame,
    metric: str = "cosine_sim",
    exclude: DataFrame | None = None,
    block_floats: int = BLOCK_FLOATS,
    n_items: int | None = None,
) -> DataFrame:
    """Exact top-k join: every query against every item.

    ``queries(session_id, q_idx, embedding, top_k, ...)``; further columns are
    carried to the result. ``exclude(session_id, history_value)`` lists what a
    session must not be served; ``n_items`` saves counting the collection. Returns ``(session_id, q_idx, rank, id, score)``
    plus the carried columns. Broken queries and items find nothing.
    """
    queries = queries.where(V.finite("embedding"))
    dim = max(embedding_width(items), 1)
    rows = max(block_floats // dim, 1)
    n_items = items.count() if n_items is None else n_items
    n_hash = max(math.ceil(n_items / rows), 1)
    unique_values = _history_is_id(items)
    parts = _item_parts(items, n_hash, rows, unique_values)

    item_side = items.select("id", "embedding", "history_value")
    if parts is None:
        item_side = item_side.withColumn("unit", _hash_unit(n_hash))
        n_units = n_hash
    else:
        part = F.pmod(F.xxhash64("id"), F.col("n_parts")).cast("int")
        item_side = (
            item_side.withColumn("h", _hash_unit(n_hash))
            .join(parts, "h")
            .withColumn("unit", F.col("first_unit") + part)
            .drop("h", "n_parts", "first_unit")
        )
        n_units = n_hash + n_items // rows

    stats = queries.agg(F.count(F.lit(1)).alias("n"), F.max("q_idx").alias("q")).first()
    n_queries, max_q = stats["n"], stats["q"] or 0
    groups = max(math.ceil(n_queries / rows), math.ceil(default_parallelism(items.sparkSession) / n_units))
    groups = max(1, min(groups, math.ceil(n_queries / 64)))
    if exclude is not None:
        groups = max(groups, math.ceil(exclude.count() / (n_units * EXCLUSIONS_PER_TASK)))

    def in_group(run):
        return F.pmod(F.xxhash64("session_id", run), F.lit(groups)).cast("int")

    units = F.sequence(F.lit(0), F.lit(n_hash - 1))
    query_side = queries.withColumn("grp", in_group(F.floor(F.col("q_idx") / QUERY_RUN)))
    query_side = _visit(query_side.withColumn("h", F.explode(units)), parts)
    skips = None
    if exclude is not None:
        runs = F.sequence(F.lit(0).cast("long"), F.lit(max_q // QUERY_RUN).cast("long"))
        skips = (
            matching_types(exclude, queries, items)
            .distinct()
            .withColumn("h", _hash_unit(n_hash))
            .withColumn("run", F.explode(runs))
            .withColumn("grp", in_group(F.col("run")))
            .drop("run")
        )
        skips = _visit(skips, parts)
    item_side = item_side.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return search_units(query_side, item_side, metric, skips)


def search_units(
    query_side: DataFrame,
    item_side: DataFrame,
    metric: str,
    skips: DataFrame | None = None,
) -> DataFrame:
    """Search each (unit, grp) pair and merge the results per query.

    ``skips(session_id, history_value, unit, grp)`` rows travel with the queries,
    so an exclusion reaches exactly the tasks that need it.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    carried = [c for c in query_side.columns if c not in ("embedding", "unit", "grp", *QUERY_KEYS)]
    value_type = item_side.schema["history_value"].dataType
    query_side = query_side.withColumn("history_value", F.lit(None).cast(value_type))
    if skips is not None:
        query_side = query_side.unionByName(
            skips.select("session_id", F.col("history_value").cast(value_type).alias("history_value"), "unit", "grp"),
            allowMissingColumns=True,
        )
    # Own column names: cogroup mixes up columns both sides inherit from one table.
    item_side = item_side.select(
        F.col("unit").alias("item_unit"),
        F.col("grp").alias("item_grp"),
        F.col("id").alias("item_id"),
        F.col("embedding").alias("item_embedding"),
        F.col("history_value").alias("item_value"),
    )
    id_type = item_side.schema["item_id"].dataType
    schema = T.StructType(
        [query_side.schema[c] for c in QUERY_KEYS]
        + [T.StructField("id", id_type), T.StructField("score", T.DoubleType())]
        + [query_side.schema[c] for c in carried]
    )

    nothing = to_arrow_schema(schema).empty_table()

    def search_pair(queries: pa.Table, items: pa.Table) -> pa.Table:
        if not (queries.num_rows and items.num_rows):
            return nothing
        return block_search(queries, items, metric, carried)

    found = (
        query_side.groupBy("unit", "grp")
        .cogroup(item_side.groupBy("item_unit", "item_grp"))
        .applyInArrow(search_pair, schema)
    )
    by_query = Window.partitionBy(*QUERY_KEYS).orderBy(best_first(metric), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(by_query))
    return ranked.where(F.col("rank") <= F.col("top_k")).select(*QUERY_KEYS, "rank", "id", "score", *carried)


def matching_types(exclude: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    """Exclusions in the types of the columns they are hashed and compared with."""
    return exclude.select(
        F.col("session_id").cast(queries.schema["session_id"].dataType).alias("session_id"),
        F.col("history_value").cast(items.schema["history_value"].dataType).alias("history_value"),
    )


def _hash_unit(n: int):
    return F.pmod(F.xxhash64("history_value"), F.lit(n)).cast("int")


def _history_is_id(items: DataFrame) -> bool:
    """Whether the history value is the id, hence unique (decided on the plan's schema)."""
    return "history_value_is_id" in (items.schema["history_value"].metadata or {})


def _item_parts(items: DataFrame, n_hash: int, rows: int, unique_values: bool) -> DataFrame | None:
    """Cut hash units that repeated history values have made too large."""
    if unique_values:
        return None
    counts = items.groupBy(_hash_unit(n_hash).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("h", F.ceil(F.col("n") / (2 * rows)).cast("int").alias("n_parts"))
    # ``counts`` has at most n_hash = n_items / rows rows.
    first = F.sum("n_parts").over(Window.orderBy("h")) - F.col("n_parts")
    return broadcast_if_small(counts.select("h", "n_parts", first.cast("int").alias("first_unit")))


def _visit(side: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Send a row to all parts of its hash unit."""
    if parts is None:
        return side.withColumnRenamed("h", "unit")
    offsets = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    return (
        side.join(parts, "h")
        .withColumn("part", offsets)
        .withColumn("unit", F.col("first_unit") + F.col("part"))
        .drop("h", "n_parts", "first_unit", "part")
    )


def matrix(column) -> np.ndarray:
    """A list column as a (rows, width) DOUBLE matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def block_search(queries: pa.Table, items: pa.Table, metric: str, carried: list[str]) -> pa.Table:
    """Top-k of one query group in one item unit."""
    is_query = pc.is_valid(queries["q_idx"])
    skips = queries.filter(pc.invert(is_query))
    queries = queries.filter(is_query)
    names = [*QUERY_KEYS, "id", "score", *carried]
    items = items.sort_by("item_id")
    if skips.num_rows:
        queries = queries.sort_by("session_id")
    q, m = matrix(queries["embedding"]), matrix(items["item_embedding"])
    if not len(q):
        rows, cols, scores = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    else:
        ks = queries["top_k"].to_numpy()
        rows, cols, scores = block_top_k(q, m, ks, metric, _Blocked(queries, items, skips) if skips.num_rows else None)
    # Without the vectors, which a row for each result would repeat.
    out = queries.select([*QUERY_KEYS, *carried]).take(pa.array(rows, pa.int64()))
    columns = {c: out[c] for c in [*QUERY_KEYS, *carried]}
    columns["id"] = items["item_id"].take(pa.array(cols, pa.int64()))
    columns["score"] = pa.array(scores, pa.float64())
    return pa.table([columns[n] for n in names], names=names)


class _Blocked:
    """For each query row, the item positions its session must not see.

    A value may stand for a large part of the items, so that they are told for one
    session at a time; rows of a session should follow one another.
    """

    def __init__(self, queries: pa.Table, items: pa.Table, skips: pa.Table):
        values = items["item_value"].combine_chunks()
        distinct = pc.unique(values)
        code_of_item = pc.index_in(values, distinct).to_numpy(zero_copy_only=False)
        self.order = np.argsort(code_of_item, kind="stable")
        self.starts = np.searchsorted(code_of_item[self.order], np.arange(len(distinct) + 1))

        sessions = pc.unique(queries["session_id"])
        session_of_skip = pc.fill_null(pc.index_in(skips["session_id"], sessions), -1).to_numpy()
        code_of_skip = pc.fill_null(pc.index_in(skips["history_value"], distinct), -1).to_numpy()
        known = (session_of_skip >= 0) & (code_of_skip >= 0)
        session, code = session_of_skip[known], code_of_skip[known]
        self.codes = code[np.argsort(session, kind="stable")]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(session, minlength=len(sessions)))]).astype(np.int64)
        self.session_of_row = pc.index_in(queries["session_id"], sessions).to_numpy()
        self.session, self.columns = -1, None

    def __getitem__(self, row: int) -> np.ndarray:
        session = self.session_of_row[row]
        if session != self.session:
            codes = self.codes[self.ends[session] : self.ends[session + 1]]
            # Every skipped value stands for the run of items that have it.
            sizes = self.starts[codes + 1] - self.starts[codes]
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            self.session, self.columns = session, self.order[np.repeat(self.starts[codes], sizes) + within]
        return self.columns


def block_top_k(q, m, ks, metric, blocked=None):
    """Row, column and score of each query's best items, ties to the lower column.

    A single-precision product finds what can be among the best, its error bound
    allowed for; only those pairs are scored in double precision.
    """
    # Items with NaN or infinite components cannot be scored; they are never found.
    broken = ~np.isfinite(m).all(axis=1)
    q, m = np.nan_to_num(q, posinf=0, neginf=0), np.where(broken[:, None], 0, m)
    if metric == "cosine_sim":
        q, m = unit_rows(q), unit_rows(m)
    squares = (m * m).sum(1)
    reach = np.sqrt((q * q).sum(1)) * np.sqrt(squares.max())
    if metric == "euclidean_dist":
        reach = 2 * reach + squares.max()
    slack = (reach * ((q.shape[1] + 4) * 2.4e-7 + 1e-8) + 1e-8).astype(np.float32)
    if metric == "euclidean_dist":
        # 2 qm - mm orders items as their distance does; one product gives it.
        q32 = np.column_stack([2 * q, np.full(len(q), -1.0)]).astype(np.float32)
        m32 = np.column_stack([m, squares]).astype(np.float32).T
    else:
        q32, m32 = q.astype(np.float32), m.astype(np.float32).T
    step = max(1, TILE_CELLS // len(m))
    tile = np.empty((min(step, len(q)), len(m)), np.float32)
    pieces = []
    for a in range(0, len(q), step):
        goodness = np.matmul(q32[a : a + step], m32, out=tile[: len(q) - a])
        if broken.any():
            goodness[:, broken] = -np.inf
        if blocked is not None:
            for r in range(len(goodness)):
                goodness[r, blocked[a + r]] = -np.inf
        rows, cols = _among_best(goodness, max(int(ks[a : a + step].max()), 1), slack[a : a + step])
        rows = rows + a
        score = np.concatenate(
            [np.zeros(0)]
            + [_scores(q[rows[i : i + RESCORE]], m[cols[i : i + RESCORE]], metric) for i in range(0, len(rows), RESCORE)]
        )
        order = np.lexsort((cols, score if metric == "euclidean_dist" else -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < ks[rows]
        pieces.append((rows[keep], cols[keep], score[keep]))
    return tuple(np.concatenate(p) for p in zip(*pieces))


def _among_best(goodness: np.ndarray, k: int, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all values that are at most ``slack`` below their row's k-th largest.

    The k-th largest of the maxima of short runs is a lower bound, at a fraction of the work of
    ranking the row, and only runs whose maximum reaches it are looked at again.
    """
    n = goodness.shape[1]
    runs = math.ceil(n / max(min(64, n // (4 * k)), 1))
    # A run is every column that has the same place in a piece of this length.
    best = goodness[:, :runs].copy()
    for start in range(runs, n, runs):
        piece = goodness[:, start : start + runs]
        np.maximum(best[:, : piece.shape[1]], piece, out=best[:, : piece.shape[1]])
    at = max(runs - k, 0)
    floor = np.partition(best, at, axis=1)[:, at] - slack
    rows, first = np.nonzero((best >= floor[:, None]) & (best > -np.inf))
    cells = [np.zeros((2, 0), np.int64)]
    for start in range(0, n, runs):
        inside = first + start < n
        r, c = rows[inside], first[inside] + start
        value = goodness[r, c]
        kept = (value >= floor[r]) & (value > -np.inf)
        cells.append(np.stack([r[kept], c[kept]]))
    return tuple(np.concatenate(cells, axis=1))


def _scores(q: np.ndarray, m: np.ndarray, metric: str) -> np.ndarray:
    if metric == "euclidean_dist":
        raw = np.sqrt(((q - m) ** 2).sum(1))
    else:
        raw = np.einsum("ij,ij->i", q, m)
    return np.round(raw, SCORE_DECIMALS)
