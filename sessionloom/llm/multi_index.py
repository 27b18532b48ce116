"""Near-duplicate embeddings through an inverted multi-index.

Codebooks for the two halves of the vectors form a grid of cells. A multi-sequence
traversal visits the cells of the grid from the nearest on; how many are visited is
measured on sample queries, against all vectors and against made-up neighbours at the
similarity asked for, so that the target recall is met where links are many or rare.
Cells are compared in blocks of bounded size, which return numbers of links and a
spanning forest instead of pairs. Equal vectors stand for one another.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import stage
from sessionloom.llm.components import components, forest

#: Vectors the codebooks are trained on, and queries the traversal is measured with.
FIT_VECTORS = 20_000
SAMPLE_QUERIES = 512
TARGET_RECALL = 1.0
#: Cells visited for each one that the sample queries need.
SLACK = 1.5
LEAST_VISITS = 3
#: Part of the links of just the similarity asked for that must be found without any
#: being in the sample: vectors that agree more are nearer and found more often.
RARE_RECALL = 0.98
#: Centres of a codebook at most: a row per cell is broadcast.
MOST_CENTRES = 1024
#: Vectors of a cell, on average, and of one side of a block, at most on average.
CELL_VECTORS = 32
BLOCK = 1024


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """``k`` centres of the points, or all distinct points if these are fewer."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct
    draw = np.random.default_rng(seed)
    centres = distinct[draw.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        near = distances(points, centres).argmin(1)
        sizes = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        some = np.flatnonzero(sizes)
        sums = np.zeros_like(centres)
        sums[some] = np.add.reduceat(points[order], (np.cumsum(sizes) - sizes)[some], axis=0)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T, 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, visits: int) -> list[int]:
    """The cells nearest to a vector, by the sum of its distances to both halves' centres.

    Both lists are walked in rising order; a heap holds the pairs whose neighbours
    before them have been visited.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, width = first[a].tolist(), second[b].tolist(), len(second)
    heap, seen, out = [(x[0] + y[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heappop(heap)
        out.append(int(a[i]) * width + int(b[j]))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(x) and q < width and (p, q) not in seen:
                seen.add((p, q))
                heappush(heap, (x[p] + y[q], p, q))
    return out


class Grid:
    """Two codebooks and how to visit their cells."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.books = (k_means(sample[:, : self.half], k), k_means(sample[:, self.half :], k))

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(unit[:, : self.half], self.books[0]), distances(unit[:, self.half :], self.books[1])

    def cells(self, unit: np.ndarray) -> np.ndarray:
        first, second = self.halves(unit)
        return first.argmin(1) * len(self.books[1]) + second.argmin(1)

    def visits(self, unit: np.ndarray, number: int) -> list[list[int]]:
        return [multi_sequence(f, s, number) for f, s in zip(*self.halves(unit))]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def _rank_rows(shared, similarity: float):
    """How many links of the sample queries lie in the cells of each rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, queries, own = shared.value
        first, second = grid.halves(queries)
        totals = np.zeros(first.shape[1] * second.shape[1], np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                unit = _unit(_matrix(batch.column("embedding").slice(k, 4096)))
                # A vector always finds itself, which tells nothing.
                others = own[:, None] != batch.column("id").slice(k, 4096).to_numpy()
                i, j = np.nonzero((queries @ unit.T >= similarity) & others)
                cells = grid.cells(unit)[j]
                for query in np.unique(i):
                    away = (first[query][:, None] + second[query]).ravel()
                    ranks = np.searchsorted(np.sort(away), away[cells[i == query]])
                    totals += np.bincount(ranks, minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["rank", "n"])

    return run


def rare_visits(grid: Grid, sample: np.ndarray, similarity: float, recall: float = RARE_RECALL, seed: int = 0) -> int:
    """The number of cells to visit so that vectors of just this similarity find each other,
    from either side."""
    draw = np.random.default_rng(seed).normal(size=sample.shape)
    draw -= (draw * sample).sum(1, keepdims=True) * sample
    draw /= np.maximum(np.sqrt((draw**2).sum(1, keepdims=True)), 1e-12)
    near = similarity * sample + np.sqrt(1 - similarity**2) * draw

    def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for k, (first, second, cell) in enumerate(zip(*grid.halves(a), grid.cells(b))):
            away = (first[:, None] + second).ravel()
            out[k] = (away < away[cell]).sum()
        return out

    either = np.minimum(ranks(sample, near), ranks(near, sample))
    return int(np.quantile(either, recall, method="higher")) + 1


def visits_needed(vectors: DataFrame, grid: Grid, sample: np.ndarray, own: np.ndarray, similarity: float, recall: float) -> int:
    """The number of cells to visit so that the sample queries, whose ids are ``own``, find
    their links, and links that the sample has none of are found as well."""
    cells = len(grid.books[0]) * len(grid.books[1])
    least = max(LEAST_VISITS, rare_visits(grid, sample, similarity))
    shared = vectors.sparkSession.sparkContext.broadcast((grid, sample, own))
    found = vectors.select("id", "embedding").mapInArrow(_rank_rows(shared, similarity), "rank long, n long")
    rows = sorted((r["rank"], r["n"]) for r in found.groupBy("rank").agg(F.sum("n").alias("n")).collect())
    total, reached = sum(n for _, n in rows), 0
    for rank, n in rows:
        reached += n
        if reached >= recall * total:
            return min(cells, max(least, int(SLACK * (rank + 1))))
    return min(cells, least)


def _placed(shared, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_matrix(batch.column("embedding")))
                columns = [batch.column("id"), batch.column("copies"), batch.column("embedding")]
                added = [pa.array(grid.cells(unit)), pa.array(grid.visits(unit, number), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*columns, *added], names=["id", "copies", "embedding", "cell", "visits"])

    return run


def _block(similarity: float):
    """Links between the members of a cell and the vectors that visit it."""

    def run(members: pa.Table, probes: pa.Table) -> pa.Table:
        a = b = n = np.zeros(0, np.int64)
        if members.num_rows and probes.num_rows:
            left, right = (probes.column("v_id").to_numpy(), members.column("id").to_numpy())
            links = _unit(_matrix(probes.column("v_embedding"))) @ _unit(_matrix(members.column("embedding"))).T >= similarity
            links &= left[:, None] != right
            i, j = np.nonzero(links)
            if len(i):
                copies_left, copies_right = (probes.column("v_copies").to_numpy(), members.column("copies").to_numpy())
                # The member counts the prober unless it visits the prober's cell itself.
                own = probes.column("v_cell").to_numpy()[i] != members.column("cell").to_numpy()[j]
                visits = members.column("visits").combine_chunks()
                width = len(visits[0])
                table = visits.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                back = np.flatnonzero(own)
                back = back[~(table[j[back]] == probes.column("v_cell").to_numpy()[i[back]][:, None]).any(1)]
                from_left = np.bincount(i, copies_right[j], len(left)).astype(np.int64)
                from_right = np.bincount(j[back], copies_left[i[back]], len(right)).astype(np.int64)
                ids, roots = forest(left, right, i, j)
                keep = ids != roots
                ids, roots = ids[keep], roots[keep]
                a = np.concatenate([left, right, ids])
                b = np.concatenate([left, right, roots])
                n = np.concatenate([from_left, from_right, np.zeros(len(ids), np.int64)])
                some = (n > 0) | (a != b)
                a, b, n = a[some], b[some], n[some]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _links(groups: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(a, b, n): a link of the forest, or with a = b a number of links of one vector."""
    spark = groups.sparkSession
    n = groups.count()
    k = int(np.clip(round((n / CELL_VECTORS) ** 0.5), 2, MOST_CENTRES))
    drawn = groups.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(FIT_VECTORS).toArrow()
    sample = _unit(_matrix(drawn.column("embedding")))
    grid = Grid(sample, k)
    own = drawn.column("id").to_numpy()[:SAMPLE_QUERIES]
    number = visits_needed(groups, grid, sample[:SAMPLE_QUERIES], own, similarity, recall)
    shared = spark.sparkContext.broadcast(grid)
    kind = groups.schema["embedding"].dataType.simpleString()
    placed = stage(groups.mapInArrow(_placed(shared, number), f"id long, copies long, embedding {kind}, cell long, visits array<long>"))
    # Names of their own, so that the two sides of the co-grouping differ.
    probes = placed.select(*[F.col(c).alias(f"v_{c}") for c in ("id", "copies", "embedding", "cell")], F.explode("visits").alias("at"))

    def chunks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("at").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    # One row per cell: at most MOST_CENTRES x MOST_CENTRES.
    sizes = F.broadcast(stage(chunks(placed.withColumn("at", F.col("cell")), "m_chunks").join(chunks(probes, "p_chunks"), "at")))
    every = {c: F.explode(F.sequence(F.lit(0), F.col(f"{c}_chunks") - 1)) for c in "mp"}
    own = {c: F.pmod(F.xxhash64(i, F.lit(c)), F.col(f"{c}_chunks")).cast("int") for c, i in (("m", "id"), ("p", "v_id"))}
    member_rows = placed.withColumn("at", F.col("cell")).join(sizes, "at").withColumn("m", own["m"]).withColumn("p", every["p"])
    probe_rows = probes.join(sizes, "at").withColumn("p", own["p"]).withColumn("m", every["m"])
    members = member_rows.select("at", "m", "p", "id", "copies", "embedding", "cell", "visits").groupBy("at", "m", "p")
    visitors = probe_rows.select("at", "m", "p", "v_id", "v_copies", "v_embedding", "v_cell").groupBy("at", "m", "p")
    return members.cogroup(visitors).applyInArrow(_block(similarity), "a long, b long, n long")


def near_duplicates(embeddings: DataFrame, similarity: float = 0.95, recall: float = TARGET_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``embeddings``.

    Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing, and neither do vectors of different widths. A null ``vec_id`` links with
    nothing and is kept. Rows with the same id and vector count as one vector. Other
    columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    finite = "coalesce(forall(embedding, x -> x is not null and abs(x) < double('infinity') and not isnan(x)), false)"
    sound = F.expr(f"vec_id is not null and {finite} and exists(embedding, x -> x <> 0)")
    usable = rows.where(sound).distinct()
    groups = stage(usable.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    widths = [r[0] for r in groups.select(F.size("embedding")).distinct().collect()]
    found = None
    for width in widths:
        part = _links(groups.where(F.size("embedding") == width), similarity, recall) if width > 1 else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = groups.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).cast("long").alias("n"))
    found = stage(found)
    numbers = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    labels = components(found.where("a <> b").select("a", "b"))
    named = groups.join(numbers, "id", "left").join(labels, "id", "left").select(
        F.col("embedding").alias("_embedding"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    linked = rows.withColumn("_key", F.when(sound, F.col("embedding"))).join(named, F.col("_key") == F.col("_embedding"), "left")
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
