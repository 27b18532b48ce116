"""Search through an index of cells: a query meets only the cells it has to.

Items are assigned to the nearest of a few thousand centroids; large cells are
cut into units. With ``n_probe`` a query visits that many cells (approximate).
Without, it visits its nearest cells for a first answer and then every cell that
the triangle inequality cannot rule out, which makes the result exact.

Inner products become distances by one more dimension: with ``top`` at least the norm of
``x``, the distance of ``(q, 0)`` and ``(x, sqrt(top^2 - |x|^2))`` falls as ``q . x`` grows. Items
are cut into bands by norm, each with its own ``top``, so that cells stay small.

An index may keep columns of the items. What their values are in each unit is
written down when it is built, so that a predicate rules out units before a search.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import BLOCK_FLOATS, broadcast_if_small, local_table, stage
from sessionloom.functions import vectors as V
from sessionloom.operators.knn import (
    QUERY_KEYS,
    QUERY_RUN,
    TILE_CELLS,
    best_first,
    matching_types,
    matrix,
    search_units,
    unit_rows,
)
from sessionloom.operators.skew import salted_join
from sessionloom.sources.items import embedding_width

INDEXED_METRICS = ("cosine_sim", "euclidean_dist", "dot_product")

# Items a cell's centroid is trained on, on average.
ITEMS_PER_CELL = 256

# Added to distances, so that rounding cannot rule out a cell.
SLACK = 1e-9

# Bands of equally many items by norm, for inner products.
NORM_BANDS = 4

# Units with more different values than this keep only their smallest and largest.
ZONE_VALUES = 64


@dataclass
class Bands:
    """Centroids of one more dimension, and the largest norm in each one's band."""

    centroids: np.ndarray
    tops: np.ndarray


@dataclass
class Index:
    """Items with their unit, and what is known of cells and units."""

    items: DataFrame  # id, embedding, history_value, unit
    units: DataFrame  # cell, unit
    centroids: np.ndarray
    radius: np.ndarray  # of each cell
    sizes: np.ndarray  # of each cell
    metric: str
    unit_rows: int
    stored: bool = False  # items lie in one folder per unit
    tops: np.ndarray | None = None  # of each cell's band, for inner products
    zones: DataFrame | None = None  # unit, <kept columns>, n: where a unit has few values
    bounds: DataFrame | None = None  # cell, unit, n, few, min_<column>, max_<column>
    restricted: bool = False  # sizes are those of a predicate's items, or larger


def train_cells(
    items: DataFrame, n_cells: int, metric: str = "cosine_sim", per_cell: int = ITEMS_PER_CELL, seed: int = 0
) -> np.ndarray | Bands:
    """Centroids of a clustering of about ``per_cell`` items for each cell, or of all.

    Items with broken vectors take no part. For inner products, bands of centroids.
    """
    items = items.where(V.finite("embedding"))
    if metric == "dot_product":
        return _train_bands(items, n_cells, per_cell, seed)
    share = min(1.0, per_cell * n_cells / max(items.count(), 1))
    chosen = items if share == 1.0 else items.sample(share, seed)
    vector = V.as_double("embedding")
    points = chosen.select(array_to_vector(V.unit(vector) if metric == "cosine_sim" else vector).alias("features"))
    return np.array(KMeans(k=n_cells, seed=seed, maxIter=10).fit(points).clusterCenters())


def _train_bands(items: DataFrame, n_cells: int, per_cell: int, seed: int) -> Bands:
    vector = V.as_double("embedding")
    normed = items.select(vector.alias("v"), F.sqrt(V.dot(vector, vector)).alias("norm"))
    n, largest = normed.agg(F.count(F.lit(1)), F.max("norm")).first()
    if not n:
        return Bands(np.zeros((0, 1)), np.zeros(0))
    inner = normed.approxQuantile("norm", [k / NORM_BANDS for k in range(1, NORM_BANDS)], 0.01)
    tops = sorted({*inner, largest})
    share = min(1.0, per_cell * n_cells / n)
    chosen = normed if share == 1.0 else normed.sample(share, seed)
    centroids, own_tops = [], []
    for low, top in zip([-1.0, *tops], tops):
        own = chosen.where((F.col("norm") > low) & (F.col("norm") <= top))
        rest = F.array(F.sqrt(F.greatest(F.lit(top * top) - F.col("norm") * F.col("norm"), F.lit(0.0))))
        points = own.select(array_to_vector(F.concat("v", rest)).alias("features"))
        if points.isEmpty():
            continue
        found = KMeans(k=max(n_cells // len(tops), 2), seed=seed, maxIter=10).fit(points).clusterCenters()
        centroids += found
        own_tops += [top] * len(found)
    return Bands(np.array(centroids), np.array(own_tops))


def _lifted(m: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors with their band's further coordinate, and which cells are of their band."""
    bands = np.unique(tops)
    norms = np.sqrt((m * m).sum(1))
    own = bands[np.minimum(np.searchsorted(bands, norms), len(bands) - 1)]
    rest = np.sqrt(np.maximum(own * own - norms * norms, 0))
    return np.concatenate([m, rest[:, None]], axis=1), own[:, None] == tops[None, :]


def build_index(
    items: DataFrame,
    centroids: np.ndarray | Bands,
    metric: str = "cosine_sim",
    block_floats: int = BLOCK_FLOATS,
    keep: list[str] | None = None,
) -> Index:
    """Assign items to cells and cut cells into units of bounded size.

    Items with broken vectors can never be found and are left out. ``keep`` names columns
    of the items that predicates of a search may be about.
    """
    if metric not in INDEXED_METRICS:
        raise ValueError(f"no cell index for metric {metric!r}")
    keep = keep or []
    base = items.where(V.finite("embedding")).select("id", "embedding", "history_value", *keep)
    tops = None
    if metric == "dot_product":
        vector = V.as_double("embedding")
        largest = base.agg(F.max(F.sqrt(V.dot(vector, vector)))).first()[0] or 0.0
        # Norms the training did not see belong to the last band.
        tops = np.where(centroids.tops == centroids.tops.max(), max(largest, centroids.tops.max()) * (1 + SLACK), centroids.tops)
        centroids = centroids.centroids
    schema = T.StructType(
        base.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tiles(batches, len(centroids)):
            m = prepared(batch["embedding"], metric)
            if tops is None:
                d = distances(m, centroids)
            else:
                m, own = _lifted(m, tops)
                d = np.where(own, distances(m, centroids), np.inf)
            cell = d.argmin(1)
            columns = [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    assigned = stage(base.mapInArrow(assign, schema))
    rows = max(block_floats // max(embedding_width(items), 1), 1)
    cells = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    sizes, radius = np.zeros(len(centroids), dtype=np.int64), np.zeros(len(centroids))
    for r in cells:
        sizes[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    parts = -(-sizes // rows)
    first = np.cumsum(parts) - parts
    listed = pa.table({"cell": pa.array(np.arange(len(parts)), pa.int32()), "first_unit": first, "n_parts": parts})
    cell_table = F.broadcast(items.sparkSession.createDataFrame(listed).where("n_parts > 0"))
    part = F.pmod(F.xxhash64("id"), F.col("n_parts"))
    indexed = assigned.join(cell_table, "cell").withColumn("unit", (F.col("first_unit") + part).cast("int"))
    numbers = F.explode(F.sequence(F.col("first_unit"), F.col("first_unit") + F.col("n_parts") - 1))
    units = cell_table.select("cell", numbers.alias("unit")).select("cell", F.col("unit").cast("int").alias("unit"))
    units = broadcast_if_small(units)
    zones, bounds = _zones(indexed, keep)
    kept = indexed.select("id", "embedding", "history_value", *keep, "unit")
    return Index(kept, units, centroids, radius, sizes, metric, rows, tops=tops, zones=zones, bounds=bounds)


def _zones(indexed: DataFrame, keep: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """What the kept columns' values are in each unit."""
    if not keep:
        return None, None
    values = indexed.groupBy("cell", "unit", *keep).agg(F.count(F.lit(1)).alias("n"))
    extremes = [f(c).alias(f"{name}_{c}") for c in keep for f, name in ((F.min, "min"), (F.max, "max"))]
    bounds = stage(
        values.groupBy("cell", "unit").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) <= ZONE_VALUES).alias("few"), *extremes)
    )
    few = bounds.where("few").select("unit")
    return stage(values.join(few, "unit", "left_semi").select("unit", *keep, "n")), bounds


def restrict_index(index: Index, predicate: Column | None = None, ranges: dict[str, tuple] | None = None) -> Index:
    """The index of the items for which ``predicate``, on kept columns, holds.

    ``ranges`` gives smallest and largest values of columns (None: no limit), which also
    must hold. Units without such items are ruled out before a search: by their
    values where these are few, by their smallest and largest values elsewhere. Cells
    count with the items that qualify, so that enough of them are visited.
    """
    if index.bounds is None:
        raise ValueError("the index keeps no columns")
    wanted, possible = F.lit(True) if predicate is None else predicate, F.lit(True)
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            wanted, possible = wanted & (F.col(column) >= low), possible & (F.col(f"max_{column}") >= low)
        if high is not None:
            wanted, possible = wanted & (F.col(column) <= high), possible & (F.col(f"min_{column}") <= high)
    counted = index.zones.where(wanted).groupBy("unit").agg(F.sum("n").alias("_n"))
    left = index.bounds.where(possible).join(counted, "unit", "left").withColumn("n", F.when(F.col("few"), F.col("_n")).otherwise(F.col("n")))
    left = stage(left.where("n > 0").select("cell", "unit", "n"))
    sizes = np.zeros(len(index.sizes), dtype=np.int64)
    for r in left.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # one row per cell
        sizes[r["cell"]] = r["n"]
    units = broadcast_if_small(left.select("cell", "unit"))
    return replace(index, items=index.items.where(wanted), units=units, sizes=sizes, restricted=True)


def write_index(index: Index, path: str) -> None:
    """Stores an index for later jobs: items in one folder per unit, and what is known of cells."""
    index.items.repartition("unit").write.mode("overwrite").partitionBy("unit").parquet(f"{path}/items")
    index.units.write.mode("overwrite").parquet(f"{path}/units")
    cells = [(i, c.tolist(), float(r), int(n)) for i, (c, r, n) in enumerate(zip(index.centroids, index.radius, index.sizes))]
    tops = [None] * len(cells) if index.tops is None else index.tops.tolist()
    cells = [(*cell, top) for cell, top in zip(cells, tops)]
    schema = "cell int, centroid array<double>, radius double, n long, top double"
    table = local_table(index.items.sparkSession, cells, schema)
    for name, rows in (("zones", index.zones), ("bounds", index.bounds)):
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{path}/{name}")
    table.withColumns({"metric": F.lit(index.metric), "unit_rows": F.lit(index.unit_rows)}).write.mode("overwrite").parquet(f"{path}/cells")


def read_index(spark: SparkSession, path: str) -> Index:
    """A stored index; a search reads the units it visits only."""
    # One row per cell.
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    items = spark.read.parquet(f"{path}/items")
    kept = set(items.columns) > {"id", "embedding", "history_value", "unit"}
    return Index(
        items,
        broadcast_if_small(spark.read.parquet(f"{path}/units")),
        np.array([r["centroid"] for r in cells]),
        np.array([r["radius"] for r in cells]),
        np.array([r["n"] for r in cells]),
        cells[0]["metric"],
        cells[0]["unit_rows"],
        stored=True,
        tops=None if cells[0]["top"] is None else np.array([r["top"] for r in cells]),
        zones=spark.read.parquet(f"{path}/zones") if kept else None,
        bounds=spark.read.parquet(f"{path}/bounds") if kept else None,
    )


def prepared(column, metric: str) -> np.ndarray:
    """Vectors in the space the cells live in."""
    m = matrix(column)
    return unit_rows(m) if metric == "cosine_sim" else m


def distances(m: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squares = (m * m).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * (m @ centroids.T)
    return np.sqrt(np.maximum(squares, 0))


def ivf_join(queries: DataFrame, index: Index, n_probe: int | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Top-k join through the index; arguments and result as ``knn_join``."""
    queries = queries.where(V.finite("embedding"))
    if exclude is not None:
        exclude = stage(matching_types(exclude, queries, index.items).distinct())
    first = stage(_probe_first(queries, index, n_probe, exclude))
    found = _search_cells(first, index, exclude)
    if n_probe is not None:
        return found
    found = stage(found)
    worst = F.max("score") if index.metric == "euclidean_dist" else F.min("score")
    # A query short of top_k results has no limit: all other cells may add to it.
    limits = found.groupBy(*QUERY_KEYS).agg(worst.alias("limit"), F.count(F.lit(1)).alias("n_found"))
    limited = first.join(limits, QUERY_KEYS, "left")
    limited = limited.withColumn("limit", F.when(F.col("n_found") >= F.col("top_k"), F.col("limit"))).drop("n_found")
    rest = stage(_probe_rest(limited, index))
    more = _search_cells(rest, index, exclude)
    by_query = Window.partitionBy(*QUERY_KEYS).orderBy(best_first(index.metric), F.asc("id"))
    ranked = found.unionByName(more).withColumn("rank", F.row_number().over(by_query))
    return ranked.where(F.col("rank") <= F.col("top_k"))


def tiles(batches: Iterator[pa.RecordBatch], n_cells: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their distances to all cells fit in memory."""
    step = max(1, TILE_CELLS // n_cells)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _map_cells(queries: DataFrame, schema: T.StructType, choose, index: Index) -> DataFrame:
    """Replace or add the column ``cells`` by a function of a batch and its vectors."""
    metric, n_cells, index_tops = index.metric, len(index.centroids), index.tops

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tiles(batches, n_cells):
            m = prepared(batch["embedding"], metric)
            chosen = choose(batch, m if index_tops is None else np.concatenate([m, np.zeros((len(m), 1))], axis=1))
            rows, cells = np.nonzero(chosen)
            offsets = np.searchsorted(rows, np.arange(len(chosen) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells, pa.int32()))
            columns = [lists if n == "cells" else batch[n] for n in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return queries.mapInArrow(run, schema)


def _with_cells(schema: T.StructType, drop: tuple[str, ...] = ()) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in ("cells", *drop)]
    return T.StructType(fields + [T.StructField("cells", T.ArrayType(T.IntegerType()))])


def _probe_first(queries: DataFrame, index: Index, n_probe: int | None, exclude: DataFrame | None) -> DataFrame:
    """``n_probe`` nearest cells, or as many as hold enough items for an answer."""
    centroids, sizes, widen = index.centroids, index.sizes, index.restricted
    drop: tuple[str, ...] = ()
    if (n_probe is None or widen) and exclude is not None:
        hidden = exclude.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_hidden"))
        queries = queries.join(hidden, "session_id", "left")
        drop = ("n_hidden",)

    def choose(batch: pa.RecordBatch, m: np.ndarray) -> np.ndarray:
        d = np.where(sizes > 0, distances(m, centroids), np.inf)
        order = d.argsort(axis=1, kind="stable")
        ordered = sizes[order]
        take = np.broadcast_to(np.arange(d.shape[1]) < (n_probe or 0), d.shape)
        if n_probe is None or widen:
            # As few of a cell's items may qualify: as many cells as hold enough of them.
            need = batch["top_k"].to_numpy().astype(np.int64)
            if drop:
                need = need + np.nan_to_num(batch["n_hidden"].to_numpy(zero_copy_only=False)).astype(np.int64)
            take = take | (np.cumsum(ordered, axis=1) - ordered < need[:, None])
        chosen = np.zeros(d.shape, dtype=bool)
        np.put_along_axis(chosen, order, take & (ordered > 0), axis=1)
        return chosen

    return _map_cells(queries, _with_cells(queries.schema, drop), choose, index)


def _probe_rest(limited: DataFrame, index: Index) -> DataFrame:
    """Cells not yet visited that may hold something better than the limit."""
    centroids, sizes, radius, metric, tops = index.centroids, index.sizes, index.radius, index.metric, index.tops

    def choose(batch: pa.RecordBatch, m: np.ndarray) -> np.ndarray:
        limit = batch["limit"].to_numpy(zero_copy_only=False).astype(np.float64)
        if metric == "cosine_sim":
            limit = np.sqrt(np.maximum(2 - 2 * (limit - SLACK), 0))
        limit, rounding = limit[:, None], 1e-7
        if tops is not None:
            squares = (m * m).sum(1)[:, None] + (tops * tops)[None, :]
            limit = np.sqrt(np.maximum(squares - 2 * (limit - SLACK), 0))
            rounding = 1e-7 * (1 + np.sqrt(squares))
        limit = np.where(np.isnan(limit), np.inf, limit + SLACK)
        nearest = distances(m, centroids) - radius[None, :] - rounding
        chosen = (nearest <= limit) & (sizes > 0)[None, :]
        visited = batch["cells"]
        row = np.repeat(np.arange(len(m)), np.asarray(visited.value_lengths()))
        chosen[row, visited.flatten().to_numpy()] = False
        return chosen

    return _map_cells(limited, _with_cells(limited.schema, ("limit",)), choose, index)


def _search_cells(probes: DataFrame, index: Index, exclude: DataFrame | None) -> DataFrame:
    """Search the cells each query lists."""
    visits = probes.withColumn("cell", F.explode("cells")).drop("cells").join(index.units, "cell").drop("cell")
    # As many query groups per unit as its visitors fill: one row per unit.
    groups = visits.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / index.unit_rows).cast("int").alias("groups"))
    groups = broadcast_if_small(groups)
    stored_items = index.items
    if index.stored:
        # At most as many rows as the index has units.
        stored_items = stored_items.where(F.col("unit").isin([r["unit"] for r in groups.select("unit").collect()]))

    def in_group(run):
        return F.pmod(F.xxhash64("session_id", run), F.col("groups")).cast("int")

    run = F.floor(F.col("q_idx") / QUERY_RUN)
    query_side = visits.join(groups, "unit").withColumn("grp", in_group(run)).drop("groups")
    item_side = stored_items.join(groups, "unit")
    item_side = item_side.withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    skips = None
    if exclude is not None:
        homes = index.items.select("history_value", "unit").distinct()
        runs = probes.select("session_id", F.floor(F.col("q_idx") / QUERY_RUN).alias("run")).distinct()
        placed = salted_join(exclude, homes, "history_value", ["session_id"]).join(groups, "unit")
        skips = placed.join(runs, "session_id").withColumn("grp", in_group(F.col("run")))
    return search_units(query_side, item_side, index.metric, skips)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact results that an approximate search has found."""
    hit = found.select(*QUERY_KEYS, "id").withColumn("hit", F.lit(1))
    both = exact.select(*QUERY_KEYS, "id").join(hit, [*QUERY_KEYS, "id"], "left")
    return both.agg(F.count(F.lit(1)).alias("expected"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
