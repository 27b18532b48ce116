"""Embedding whitening from exact, bit-sliced cross-products.

Entries become fixed-point integers. Each task shifts a block's dimensions to start at 0
and packs their bit planes across rows into 64-bit words; weighted counts of the set bits
of two planes' conjunction are the exact cross-products of the block. Their sums over all
blocks are centred as integers, and only then become a covariance matrix of doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An entry c is read as floor(SCALE * c) + OFFSET.
SCALE = 1024
OFFSET = 100_000

COMPONENTS = 8
#: Scaled entries are kept within this range, so that differences fit 64 bits.
LARGEST = 1 << 61
#: Rows whose planes are compared at a time; 64 of them share a word.
BLOCK_ROWS = 1 << 14
#: Exact sums travel as four numbers of 40 bits, the last one signed.
LIMBS, LIMB_BITS = 4, 40


@dataclass
class Whitening:
    """Exact sums and what follows from them; the model is as wide as the vectors."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]

    @property
    def scales(self) -> np.ndarray:
        """Factors to unit variance; not a number for a component without variance."""
        least = len(self.covariance) * np.finfo(float).eps * max(self.values[0], 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > least, 1 / np.sqrt(self.values), np.nan)


def fixed_point(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors' entries as integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    with np.errstate(over="ignore"):
        scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64).reshape(-1, width) + OFFSET


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bit ``i`` of column ``a`` of non-negative values, packed over rows: ``planes[i, a]``."""
    bits = max(int(values.max()).bit_length(), 1)
    padded = np.zeros((values.shape[1], -(-len(values) // 64) * 64), np.int64)
    padded[:, : len(values)] = values.T
    planes = [np.packbits((padded >> i & 1).astype(np.uint8), axis=1).view(np.uint64) for i in range(bits)]
    return np.stack(planes)


def cross_products(planes: np.ndarray, rows: int) -> np.ndarray:
    """Sums over rows of the products of all pairs of columns, as Python integers."""
    bits, width, words = planes.shape
    exact = 2 * bits + rows.bit_length() + 1 < 63
    kind = np.int64 if exact else object
    weights = np.array([1 << i for i in range(bits)], kind)[:, None]
    flat = planes.reshape(bits * width, words)
    upper, own = np.zeros((width, width), kind), np.zeros(width, kind)
    counts = np.zeros(bits * width, np.int64)
    for p in range(len(flat)):
        bit, column = divmod(p, width)
        counts[:p] = 0
        counts[p:] = np.bitwise_count(flat[p:] & flat[p]).sum(1, dtype=np.int64)
        upper[column] += (counts.reshape(bits, width).astype(kind) * weights).sum(0) * (1 << bit)
        own[column] += kind(counts[p]) * (1 << 2 * bit) if exact else int(counts[p]) << 2 * bit
    # Every pair of different planes was counted once, and a plane with itself once.
    return (upper + upper.T - np.diag(own)).astype(object)


def block_scatter(x: np.ndarray) -> np.ndarray:
    """Exact cross-products of a block's rows, each lengthened by a one: so the last
    row holds the sums, and its last entry the number of rows."""
    least = x.min(0)
    shifted = np.concatenate([x - least, np.ones((len(x), 1), np.int64)], axis=1)
    products = cross_products(bit_planes(shifted), len(x))
    shift = np.array([*least.tolist(), 0], object)
    cross = np.outer(shift, products[-1])
    return products + cross + cross.T + np.outer(shift, shift) * len(x)


def _scatter_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, waiting = None, 0, []

        def add() -> None:
            nonlocal total, held, waiting
            block = block_scatter(np.concatenate(waiting))
            total = block if total is None else total + block
            held, waiting = 0, []

        for batch in batches:
            x = fixed_point(batch.column(0), width)
            for k in range(0, len(x), BLOCK_ROWS):
                waiting.append(x[k : k + BLOCK_ROWS])
                held += len(waiting[-1])
                if held >= BLOCK_ROWS:
                    add()
        if held:
            add()
        if total is not None:
            a, b = np.triu_indices(width + 1)
            rest, limbs = total[a, b], []
            for _ in range(LIMBS - 1):
                limbs.append(pa.array((rest & ((1 << LIMB_BITS) - 1)).tolist(), pa.int64()))
                rest = rest >> LIMB_BITS
            limbs.append(pa.array(rest.tolist(), pa.int64()))
            names = ["a", "b", *(f"limb{k}" for k in range(LIMBS))]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), *limbs], names=names)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``_id, _vector`` of the rows whose vector has entries, all of them finite numbers."""
    plain = vectors.select(F.col("vec_id").alias("_id"), F.col("embedding").cast("array<double>").alias("_vector"))
    finite = F.forall("_vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return plain.where((F.size("_vector") > 0) & finite)


def common_width(vectors: DataFrame) -> int | None:
    """The width most usable vectors have, the larger one of two."""
    widths = vectors.groupBy(F.size("_vector").alias("width")).count()
    row = widths.orderBy(F.desc("count"), F.desc("width")).first()
    return row.width if row else None


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The model of all ``vectors`` (as ``usable`` gives them) of this width.

    What the driver gets is one row per pair of dimensions, whatever the number of vectors.
    """
    limbs = [f"limb{k}" for k in range(LIMBS)]
    schema = "a int, b int, " + ", ".join(f"{name} long" for name in limbs)
    rows = vectors.where(F.size("_vector") == width).select("_vector").mapInArrow(_scatter_rows(width), schema)
    sums = rows.groupBy("a", "b").agg(*(F.sum(name).alias(name) for name in limbs)).toArrow()
    products: dict[tuple[int, int], int] = {}
    for a, b, *parts in zip(*(sums.column(c).to_pylist() for c in ["a", "b", *limbs]), strict=True):
        products[a, b] = sum(part << LIMB_BITS * k for k, part in enumerate(parts))
    n, total = products[width, width], [products[a, width] for a in range(width)]
    covariance = np.empty((width, width))
    for a in range(width):
        for b in range(a, width):
            # Integers up to the one division, which is rounded correctly.
            covariance[a, b] = covariance[b, a] = (n * products[a, b] - total[a] * total[b]) / (n * n)
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(n * products[a, a] - total[a] ** 2 for a in range(width)) / (n * n)
    explained = [max(float(values[k]), 0.0) / trace if trace else 0.0 for k in order]
    return Whitening(n, total, covariance, values[order], directions[:, order], explained)


def _deviations(offsets: np.ndarray, remainders: list[int], n: int) -> tuple[pa.Array, pa.Array]:
    """Sums of (n * offset - remainder)^2 over dimensions: as 64-bit numbers, null where
    they don't fit, and as decimals of 38 digits."""
    width = offsets.shape[1]
    far = max(int(np.abs(offsets).max()), 1)
    most = max(map(abs, remainders)) or 1
    constant = sum(r * r for r in remainders)
    if width * (n * far + most) ** 2 < 1 << 62:
        squares = ((n * offsets - np.array(remainders, np.int64)) ** 2).sum(1)
        exact = pa.array(squares, pa.int64())
        return exact, exact.cast(pa.decimal128(38, 0))
    if width * far * max(far, most) < 1 << 62:
        squares, mixed = (offsets**2).sum(1).tolist(), (offsets * np.array(remainders, np.int64)).sum(1).tolist()
    else:
        whole = offsets.astype(object)
        squares, mixed = (whole**2).sum(1).tolist(), (whole * np.array(remainders, object)).sum(1).tolist()
    sums = [n * n * s - 2 * n * m + constant for s, m in zip(squares, mixed)]
    # Texts on their way to decimals: Python's own would be rounded to a context.
    digits = pa.array([str(s) if s < 10**38 else None for s in sums], pa.string())
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64()), pc.cast(digits, pa.decimal128(38, 0))


def _project(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Whitening = shared.value
        width = len(model.sums)
        centre = [(2 * s + model.n) // (2 * model.n) for s in model.sums]
        remainders = [s - model.n * c for s, c in zip(model.sums, centre)]
        fractions = np.array([r / model.n for r in remainders])
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = fixed_point(batch.column(1), width) - np.array(centre, np.int64)
            whitened = (offsets - fractions) @ model.vectors * model.scales
            places = np.arange(len(whitened) + 1, dtype=np.int32) * whitened.shape[1]
            flat = pa.array(whitened.ravel(), pa.float64(), from_pandas=True)
            rows = pa.ListArray.from_arrays(pa.array(places), flat)
            exact, wide = _deviations(offsets, remainders, model.n)
            yield pa.RecordBatch.from_arrays([batch.column(0), exact, wide, rows], names=["vec_id", "deviation", "deviation_exact", "whitened"])

    return run


def identity_error(projected: DataFrame, model: Whitening) -> float | None:
    """Largest entry by which the covariance of the whitened values differs from the identity,
    over components with variance; null without any."""
    used = [k for k, scale in enumerate(model.scales) if np.isfinite(scale)]
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return None
    column = [F.get("whitened", F.lit(k)) for k in range(len(model.scales))]
    found = projected.agg(*(F.covar_pop(column[i], column[j]).alias(f"{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact``
    of each usable row and component, by falling variance.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and
    rows of another width than most (they are vectors of another space). Repeated rows
    count and are returned each by itself; a null id stays null. Entries beyond 2^61 / 1024
    are read as that. ``deviation`` is null where it doesn't fit 64 bits;
    ``deviation_exact`` has 38 digits. A component without variance has a null ``whitened``.
    Equal variances are numbered in the order eigh gives them. An empty table gives no rows;
    columns other than ``vec_id`` and ``embedding`` are not read.
    """
    spark = vectors.sparkSession
    kept = usable(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    width = common_width(kept)
    schema = f"vec_id {kind}, deviation long, deviation_exact decimal(38,0), whitened array<double>"
    if width is None:
        projected, model, error = spark.createDataFrame([], schema), None, None
    else:
        model = fit(kept, width, components)
        projected = kept.where(F.size("_vector") == width).mapInArrow(_project(spark.sparkContext.broadcast(model)), schema)
        error = identity_error(projected, model)
    explained = F.array(*(F.lit(e) for e in model.explained)) if model else F.array().cast("array<double>")
    rows = projected.select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("_place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact",
    )
