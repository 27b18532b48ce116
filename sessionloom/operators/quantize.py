"""Scalar quantizer: components are replaced by the index of a cut point.

A model is a table ``quantiles(level, cut)``, trained on all components pooled.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import QUANTIZER_LEVELS, local_table
from sessionloom.functions import vectors as V

METHODS = ("exact", "sketch")

# Size of the sketch of all components.
SKETCH_K = 2000
# Ranges the exact method counts at first, and each time it cuts those that are too full.
BINS = 4096
CUT_BINS = 1 << 16
# Most components in a range whose values are counted one by one.
BIN_VALUES = 1 << 17


def train_scalar_quantizer(vectors: DataFrame, levels: int = QUANTIZER_LEVELS, method: str = "exact") -> DataFrame:
    """Cut points at the quantiles ``i / levels``, i = 0 .. levels-1.

    ``exact`` interpolates linearly between neighbouring values; ``sketch`` takes
    mergeable KLL sketches and reads the data once. Components that are null or not
    finite are left out.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    fractions = [i / levels for i in range(levels)]
    if method == "exact":
        return exact_quantiles(vectors, fractions)
    return sketched_quantiles(vectors, fractions)


def sketched_quantiles(vectors: DataFrame, fractions: list[float]) -> DataFrame:
    """Quantiles from one KLL sketch of all components: ``(level, cut)``."""
    values = vectors.select(F.explode("embedding").alias("x")).select(F.col("x").cast("double").alias("x"))
    values = values.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")))
    sketch = values.agg(F.kll_sketch_agg_double("x", F.lit(SKETCH_K)).alias("s"), F.count("x").alias("n")).where("n > 0")
    ranks = F.lit(np.array(fractions, dtype=np.float64))
    return sketch.select(F.posexplode(F.kll_sketch_get_quantile_double("s", ranks)).alias("level", "cut"))


def exact_quantiles(vectors: DataFrame, fractions: list[float]) -> DataFrame:
    """Exact quantiles of all components, without sorting them: ``(level, cut)``.

    A sketch of all components gives the borders of ``BINS`` ranges, which are counted.
    Ranges that hold a wanted rank and too many components are cut between their least and
    greatest value and counted again. As they are cut by the order of floating-point
    numbers, each pass takes several bits off a range, whatever the distribution, and a
    value that occurs any number of times ends as a range of its own. Then the
    values of the ranges wanted, a bounded number for each, are counted one by one. The
    result does not depend on the borders.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("embedding")
    starts = np.concatenate([[-np.inf], _borders(vectors)])
    ends = np.full(len(starts), np.inf)
    found = _counted(vectors, starts, ends)
    n = int(found["c"].sum())
    if not n:
        raise ValueError("no values to train on")
    positions = [f * (n - 1) for f in fractions]
    wanted = np.array(sorted({int(p) for p in positions} | {min(int(p) + 1, n - 1) for p in positions}))
    value: dict[int, float] = {}
    base = np.concatenate([[0], np.cumsum(found["c"])[:-1]])
    while True:
        place = np.searchsorted(base, wanted, side="right") - 1
        lo, hi, c = (found[k][place] for k in ("lo", "hi", "c"))
        done = lo == hi
        value |= dict(zip(wanted[done].tolist(), lo[done].tolist()))
        wanted, place = wanted[~done], np.unique(place[~done])
        # Ranges that hold a rank; the next pass looks at these only.
        found, base = {k: v[place] for k, v in found.items()}, base[place]
        full = found["c"] > BIN_VALUES
        if not full.any():
            break
        pieces = max(2, CUT_BINS // len(place))
        cuts = [cut_range(a, b, pieces if f else 1) for a, b, f in zip(found["lo"], found["hi"], full)]
        starts = np.concatenate(cuts)
        ends = np.repeat(found["hi"], [len(x) for x in cuts])
        parts = _counted(vectors, starts, ends)
        # What lies below a piece: what lies below its range, and the pieces before it there.
        of = np.searchsorted(found["lo"], parts["lo"], side="right") - 1
        before = np.cumsum(parts["c"]) - parts["c"]
        first = np.concatenate([[True], of[1:] != of[:-1]])
        base = base[of] + before - before[first][np.cumsum(first) - 1]
        found = parts
    if len(wanted):
        place = np.searchsorted(base, wanted, side="right") - 1
        ranks: dict[int, list[int]] = {}
        for rank, j in zip(wanted.tolist(), place.tolist()):
            ranks.setdefault(j, []).append(rank - int(base[j]))
        values = vectors.mapInArrow(_values_in(found["lo"], found["hi"]), "bin int, x double, c long")
        distinct = values.groupBy("bin", "x").agg(F.sum("c").alias("c"))
        picked = distinct.groupBy("bin").applyInArrow(_picked(ranks), "bin int, rank long, x double").collect()
        value |= {int(base[r["bin"]]) + r["rank"]: r["x"] for r in picked}
    rows = []
    for level, p in enumerate(positions):
        a, b = value[int(p)], value[min(int(p) + 1, n - 1)]
        rows.append((level, float(a + (b - a) * (p - int(p)))))
    return local_table(spark, rows, "level int, cut double")


def _borders(vectors: DataFrame) -> np.ndarray:
    """Borders between about equally many components, in order."""
    return np.unique(sketched_quantiles(vectors, [i / (BINS - 1) for i in range(BINS)]).toArrow()["cut"].to_numpy())


def cut_range(lo: float, hi: float, pieces: int) -> np.ndarray:
    """Where ``pieces`` ranges from ``lo`` to ``hi`` begin, with equally many doubles in each."""
    a, b = (_place(x) for x in (lo, hi))
    places = sorted({a + (b - a + 1) * k // pieces for k in range(pieces)})
    return np.array([_double(x) for x in places])


def _place(x: float) -> int:
    """The number of a double in the order of all doubles, from 0 for zero."""
    bits = int(np.float64(x).view(np.int64))
    return bits if bits >= 0 else -(bits + (1 << 63))


def _double(place: int) -> float:
    value = np.int64(abs(place)).view(np.float64)
    return float(value if place >= 0 else -value)


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's finite components, sorted."""
    x = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.sort(x[np.isfinite(x)])


def _bounds(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in sorted ``x`` of each range, from its start to the next one's or its end."""
    first = np.searchsorted(x, starts, side="left")
    last = np.searchsorted(x, ends, side="right")
    return first, np.minimum(last, np.append(first[1:], len(x)))


def _counted(vectors: DataFrame, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Number, least and greatest of the components in each range that has any, in order.

    At most one row for each range comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(starts), dtype=np.int64)
        lo, hi = np.full(len(starts), np.inf), np.full(len(starts), -np.inf)
        for batch in batches:
            x = _flat(batch)
            first, last = _bounds(x, starts, ends)
            met = np.flatnonzero(last > first)
            counts[met] += (last - first)[met]
            lo[met] = np.minimum(lo[met], x[first[met]])
            hi[met] = np.maximum(hi[met], x[last[met] - 1])
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(lo[met]), pa.array(hi[met])]
        yield pa.RecordBatch.from_arrays(columns, names=["bin", "c", "lo", "hi"])

    counts = vectors.mapInArrow(run, "bin int, c long, lo double, hi double").groupBy("bin")
    rows = counts.agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow().sort_by("bin")
    return {name: rows[name].to_numpy() for name in ("c", "lo", "hi")}


def _values_in(starts: np.ndarray, ends: np.ndarray):
    """The different components in each range with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _flat(batch)
            first, last = _bounds(flat, starts, ends)
            number = np.repeat(np.arange(len(starts)), last - first)
            # The ranges are in order, so places of the batch are too.
            inside = np.concatenate([[0], np.cumsum(last - first)[:-1]])
            x = flat[np.arange(len(number)) - inside[number] + first[number]]
            new = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)
            c = np.diff(np.append(np.flatnonzero(new), len(x)))
            columns = [pa.array(number[new], pa.int32()), pa.array(x[new]), pa.array(c, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["bin", "x", "c"])

    return run


def _picked(ranks: dict[int, list[int]]):
    """The values at the wanted ranks of one range; it has at most ``BIN_VALUES`` rows."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("x")
        number = table["bin"][0].as_py()
        upto = np.cumsum(table["c"].to_numpy())
        wanted = ranks.get(number, [])
        x = table["x"].to_numpy()[np.searchsorted(upto, wanted, side="right")]
        return pa.table({"bin": pa.array([number] * len(wanted), pa.int32()), "rank": pa.array(wanted, pa.int64()), "x": pa.array(x, pa.float64())})

    return run


def rank_errors(vectors: DataFrame, quantiles: DataFrame) -> DataFrame:
    """How far each cut point's rank among all components is from ``level / levels``: ``(level, error)``.

    A cut point that occurs many times has all the ranks of its copies; the nearest counts.
    """
    cuts = cut_points(quantiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below, upto, n = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64), 0
        for batch in batches:
            x = _flat(batch)
            n += len(x)
            below += np.searchsorted(x, cuts, side="left")
            upto += np.searchsorted(x, cuts, side="right")
        columns = [pa.array(np.arange(len(cuts)), pa.int32()), pa.array(below), pa.array(upto), pa.array(np.full(len(cuts), n))]
        yield pa.RecordBatch.from_arrays(columns, names=["level", "below", "upto", "n"])

    counted = vectors.select("embedding").mapInArrow(run, "level int, below long, upto long, n long")
    total = counted.groupBy("level").agg(*(F.sum(c).alias(c) for c in ("below", "upto", "n"))).where("n > 0")
    target = F.col("level") / F.lit(len(cuts))
    off = F.greatest(F.col("below") / F.col("n") - target, target - F.col("upto") / F.col("n"), F.lit(0.0))
    return total.select("level", off.alias("error"))


def cut_points(quantiles: DataFrame) -> np.ndarray:
    """The model as an array: one number per level."""
    rows = quantiles.select("level", "cut").collect()
    return np.array([cut for _, cut in sorted(rows)])


def quantize(vectors: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Adds ``codes``: per component the first level whose cut exceeds it, else the last."""
    cuts = cut_points(quantiles)

    def encode(flat: np.ndarray) -> np.ndarray:
        codes = np.searchsorted(cuts, flat.astype(np.float64), side="right")
        return np.minimum(codes, len(cuts) - 1).astype(np.int16)

    return map_lists(vectors, "embedding", "codes", T.ShortType(), encode)


def dequantize(codes: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Adds ``decoded``: each code's cut point."""
    cuts = cut_points(quantiles)
    return map_lists(codes, "codes", "decoded", T.DoubleType(), lambda flat: cuts[flat])


def map_lists(df: DataFrame, source: str, target: str, element: T.DataType, fn) -> DataFrame:
    """Add a list column computed element by element, a whole Arrow batch at once."""
    schema = T.StructType(df.schema.fields + [T.StructField(target, T.ArrayType(element))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch[source]
            sizes = np.asarray(lists.value_lengths())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(fn(flat)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

    return df.mapInArrow(run, schema)


def reconstruction_error(decoded: DataFrame) -> DataFrame:
    """L1 distance of each vector to its decoded form, and over all vectors."""
    each = decoded.select(V.l1_distance("embedding", "decoded").alias("l1"))
    return each.agg(
        F.count(F.lit(1)).alias("vectors"), F.avg("l1").alias("mean_l1"), F.max("l1").alias("max_l1")
    )
