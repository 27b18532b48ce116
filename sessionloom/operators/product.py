"""Product quantizer: slices of a vector are replaced by their nearest centroid.

A second quantizer encodes what the first leaves over. The model is a table
``codebook(stage, m, code, centroid)``; a training round is one pass over the
vectors for all slices together.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import local_table, stage
from sessionloom.operators.knn import matrix

CODEBOOK = "stage int, m int, code int, centroid array<double>"


def train_product_quantizer(
    vectors: DataFrame, n_slices: int = 32, n_codes: int = 256, rounds: int = 20, seed: int = 0
) -> DataFrame:
    """Codebook of both stages; the width has to divide by ``n_slices``."""
    width = vectors.select(F.size("embedding")).first()[0]
    if width % n_slices:
        raise ValueError("the vector width must be divisible by the number of slices")
    points = stage(vectors.select("id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding")))
    first = _fit(points, n_slices, n_codes, rounds, seed)
    residuals = stage(_residuals(points, first))
    second = _fit(residuals, n_slices, n_codes, rounds, seed)
    rows = [
        (s, m, k, book[m, k].tolist())
        for s, book in enumerate((first, second))
        for m in range(book.shape[0])
        for k in range(book.shape[1])
    ]
    return local_table(vectors.sparkSession, rows, CODEBOOK)


def _fit(points: DataFrame, n_slices: int, n_codes: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's iterations; starts from vectors drawn by a seeded hash of their id.

    Only the centroids, as many numbers as ``n_codes`` vectors, reach the driver.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    start = points.select(draw.alias("h"), "id", "embedding").orderBy("h", "id").limit(n_codes).collect()
    width = len(start[0]["embedding"]) // n_slices
    book = np.array([r["embedding"] for r in start]).reshape(len(start), n_slices, width).transpose(1, 0, 2)
    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds):
        partial = points.select("embedding").mapInArrow(_partial_sums(book), "m int, code int, n long, s array<double>")
        totals = partial.groupBy("m", "code").agg(F.sum("n").alias("n"), *sums).collect()
        moved = book.copy()
        for row in totals:
            moved[row["m"], row["code"]] = np.array(row[3:]) / row["n"]
        if np.allclose(moved, book, atol=1e-12):
            break
        book = moved
    return book


def _partial_sums(book: np.ndarray):
    """Per partition: count and sum of the vectors assigned to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_slices, n_codes, width = book.shape
        sums, counts = np.zeros(book.shape), np.zeros((n_slices, n_codes), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            slices = matrix(batch["embedding"]).reshape(-1, n_slices, width)
            codes = nearest_codes(slices, book)
            for m in range(n_slices):
                np.add.at(sums[m], codes[:, m], slices[:, m])
                counts[m] += np.bincount(codes[:, m], minlength=n_codes)
        m, k = np.nonzero(counts)
        columns = [
            pa.array(m, pa.int32()),
            pa.array(k, pa.int32()),
            pa.array(counts[m, k]),
            pa.array(list(sums[m, k]), pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["m", "code", "n", "s"])

    return run


def nearest_codes(slices: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Index of the nearest centroid per row and slice, ties to the lower code."""
    codes = np.empty(slices.shape[:2], dtype=np.int64)
    for m in range(book.shape[0]):
        # The vector's own square is the same for all centroids.
        d = (book[m] ** 2).sum(1)[None, :] - 2 * (slices[:, m] @ book[m].T)
        codes[:, m] = d.argmin(1)
    return codes


def _decode(codes: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.concatenate([book[m][codes[:, m]] for m in range(book.shape[0])], axis=1)


def _residuals(points: DataFrame, book: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch["embedding"])
                left = v - _decode(nearest_codes(v.reshape(len(v), book.shape[0], -1), book), book)
                yield pa.RecordBatch.from_arrays([batch["id"], _lists(left)], names=["id", "embedding"])

    return points.mapInArrow(run, points.schema)


def _lists(m: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.reshape(-1)))


def codebooks(codebook: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The model as two (slice, code, width) arrays."""
    rows = sorted(codebook.select("stage", "m", "code", "centroid").collect())
    books = [[r for r in rows if r["stage"] == s] for s in (0, 1)]
    n_slices = rows[-1]["m"] + 1
    first, second = (np.array([r["centroid"] for r in b]).reshape(n_slices, len(b) // n_slices, -1) for b in books)
    return first, second


def pq_encode(vectors: DataFrame, codebook: DataFrame) -> DataFrame:
    """Adds ``codes`` and ``residual_codes``."""
    first, second = codebooks(codebook)
    short = T.ArrayType(T.ShortType())
    schema = T.StructType(
        vectors.schema.fields + [T.StructField("codes", short), T.StructField("residual_codes", short)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch["embedding"])
            codes = nearest_codes(v.reshape(len(v), first.shape[0], -1), first)
            left = v - _decode(codes, first)
            residual = nearest_codes(left.reshape(len(v), second.shape[0], -1), second)
            columns = [_lists(codes.astype(np.int16)), _lists(residual.astype(np.int16))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return vectors.mapInArrow(run, schema)


def pq_decode(codes: DataFrame, codebook: DataFrame) -> DataFrame:
    """Adds ``decoded``: the sum of both stages, in full width."""
    first, second = codebooks(codebook)
    schema = T.StructType(codes.schema.fields + [T.StructField("decoded", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = [matrix(batch[c]).astype(int) for c in ("codes", "residual_codes")]
                total = _decode(parts[0], first) + _decode(parts[1], second)
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(total)], names=schema.names)

    return codes.mapInArrow(run, schema)
