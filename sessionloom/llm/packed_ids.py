"""Packed token-id matrices: best-fit rows of ids, segment limits and position resets."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.best_fit import as_batches, best_fit, cut_pieces
from sessionloom.llm.encode import byte_encoder
from sessionloom.llm.words import text_slices

CAPACITY = 2048
END_ID = 50256
#: Bytes of text whose pieces one task packs, on average.
SHARD_BYTES = 16 << 20

_PIECES = pa.schema(
    [("shard", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
)
PIECES_SCHEMA = "shard int, doc_id long, piece int, start long, length long, ids binary"
PACKED_SCHEMA = (
    "sequence_id long, n_ids int, ids binary, positions binary, cu_lengths array<int>, doc_ids array<long>, pieces array<int>, starts array<long>"
)


def _dealt(path: str, pattern: str, capacity: int, shards: int):
    """Pieces of the ids of every whole text and an end id, dealt to shards in turn."""
    end = END_ID.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, turn = byte_encoder(path, pattern), TaskContext.get().partitionId() * 7919
        for batch in batches:
            for part in text_slices(batch):
                ids = [x + end for x in encoder.encode(part.column("text"))]
                pieces = list(cut_pieces(ids, part.column("doc_id").to_pylist(), capacity, 2))
                rows = (((turn + k) % shards, *piece) for k, piece in enumerate(pieces))
                yield from as_batches(rows, _PIECES)
                turn += len(pieces)
        encoder.forget()

    return run


def _matrix(capacity: int):
    """The packed rows of one shard."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        shard = table.column("shard")[0].as_py()
        ids = table.column("ids").to_pylist()
        doc_ids, pieces, starts = (table.column(c).to_pylist() for c in ("doc_id", "piece", "start"))
        # One order whatever order the rows came in.
        order = sorted(range(len(ids)), key=lambda k: (doc_ids[k] is None, doc_ids[k] or 0, pieces[k], zlib.crc32(ids[k])))
        lengths = np.array([len(ids[k]) // 2 for k in order], np.int64)
        bins, offsets = best_fit(lengths, capacity)
        rows: list[list[int]] = [[] for _ in range(int(bins.max()) + 1)]
        for k in np.argsort(offsets, kind="stable").tolist():
            rows[bins[k]].append(k)
        out = []
        for number, members in enumerate(rows):
            own = [order[k] for k in members]
            sizes = lengths[members]
            packed = b"".join([ids[k] for k in own])
            filler = b"\0" * (capacity * 2 - len(packed))
            ramps = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out.append(
                (
                    (shard << 32) + number,
                    len(packed) // 2,
                    packed + filler,
                    ramps.astype("<u2").tobytes() + filler,
                    [0, *np.cumsum(sizes).tolist()],
                    [doc_ids[k] for k in own],
                    [pieces[k] for k in own],
                    [starts[k] for k in own],
                )
            )
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = ["sequence_id", "n_ids", "ids", "positions", "cu_lengths", "doc_ids", "pieces", "starts"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds, strict=True)})

    return run


def packed_ids(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``capacity`` ids, filled with whole documents or pieces of overlong ones.

    ``ids`` and ``positions`` hold ``capacity`` little-endian 16-bit numbers, zeros after
    the first ``n_ids``; positions start at 0 in every segment. Segment ``k`` lies at
    ``cu_lengths[k]`` to ``cu_lengths[k + 1]`` and is piece ``pieces[k]`` of document
    ``doc_ids[k]``, which it continues from id ``starts[k]`` on. Every document ends with
    the end id; a null or empty text is the end id alone. Repeated rows are packed each
    by itself; other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 2)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    pieces = docs.mapInArrow(_dealt(path, pattern, capacity, shards), PIECES_SCHEMA)
    return pieces.groupBy("shard").applyInArrow(_matrix(capacity), PACKED_SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes packed rows as an uncompressed Parquet table."""
    packed.write.option("compression", "none").parquet(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            limits = row["cu_lengths"]
            parts = [row["ids"][2 * lo : 2 * hi] for lo, hi in zip(limits, limits[1:])]
            rows += zip(row["doc_ids"], row["pieces"], row["starts"], parts)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def unpacked(packed: DataFrame) -> DataFrame:
    """``doc_id, piece, start, ids`` of every segment of packed rows."""
    columns = ["ids", "cu_lengths", "doc_ids", "pieces", "starts"]
    return packed.select(*columns).mapInArrow(_unpacked, "doc_id long, piece int, start long, ids binary")
