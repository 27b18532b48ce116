"""Best-fit-decreasing packing with a segment tree over remaining capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.config import stage
from sessionloom.llm.encode import word_encoder
from sessionloom.llm.words import text_slices

CAPACITY = 4096
END_ID = 1
#: Pieces one task packs together, on average.
SHARD_PIECES = 4096
#: Bins with more room left than this part of the capacity are packed once more.
LOOSE = 64
#: Bytes of texts whose words are told apart together.
TEXT_BYTES = 1 << 23
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"


class OpenBins:
    """Open bins by remaining capacity; the tree's leaves count them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, left: int, by: int) -> None:
        node = left + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def add(self, number: int, left: int) -> None:
        self.bins[left].append(number)
        if len(self.bins[left]) == 1:
            self._count(left, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest bin with room for ``need``, and its room; it is open no more."""
        node = need + self.leaves
        while not self.tree[node]:
            while node & 1:  # nothing at the right below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            node += not self.tree[node]
        left = node - self.leaves
        number = self.bins[left].pop()
        if not self.bins[left]:
            self._count(left, -1)
        return number, left


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, which are taken in falling order; ties as they come."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, tree = 0, OpenBins(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            found, opened = (opened, capacity), opened + 1
        number, left = found
        bins[i], offsets[i] = number, capacity - left
        if left > length:
            tree.add(number, left - length)
    return bins, offsets


def cut_pieces(ids: list[bytes], doc_ids: list, capacity: int, width: int) -> Iterator[tuple]:
    """(document, piece, start, length, ids) of id strings of ``width`` bytes an id."""
    for doc_id, own in zip(doc_ids, ids, strict=True):
        for piece, at in enumerate(range(0, len(own), capacity * width)):
            part = own[at : at + capacity * width]
            yield doc_id, piece, at // width, len(part) // width, part


def as_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema, strict=True)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema, strict=True)], schema=schema)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The ids of every whole text and an end id, cut into pieces of ``capacity``.

    A null or empty text is the end id alone. Repeated rows give pieces of their own.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            for part in text_slices(batch, limit=TEXT_BYTES):
                ids = [x + end for x in encoder.encode(part.column("text"))]
                yield from as_batches(cut_pieces(ids, part.column("doc_id").to_pylist(), capacity, 4), schema)
        encoder.forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES_SCHEMA)


def _pack_round(pieces: DataFrame, capacity: int, number: int) -> DataFrame:
    """One packing of all pieces, by shards dealt out in turn."""
    schema = T.StructType([*pieces.drop("shard").schema.fields, *T._parse_datatype_string("sequence_id long, offset long, room long").fields])

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        table = table.drop_columns(["shard"])
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        ids = (np.int64(number) << 56) + (np.int64(shard) << 28) + bins
        for name, values in (("sequence_id", ids), ("offset", offsets), ("room", capacity - filled[bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    return pieces.groupBy("shard").applyInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Shards of about ``shard_pieces`` pieces are packed by themselves; what lies in
    bins with room left over is dealt out anew and packed once more, until one shard
    holds all of it or a round brings nothing. Columns named like the two new ones
    are replaced; an empty table stays empty.
    """
    left = stage(pieces.drop("sequence_id", "offset", "room", "shard"))
    n, done, number = left.count(), [], 0
    while n:
        shards = -(-n // shard_pieces)
        dealt = left.withColumn("shard", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(shards)))
        packed = stage(_pack_round(dealt, capacity, number))
        loose = F.col("room") > capacity // LOOSE
        again = packed.where(loose).count()
        if shards == 1 or again > 0.7 * n or number == 3:
            done.append(packed.drop("room"))
            break
        done.append(packed.where(~loose).drop("room"))
        left, n, number = packed.where(loose).drop("sequence_id", "offset", "room"), again, number + 1
    if not done:
        return left.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Where every piece of every document lies, and a checksum of its ids."""
    pieces = token_pieces(docs, path, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
