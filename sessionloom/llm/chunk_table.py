"""SentencePiece ids and texts through a table of distinct chunks.

Where no piece of a model crosses from other characters to a white space marker, a text's
segmentation falls apart before each run of markers. Every slice of texts is cut there by
numpy, its chunks become a dictionary-encoded column, each distinct chunk is segmented
once, and its ids go back to all its places by index. So texts never leave their task:
dealing their chunks to a common table would shuffle several times what is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.encode import no_collector
from sessionloom.llm.words import text_slices

MARKER = "▁"
#: Bytes of text whose distinct chunks form one table.
SLICE_BYTES = 4 << 20

# Texts on which cutting must agree with the whole; all kinds of white space,
# compositions, byte fallback, control pieces and runs of markers.
PROBES = [
    "", " ", "  ", "a", " a", "a ", "  a   b ", "a▁b", "▁", "▁ ▁x", "a\tb\n c\r\n", "　x  y",
    "ﬁ ½ é é ①", "<s> </s> <unk> <0x41>", "\U0001f600 漢字。 \u0000 \u0007", "A b  CC   dd" + " " * 40 + "e",
]


class ChunkEncoder:
    """Ids and decoded texts by a model; ``cuts`` tells whether chunks may be segmented alone."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        # What each id adds to a list of ids and to a decoded text.
        self._digits = pa.array([b" %d" % k for k in range(len(pieces))], pa.large_binary())
        self._bytes = pa.array([self._decoded(k, piece) for k, piece in enumerate(pieces)], pa.large_binary())
        self.cuts = not any(MARKER in piece.lstrip(MARKER) for piece in pieces) and self._agrees()

    def _decoded(self, k: int, piece: str) -> bytes:
        if self.model.is_byte(k):
            return bytes([int(piece[1:-1], 16)])
        return b"" if self.model.is_control(k) else piece.replace(MARKER, " ").encode()

    def _agrees(self) -> bool:
        whole = [self.model.encode(t, num_threads=1) for t in PROBES]
        cut = [[int(x) for x in ids.split()] for ids in self._joined(pa.array(PROBES))[1]]
        texts = [t.decode() for t in self._joined(pa.array(PROBES))[2]]
        return whole == cut and texts == [self.model.decode(ids) for ids in whole]

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks one after another, and how many each text has; texts with a space before them."""
        nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        texts = texts.fill_null("").cast(pa.large_string())
        marked = pc.if_else(pc.equal(texts, nothing), nothing, pc.binary_join_element_wise(nothing, texts, space))
        marked = marked.combine_chunks() if isinstance(marked, pa.ChunkedArray) else marked
        _, offsets, data = marked.buffers()
        bounds = np.frombuffer(offsets, np.int64)[marked.offset : marked.offset + len(marked) + 1]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        space = raw == 0x20
        # The marker itself in a text reads like a space; it has three bytes.
        wide = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)) if len(raw) > 2 else []
        begins, inside = space.copy(), space
        for place in (0, 1, 2) if len(wide) else ():
            inside[wide + place] = True
        begins[wide] = True
        begins[1:] &= ~inside[:-1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        places = np.append(starts, len(raw)).astype(np.int64)
        chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(raw)))
        return chunks, np.diff(np.searchsorted(starts, bounds))

    def _joined(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        chunks, sizes = self._cut(texts)
        table = chunks.dictionary_encode()
        # The model itself puts a marker before a text: the first one of a chunk is left to it.
        distinct = pc.utf8_slice_codeunits(table.dictionary, 1).to_numpy(zero_copy_only=False).tolist()
        found = self.model.encode(distinct, num_threads=1)
        alone = [self.model.piece_to_id(MARKER)]
        segmented = pa.array([ids or alone for ids in found], pa.large_list(pa.int32()))
        # Taken by place, the chunks' ids lie one behind the other.
        placed = segmented.take(table.indices)
        ends = placed.offsets.to_numpy()
        limits = ends[np.concatenate([[0], np.cumsum(sizes)])] - ends[0]
        ids = placed.flatten()
        return np.diff(limits), self._together(self._digits, ids, limits), self._together(self._bytes, ids, limits)

    def _together(self, of_each: pa.Array, ids: pa.Array, limits: np.ndarray) -> list[bytes]:
        """The entries of each text's ids, joined, without the space they begin with."""
        lists = pa.LargeListArray.from_arrays(pa.array(limits, pa.int64()), of_each.take(ids))
        return [x[1:] for x in pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).to_pylist()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Of each text the number of ids, the ids joined by spaces, and the decoded text."""
        if self.cuts:
            with no_collector():
                return self._joined(texts)
        ids = [self.model.encode(t or "", num_threads=1) for t in texts.to_pylist()]
        joined = [" ".join(map(str, x)).encode() for x in ids]
        return np.array([len(x) for x in ids], np.int64), joined, [self.model.decode(x).encode() for x in ids]


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _rows(path: str, finish, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path)
        end = encoder.model.eos_id()
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                counts, ids, decoded = encoder.encode(part.column("text"))
                ids = [b"%b %d" % (x, end) if x else b"%d" % end for x in ids]
                columns = [part.column("doc_id"), pa.array(counts + 1, pa.int64()), *finish(ids, decoded)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _whole(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    numbers = [np.array(x.split(), np.int32) for x in ids]
    return [pa.array(numbers, pa.list_(pa.int32())), pa.array([x.decode() for x in decoded], pa.string())]


def _digest(ids: list[bytes], decoded: list[bytes]) -> list[pa.Array]:
    return [pa.array([hashlib.sha256(x).hexdigest() for x in column], pa.string()) for column in (ids, decoded)]


def _mapped(docs: DataFrame, path: str, finish, names: list[str], kinds: list[pa.DataType], ddl: str) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *zip(names, kinds)])
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_rows(path, finish, schema), f"doc_id long, n_tokens long, {ddl}")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row, with the end id at the end.

    ``decoded`` is what the model makes of ``ids``: a white space marker in the text comes
    back as a space. A null text is empty: the end id alone, decoded as an empty text.
    Repeated rows and null ids are encoded each by itself; other columns are not read; an
    empty table gives no rows. A text is held whole by one task, however long; every slice
    has a table of its own, so memory is bounded by a slice or one text. Texts go whole
    through a model whose pieces cross markers or that rewrites texts.
    """
    kinds = [pa.list_(pa.int32()), pa.string()]
    return _mapped(docs, path, _whole, ["ids", "decoded"], kinds, "ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encoded`` gives, with hashes of
    the decimal ids joined by spaces and of the decoded text instead of both."""
    names = ["ids_sha256", "decoded_sha256"]
    return _mapped(docs, path, _digest, names, [pa.string()] * 2, "ids_sha256 string, decoded_sha256 string")


def _decode_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = chunk_encoder(path).model
        for batch in batches:
            texts = [model.decode([k for k in ids or [] if k is not None]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decoded(encoded_docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``ids``; null or no ids give an empty text."""
    plain = encoded_docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return plain.mapInArrow(_decode_rows(path), "doc_id long, text string")
