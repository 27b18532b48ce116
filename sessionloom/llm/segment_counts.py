"""Edit-aware token counts: a segment tree over each document's text.

Leaves are runs of text cut where a pre-token is sure to begin: at a space before a
character that isn't white space, whatever stands before it. So leaves are counted by
themselves, and an edit concerns the leaves it touches and their cuts; their new text is
encoded again and the sums above them are updated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.encode import ByteEncoder, byte_encoder
from sessionloom.llm.words import text_slices

#: Characters of a leaf, about, and the length from which a leaf is split.
LEAF = 512
LARGE_LEAF = 4 * LEAF

TREE_COLUMNS = "leaves array<string>, chars array<long>, tokens array<long>"


class SumTree:
    """Sums over a list of numbers; node 1 holds all of them."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(0, (len(values) - 1).bit_length())
        self.nodes = [0] * self.size + list(values) + [0] * (self.size - len(values))
        for k in range(self.size - 1, 0, -1):
            self.nodes[k] = self.nodes[2 * k] + self.nodes[2 * k + 1]

    @classmethod
    def of(cls, nodes: list[int]) -> SumTree:
        tree = cls.__new__(cls)
        tree.size, tree.nodes = len(nodes) // 2, list(nodes)
        return tree

    @property
    def total(self) -> int:
        return self.nodes[1]

    def put(self, place: int, value: int) -> None:
        node = place + self.size
        change = value - self.nodes[node]
        while node and change:
            self.nodes[node] += change
            node >>= 1

    def find(self, position: int) -> tuple[int, int]:
        """The place whose range holds ``position``, and where that range starts."""
        position = max(0, min(position, self.total - 1))
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position - before >= self.nodes[node]:
                before += self.nodes[node]
                node += 1
        return node - self.size, before


def cut_leaves(text: str, encoder: ByteEncoder) -> tuple[list[str], list[int]]:
    """Leaves of a text and their numbers of tokens."""
    if not text:
        return [""], [0]
    parts = encoder.cut.split(text)
    counts = [len(encoder.encode_whole(parts[0])), *encoder.counts(parts[1:])]
    sizes = np.array([len(parts[0]), *[len(p) + 1 for p in parts[1:]]])
    starts = np.cumsum(sizes) - sizes
    first = np.flatnonzero(np.concatenate([[True], starts[1:] // LEAF != starts[:-1] // LEAF]))
    ends = np.append(starts[first][1:], len(text))
    leaves = [text[a:b] for a, b in zip(starts[first].tolist(), ends.tolist())]
    return leaves, np.add.reduceat(np.array(counts, np.int64), first).tolist()


class CountedText:
    """A text as leaves under trees of characters and tokens."""

    def __init__(self, leaves: list[str], chars: SumTree, tokens: SumTree):
        self.leaves, self.chars, self.tokens = leaves, chars, tokens
        self.encoded = 0

    @classmethod
    def build(cls, text: str, encoder: ByteEncoder) -> CountedText:
        leaves, counts = cut_leaves(text, encoder)
        return cls(leaves, SumTree([len(x) for x in leaves]), SumTree(counts))

    def edit(self, at: int, removed: int, inserted: str, encoder: ByteEncoder) -> None:
        """Replaces ``removed`` characters from ``at`` on; both are cut to the text."""
        total = self.chars.total
        at = max(0, min(at, total))
        end = max(at, min(at + max(0, removed), total))
        if at == end and not inserted:
            return
        # A leaf's cut depends on its first two characters only: they must lie before
        # the edit, and those of the leaf after the last one touched behind it.
        first, start = self.chars.find(at - 2)
        last, _ = self.chars.find(max(end - 1, 0))
        last = max(first, last)
        text = "".join(self.leaves[first : last + 1])
        text = text[: at - start] + inserted + text[end - start :]
        self.encoded += len(text)
        leaves, counts = cut_leaves(text, encoder)
        if len(text) > LARGE_LEAF:
            kept = self.tokens.nodes[self.tokens.size :]
            counts = kept[:first] + counts + kept[last + 1 : len(self.leaves)]
            self.leaves[first : last + 1] = leaves
            self.chars, self.tokens = SumTree([len(x) for x in self.leaves]), SumTree(counts)
            return
        for place in range(first, last + 1):
            own, n = (text, sum(counts)) if place == first else ("", 0)
            self.leaves[place] = own
            self.chars.put(place, len(own))
            self.tokens.put(place, n)


def _build(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path, pattern)
        for batch in batches:
            for part in text_slices(batch):
                trees = [CountedText.build(t or "", encoder) for t in part.column("text").to_pylist()]
                added = [
                    pa.array([t.leaves for t in trees], pa.list_(pa.string())),
                    pa.array([t.chars.nodes for t in trees], pa.list_(pa.int64())),
                    pa.array([t.tokens.nodes for t in trees], pa.list_(pa.int64())),
                ]
                columns = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *added], names=[*columns, "leaves", "chars", "tokens"])
        encoder.forget()

    return run


def _schema(df: DataFrame, *without: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in without)


def build_trees(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``leaves``, ``chars`` and ``tokens`` in the place of ``text``.

    A null or empty text has one empty leaf. Columns named like the new ones are
    replaced; all others stay, and so do repeated rows.
    """
    docs = docs.drop("leaves", "chars", "tokens")
    return docs.mapInArrow(_build(path, pattern), f"{_schema(docs, 'text')}, {TREE_COLUMNS}")


def _edit(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                trees = []
                for leaves, chars, tokens, edits in zip(*(part.column(c).to_pylist() for c in ("leaves", "chars", "tokens", "edits")), strict=True):
                    tree = CountedText(leaves, SumTree.of(chars), SumTree.of(tokens))
                    for edit in edits or ():
                        if edit and edit["at"] is not None:
                            tree.edit(edit["at"], edit["removed"] or 0, edit["inserted"] or "", encoder)
                    trees.append(tree)
                added = [
                    pa.array([t.leaves for t in trees], pa.list_(pa.string())),
                    pa.array([t.chars.nodes for t in trees], pa.list_(pa.int64())),
                    pa.array([t.tokens.nodes for t in trees], pa.list_(pa.int64())),
                    pa.array([t.encoded for t in trees], pa.int64()),
                ]
                columns = [c for c in part.schema.names if c not in ("leaves", "chars", "tokens", "edits")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *added], names=[*columns, "leaves", "chars", "tokens", "n_encoded"])

    return run


def apply_edits(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """Trees after their ``edits``, with ``n_encoded``, the characters encoded again.

    ``edits`` is an array of (at, removed, inserted), each made on the text as the one
    before left it. Positions are cut to the text; a null edit, or one without ``at``,
    changes nothing. ``edits`` is dropped.
    """
    rows = trees.drop("n_encoded").withColumn(
        "edits", F.col("edits").cast("array<struct<at: bigint, removed: bigint, inserted: string>>")
    )
    return rows.mapInArrow(_edit(path, pattern), f"{_schema(rows, 'leaves', 'chars', 'tokens', 'edits')}, {TREE_COLUMNS}, n_encoded long")


def n_tokens(column: str = "tokens"):
    """A tree's number of tokens."""
    return F.get(column, F.lit(1))
