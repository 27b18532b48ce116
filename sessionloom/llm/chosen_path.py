"""Near-duplicate documents by chosen-path set similarity joins.

A tree sends each document down the branches of the minwise tokens its node selects,
one or two per level, so similar sets meet in some small node, where all are compared.
Independent trees repeat this until the chance to miss a pair is negligible.

Two things keep groups of thousands of copies linear. Equal sets stand for one
another from the start. And first every member of a node is compared with the node's
smallest one only; afterwards a node needs splitting or comparing only as far as its
members are not yet known to be in one component. A comparison takes place in one task,
on full sets, and returns a spanning forest instead of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import stage
from sessionloom.llm.components import components, forest
from sessionloom.llm.words import Words, mix, text_slices

SHINGLE_WORDS = 5
HASHES = 64
TREES = 10
#: Chance that a node selects a second token.
SECOND_BRANCH = 0.2
FIRST_DEPTH = 2
MAX_DEPTH = 16
#: Nodes up to this size are compared exhaustively.
SMALL_NODE = 1024
#: Columns of the incidence matrix of sets and shingles that are held at a time.
BLOCK_SHINGLES = 4096

_draw = np.random.default_rng(20_24)
_FACTORS = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED_SCHEMA = "doc_id long, n_shingles long, h1 long, h2 long, sig binary"


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted by text and hash.

    A text of fewer than five words has its whole sequence as its only shingle.
    """
    hashes = words.hashes(lower=True)
    at, found = words.windows(hashes, SHINGLE_WORDS)
    texts, values = [words.text[at]], [found]
    for n in range(1, SHINGLE_WORDS):
        at, found = words.windows(hashes, n)
        whole = (words.counts[words.text[at]] == n) if len(at) else np.zeros(0, bool)
        texts.append(words.text[at[whole]])
        values.append(mix(found[whole] ^ np.uint64(n)))
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[first], value[first]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            words = Words(part.column("text"))
            text, value = shingles(words)
            n = part.num_rows
            sizes = np.bincount(text, minlength=n)
            some = np.flatnonzero(sizes)
            begin = np.searchsorted(text, some)
            sums, sig = np.zeros((2, n), np.uint64), np.zeros((n, HASHES), np.uint32)
            if len(some):
                with np.errstate(over="ignore"):
                    sums[0, some] = np.add.reduceat(mix(value), begin)
                    sums[1, some] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), begin)
                    for k in range(HASHES):
                        sig[some, k] = np.minimum.reduceat((value * _FACTORS[k]) >> np.uint64(32), begin)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array([s.tobytes() if m else None for s, m in zip(sig, sizes)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"],
            )


def signed(docs: DataFrame) -> DataFrame:
    """Size, set hash (128 bits) and minwise signature of every text's shingles."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_signed, SIGNED_SCHEMA)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            text, value = shingles(Words(part.column("text")))
            bounds = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "shingles"])


def shingle_sets(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sets, "doc_id long, shingles array<long>")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _children(node: np.ndarray, row: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The branches each (node, row) takes: the node selects one or two tokens."""
    drawn = mix(node)
    which = drawn % np.uint64(HASHES)
    second = (drawn >> np.uint64(11)).astype(np.float64) / 2**53 < SECOND_BRANCH
    other = mix(drawn) % np.uint64(HASHES)
    nodes, rows = [], []
    for take, function in ((slice(None), which), (second, other)):
        at, r, f = node[take], row[take], function[take].astype(np.int64)
        nodes.append(mix(at ^ mix(sig[r, f].astype(np.uint64) + (f.astype(np.uint64) << np.uint64(32)))))
        rows.append(r)
    return np.concatenate(nodes), np.concatenate(rows)


def _first_nodes(trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, docs = _signatures(batch.column("sig")), batch.column("doc_id").to_numpy(zero_copy_only=False)
            for tree in range(trees):
                node, row = np.full(len(sig), mix(np.array([tree + 1], np.uint64))[0]), np.arange(len(sig))
                for _ in range(FIRST_DEPTH):
                    node, row = _children(node, row, sig)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(docs[row])], names=["node", "doc_id"])

    return run


def _next_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sig = _signatures(batch.column("sig"))
            node = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            node, row = _children(node, np.arange(len(sig)), sig)
            kept = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.view(np.int64)), *(kept.column(c) for c in ("doc_id", "label", "sig"))], names=["node", "doc_id", "label", "sig"]
            )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by ``key``, cut anew so that no group is torn."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        other = np.flatnonzero(keys != keys[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
    return zip(at[:-1], at[1:])


def _candidates(least: int):
    """Members of a node with a partner of another component whose signature agrees enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "node"):
            label, sig = table.column("label").to_numpy(), _signatures(table.column("sig"))
            chosen = np.zeros(len(label), bool)
            for lo, hi in _bounds(table.column("node").to_numpy()):
                own = sig[lo:hi].T.copy()
                agree = np.zeros((hi - lo, hi - lo), np.uint8)
                for row in own:
                    agree += row[:, None] == row
                near = (agree >= least) & (label[lo:hi, None] != label[lo:hi])
                chosen[lo:hi] = near.any(1)
            yield from table.select(["node", "doc_id", "label"]).filter(pa.array(chosen)).combine_chunks().to_batches()

    return run


def _common(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all intersections of ``n`` sets, given as (value, row)."""
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1
    order = np.argsort(column, kind="stable")
    order = order[shared[column[order]]]
    place, row = (np.cumsum(shared) - 1)[column[order]], rows[order]
    out = np.zeros((n, n), np.float32)
    for begin in range(0, int(shared.sum()), BLOCK_SHINGLES):
        lo, hi = np.searchsorted(place, [begin, begin + BLOCK_SHINGLES])
        block = np.zeros((n, BLOCK_SHINGLES), np.float32)
        block[row[lo:hi], place[lo:hi] - begin] = 1
        out += block @ block.T
    return out


def _linked(percent: int):
    """A spanning forest of the links between components inside each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "node"):
            table = table.combine_chunks()
            doc, label = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
            sets = table.column("shingles").combine_chunks()
            limits = np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])
            values = sets.flatten().to_numpy()
            for lo, hi in _bounds(table.column("node").to_numpy()):
                sizes = np.diff(limits[lo : hi + 1])
                common = _common(values[limits[lo] : limits[hi]], np.repeat(np.arange(hi - lo), sizes), hi - lo)
                near = 100 * common >= percent * (sizes[:, None] + sizes - common)
                i, j = np.nonzero(near & (label[lo:hi, None] != label[lo:hi]))
                if len(i):
                    a, b = forest(doc[lo:hi], doc[lo:hi], i, j)
                    keep = a != b
                    yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    return run


def _near(least: int):
    """Pairs with both signatures, where these agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = (_signatures(batch.column("sig_a")) == _signatures(batch.column("sig_b"))).sum(1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("total"))
    return both.where(F.col("common") * 100 >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("id").alias("doc_id"), "component")
    return rows.join(named, "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")


def _split_rest(rows: DataFrame) -> DataFrame:
    """Nodes that stayed large, cut into nodes in which their chunks meet two at a time."""
    size = rows.groupBy("node").agg(F.count("*").alias("n"))
    chunked = rows.join(size, "node").withColumn("chunks", F.ceil(F.col("n") / (SMALL_NODE // 2)).cast("int"))
    chunked = chunked.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
    met = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))).select(*rows.columns)


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "doc_id")


def links(texts: DataFrame, docs: DataFrame, percent: int, trees: int) -> DataFrame:
    """(id, component) of the documents of ``texts`` (doc_id, sig), one for each set."""
    least = int(HASHES * percent / 100 - 5 * (HASHES * percent / 100 * (1 - percent / 100)) ** 0.5)
    nodes = texts.mapInArrow(_first_nodes(trees), "node long, doc_id long")
    shared = nodes.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("pivot")).where("n > 1")
    live = stage(nodes.join(shared, "node"))
    near_texts = stage(texts.join(live.select("doc_id").distinct(), "doc_id", "left_semi"))
    # Sets of all documents that meet another one; equal texts stand for each other.
    sets = stage(shingle_sets(docs.join(near_texts.select("doc_id"), "doc_id", "left_semi")).dropDuplicates(["doc_id"]))

    star = live.where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    sig_a = near_texts.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"))
    sig_b = near_texts.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"))
    star = star.join(sig_a, "a").join(sig_b, "b").mapInArrow(_near(least), "a long, b long")
    found = stage(confirmed(star, sets, percent))
    labels = components(found)

    rows = _with_labels(live.select("node", "doc_id").join(near_texts, "doc_id"), labels)
    small = []
    for depth in range(FIRST_DEPTH, MAX_DEPTH + 1):
        mixed = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        rows = stage(rows.join(mixed.where("low <> high").select("node", "n"), "node"))
        small.append(rows.where(F.col("n") <= SMALL_NODE).select("node", "doc_id", "label", "sig"))
        large = rows.where(F.col("n") > SMALL_NODE).drop("n")
        if large.isEmpty():
            break
        if depth == MAX_DEPTH:
            small.append(_split_rest(large).select("node", "doc_id", "label", "sig"))
        else:
            rows = large.mapInArrow(_next_nodes, "node long, doc_id long, label long, sig binary")
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.unionByName(more)
    chosen = _by_node(nodes).mapInArrow(_candidates(least), "node long, doc_id long, label long")
    more = stage(_by_node(chosen.join(sets, "doc_id")).mapInArrow(_linked(percent), "a long, b long"))
    return labels if more.isEmpty() else components(found.unionByName(more))


def near_duplicates(docs: DataFrame, percent: int = 80, trees: int = TREES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of
    five-word shingles (A-Z read as a-z). Null, empty and wordless texts have an empty
    set and no link; a null ``doc_id`` is linked with nothing and kept. Rows with the
    same ``doc_id`` are one document; of rows with equal sets the smallest id stands
    for all. Other columns are not read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = stage(signed(docs))
    texts = sigs.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2")
    texts = stage(texts.agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")))
    labels = links(texts.select("doc_id", "sig"), docs, percent, trees)
    joined = texts.drop("sig").join(labels, F.col("doc_id") == F.col("id"), "left")
    named = joined.select("n_shingles", "h1", "h2", F.coalesce("component", "doc_id").alias("component_id"))
    out = sigs.drop("sig").join(named, ["n_shingles", "h1", "h2"], "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80, trees: int = TREES) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates; rows without id stay."""
    kept = near_duplicates(docs, percent, trees).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))
