"""Substring de-duplication with automata of recurring passages.

A window is 50 consecutive words. It is *owned* by the smallest document in which it
starts; wherever else it occurs its words are repeats.

1. Anchors. Every window has a key, the smallest hash of its 8-word phrases; windows
   in a row with the same key form one anchor with the words they span. Equal windows
   have equal keys, so only keys met in two documents matter.
2. Confirmed passages. Equal spans are owned by their smallest document. Where a key
   has different spans, one window row for each span's owner settles who owns what.
3. Automata. An owner's passages and the texts that may repeat them go to the same
   shard. A shard compiles its passages, cut into tiles of 25 words (every window of a
   passage holds a whole one), into one Aho-Corasick automaton, streams its texts
   through it and confirms the windows around each occurrence.

Owners whose passages recur a lot are spread over several shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import new_table_path, stage
from sessionloom.llm.words import Words, covered, text_slices

WINDOW = 50
PHRASE = 8
#: Words of passages and texts a shard holds, on average.
SHARD_WORDS = 1 << 16

ANCHOR_SCHEMA = "key long, span long, doc_id long, h long, lo long, hi long"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder as a compressed table and read again."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every ``n`` consecutive values."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                n = len(words.starts)
                if n < window:
                    continue
                hashes = words.hashes()
                at = np.flatnonzero(words.text[: n - window + 1] == words.text[window - 1 :])
                if not len(at):
                    continue
                first = np.arange(n - PHRASE + 1)
                least = _sliding_min(words.sequences(hashes, first, first + PHRASE), window - PHRASE + 1)[at]
                begins = np.ones(len(at), bool)
                begins[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
                lo = at[begins]
                hi = at[np.append(np.flatnonzero(begins)[1:] - 1, len(at) - 1)]
                text = words.text[lo]
                docs = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(least[begins]),
                        _signed(words.sequences(hashes, lo, hi + window)),
                        pa.array(docs[text], pa.int64()),
                        _signed(words.identities(hashes)[text]),
                        pa.array(lo - words.first[text]),
                        pa.array(hi - words.first[text]),
                    ],
                    names=["key", "span", "doc_id", "h", "lo", "hi"],
                )

    return run


def _ranged(batch: pa.RecordBatch, words: Words, hashes: np.ndarray) -> Iterator[tuple]:
    """(row, document, identity, first word, ranges) of rows whose identity is right."""
    found = words.identities(hashes).view(np.int64)
    for row, (doc, h, ranges) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "ranges")), strict=True)):
        if h == found[row]:
            yield row, doc, h, int(words.first[row]), ranges


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                hashes = words.hashes()
                docs, ids, places, bases = [], [], [], []
                for _, doc, h, base, ranges in _ranged(part, words, hashes):
                    at = np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in ranges])
                    docs.append(np.full(len(at), doc))
                    ids.append(np.full(len(at), h))
                    places.append(at)
                    bases.append(at + base)
                if docs:
                    at = np.concatenate(bases)
                    columns = [_signed(words.sequences(hashes, at, at + window)), *(pa.array(np.concatenate(x), pa.int64()) for x in (docs, ids, places))]
                    yield pa.RecordBatch.from_arrays(columns, names=["window", "doc_id", "h", "at"])

    return run


SEGMENT_SCHEMA = "owner long, passage boolean, doc_id long, h long, at long, n long, text string"


def _segments(window: int):
    """The words spanned by each document's windows of one owner, adjoining ones as one."""
    schema = pa.schema(
        [("owner", pa.int64()), ("passage", pa.bool_()), *((c, pa.int64()) for c in ("doc_id", "h", "at", "n")), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                rows = []
                for row, doc, h, base, ranges in _ranged(part, words, words.hashes()):
                    ranges = sorted((r["owner"], r["lo"], r["hi"]) for r in ranges)
                    own = None
                    tokens = part.column("text")[row].as_py().encode().split()
                    merged: list[list[int]] = []
                    for owner, lo, hi in ranges:
                        if owner == own and lo <= merged[-1][2] + 1:
                            merged[-1][2] = max(merged[-1][2], hi)
                        else:
                            merged.append([owner, lo, hi])
                            own = owner
                    for owner, lo, hi in merged:
                        text = b" ".join(tokens[lo : hi + window]).decode()
                        rows.append((owner, owner == doc, doc, h, lo, hi + window - lo, text))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    return run


def _scan(window: int):
    """Streams a shard's texts through the automaton of its passages."""
    tile = window // 2

    def run(table: pa.Table) -> pa.Table:
        import ahocorasick

        out: list[tuple[int, int, int, int]] = []
        passages = table.filter(table.column("passage")).combine_chunks()
        texts = table.filter(pa.compute.invert(table.column("passage"))).combine_chunks()
        if passages.num_rows and texts.num_rows:
            owned = Words(passages.column("text").chunk(0))
            hashes = owned.hashes()
            symbols = (hashes >> np.uint64(32)).tolist()
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for lo, hi in zip(owned.first[:-1].tolist(), owned.first[1:].tolist()):
                for at in range(lo, hi - tile + 1, tile):
                    automaton.add_word(tuple(symbols[at : at + tile]), 1)
            automaton.make_automaton()
            at, known = owned.windows(hashes, window)
            owner = passages.column("owner").to_numpy()[owned.text[at]]
            order = np.lexsort((owner, known))
            known, owner = known[order], owner[order]
            first = np.concatenate([[True], known[1:] != known[:-1]])
            known, owner = known[first], owner[first]

            words = Words(texts.column("text").chunk(0))
            hashes = words.hashes()
            symbols = (hashes >> np.uint64(32)).tolist()
            doc, h, begin = (texts.column(c).to_numpy() for c in ("doc_id", "h", "at"))
            at, own = words.windows(hashes, window)
            row = words.text[at]
            ends = []
            for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                ends += [lo + end for end, _ in automaton.iter(tuple(symbols[lo:hi]))]
            # A window holds a tile that ends at e if it starts in e - window + 1 .. e - tile + 1.
            start = np.maximum(np.array(ends, np.int64) - window + 1, 0)
            reached = covered(len(words.starts), start, np.array(ends, np.int64) - tile + 2 - start)[at] if ends else np.zeros(len(at), bool)
            place = np.minimum(np.searchsorted(known, own), len(known) - 1)
            repeat = reached & (known[place] == own) & (owner[place] < doc[row])
            at, row = at[repeat], row[repeat]
            if len(at):
                head = np.concatenate([[True], (at[1:] > at[:-1] + 1) | (row[1:] != row[:-1])])
                last = np.append(np.flatnonzero(head)[1:] - 1, len(at) - 1)
                shift = begin[row[head]] - words.first[row[head]]
                out = list(zip(doc[row[head]].tolist(), h[row[head]].tolist(), (at[head] + shift).tolist(), (at[last] + window + shift).tolist()))
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("doc_id", "h", "lo", "hi"), columns)})

    return run


def _collected(ranges: DataFrame, *more: str) -> DataFrame:
    """All ranges of a document as one row; their number is bounded by its length."""
    return ranges.groupBy("doc_id", "h").agg(F.collect_list(F.struct(*more, "lo", "hi")).alias("ranges"))


def passages(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Segments by owner, and the documents (doc_id, text) that take part in any."""
    anchors = docs.mapInArrow(_anchors(window), ANCHOR_SCHEMA)
    spans = anchors.groupBy("key", "span").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    keys = spans.groupBy("key").agg(F.min("owner").alias("low"), F.max("last").alias("high"), F.count("*").alias("spans"))
    known = stage(spans.join(keys.where("low < high").select("key", "spans"), "key"))
    met = stage(anchors.join(known, ["key", "span"]).select("doc_id", "h", "lo", "hi", "owner", "last", "spans"))
    affected = stored(docs.join(met.select("doc_id").distinct(), "doc_id", "left_semi"), "affected")

    unsettled = _collected(met.where("spans > 1 and doc_id = owner"))
    windows = stage(affected.join(unsettled, "doc_id").mapInArrow(_window_rows(window), "window long, doc_id long, h long, at long"))
    owners = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last")
    single = windows.join(owners, "window").select("doc_id", "h", F.col("at").alias("lo"), F.col("at").alias("hi"), "owner")
    ranges = met.where("owner < last").select("doc_id", "h", "lo", "hi", "owner").unionByName(single)
    collected = _collected(ranges, "owner")
    return stored(affected.join(collected, "doc_id").mapInArrow(_segments(window), SEGMENT_SCHEMA), "segments"), affected


def repeats(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The repeated words of each document (doc_id, h, lo, hi), and the affected documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    segments, affected = passages(docs, window)
    load = segments.groupBy("owner").agg(F.sum(F.when(~F.col("passage"), F.col("n")).otherwise(0)).alias("streamed"), F.sum("n").alias("n"))
    load = load.where("streamed > 0").withColumn("salts", F.ceil(F.col("streamed") / SHARD_WORDS).cast("long"))
    load = stage(load.select("owner", "n", "salts"))
    total = load.agg(F.sum("n")).first()[0] or 0
    shards = -(-total // SHARD_WORDS) or 1
    salts = F.when(F.col("passage"), F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id", "h"), F.col("salts")))
    )
    dealt = segments.join(load.drop("n"), "owner").withColumn("salt", F.explode(salts))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("owner", "salt"), F.lit(shards))).drop("salt", "salts")
    return dealt.groupBy("shard").applyInArrow(_scan(window), "doc_id long, h long, lo long, hi long"), affected


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            words = Words(part.column("text"))
            rows = []
            for row, doc, h, _, ranges in _ranged(part, words, words.hashes()):
                tokens = part.column("text")[row].as_py().encode().split()
                gone = np.zeros(len(tokens), bool)
                for r in ranges:
                    gone[r["lo"] : r["hi"]] = True
                kept = b" ".join([t for t, g in zip(tokens, gone.tolist()) if not g]).decode()
                rows.append((doc, h, int(gone.sum()), kept))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "h", "n_removed", "kept_text"])


def shortened(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, h, n_removed, kept_text`` of the documents that lose words.

    ``h`` tells rows of one ``doc_id`` with different words apart. Kept words are joined
    by one space. Null and empty texts, texts under 50 words and null ids lose
    nothing; a document's own repetitions stay; an empty table gives an empty result.
    """
    found, affected = repeats(docs, window)
    ranges = stage(_collected(found))
    return affected.join(ranges, "doc_id").mapInArrow(_cut, "doc_id long, h long, n_removed long, kept_text string").dropDuplicates(["doc_id", "h"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    for batch in batches:
        for part in text_slices(batch):
            words = Words(part.column("text"))
            raw = part.column("text").cast(pa.binary()).to_pylist()
            digests = [sha256(b" ".join((t or b"").split())).hexdigest() for t in raw]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), _signed(words.identities(words.hashes())), pa.array(words.counts, pa.int64()), pa.array(digests)],
                names=["doc_id", "h", "n_words", "sha256"],
            )


def word_digests(docs: DataFrame) -> DataFrame:
    """Identity, number and digest of every text's words, joined by one space."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests, "doc_id long, h long, n_words long, sha256 string")


def _identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            words = Words(part.column("text"))
            yield pa.RecordBatch.from_arrays([*part.columns, _signed(words.identities(words.hashes()))], names=[*part.schema.names, "_h"])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated words taken out of ``text``, whatever their other columns are called.

    Texts that lose nothing stay as they are, to the byte; documents that lose all their
    words go, those that never had any stay. A column ``n_chars`` follows the text; all
    other columns stay. Rows without ``doc_id`` neither own words nor lose any; repeated
    rows lose the same words. An empty table stays empty.
    """
    names = docs.columns
    carried = {c: c if c in ("doc_id", "text") else f"_column_{k}" for k, c in enumerate(names)}
    plain = docs.select([F.col(f"`{c}`").alias(carried[c]) for c in names])
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in plain.schema)}, _h long"
    cut = shortened(plain, window).select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_cut_h"), F.col("kept_text").alias("_kept_text"))
    named = plain.mapInArrow(_identified, schema)
    out = named.join(cut, (F.col("doc_id") == F.col("_doc_id")) & (F.col("_h") == F.col("_cut_h")), "left")
    kept = F.col("_kept_text")
    out = out.where(kept.isNull() | (kept != ""))
    changed = {"text": F.coalesce(kept, "text")}
    if "n_chars" in names:
        size = carried["n_chars"]
        changed[size] = F.when(kept.isNull(), F.col(size)).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select([F.col(carried[c]).alias(c) for c in names])


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs``."""
    cut = shortened(docs, window).select("doc_id", "h", "n_removed", F.sha2("kept_text", 256).alias("kept"))
    out = word_digests(docs).join(cut, ["doc_id", "h"], "left")
    removed = F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed")
    return out.select("doc_id", "n_words", removed, F.coalesce("kept", "sha256").alias("kept_sha256"))
