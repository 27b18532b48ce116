"""Mixing, counting and packing: round trips, recounts and sums."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sessionloom.config import stage
from sessionloom.llm import best_fit, encode, packed_ids, queries, raking, segment_counts
from sessionloom.llm.encode import byte_encoder, word_encoder

from . import corpus


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return byte_encoder(*queries.byte_tokenizer())


# --- mixing ------------------------------------------------------------------


def test_raked_shares_meet_targets(spark):
    cells = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 40), ("b", "x", 30), ("b", None, 5), (None, "y", 15), ("c", "x", 0)], "s string, l string, tokens long"
    )
    targets = {
        "s": spark.createDataFrame([("a", 0.2), ("b", 0.5), (None, 0.3), ("c", 0.4)], "value string, share double"),
        "l": spark.createDataFrame([("x", 2.0), ("y", 1.5), (None, 0.5)], "value string, share double"),
    }
    raked = raking.rake(cells, targets, rounds=60).toPandas()
    by_s = raked.groupby("s", dropna=False).weight.sum().to_dict()
    by_l = raked.groupby("l", dropna=False).weight.sum().to_dict()
    assert len(raked) == 5 and abs(raked.weight.sum() - 1) < 1e-9
    assert abs(by_s["a"] - 0.2) < 1e-3 and abs(by_s["b"] - 0.5) < 1e-3
    assert abs(by_l["x"] - 0.5) < 1e-3 and abs(by_l["y"] - 0.375) < 1e-3


def test_mixing_keeps_columns_and_draws_by_id(odd_docs, no_docs):
    out = raking.mix_probabilities(odd_docs)
    assert set(odd_docs.columns) < set(out.columns) and out.count() == odd_docs.count()
    shown = out.select("doc_id", "_probability", "_drawn", "_tokens").collect()
    assert all(0 < r._probability <= 1 and 0 <= r._drawn < 1 for r in shown)
    assert len({(r.doc_id, r._drawn) for r in shown}) == len({r.doc_id for r in shown})
    assert max(r._probability for r in shown if r._tokens) == pytest.approx(1)
    drawn = raking.mixed(odd_docs)
    assert drawn.schema == odd_docs.schema and 0 < drawn.count() < odd_docs.count()
    assert raking.mixed(no_docs).count() == 0


def test_no_python_in_mixing(docs):
    plan = raking.mix_probabilities(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_one_odd_document_does_not_decide_how_much_is_kept(spark):
    cells = [(s, lang, t, n) for s, lang, t, n in [("a", "en", "short", 4000), ("a", "fr", "long", 9000), ("b", "en", "long", 30000), ("b", "fr", "short", 7000)]]
    for odd in ([], [("odd", "xx", "short", 10)], [(None, "en", "short", 10)]):
        for times in (1, 300):
            rows = [(s, lang, t, n * times) for s, lang, t, n in cells] + odd
            table = spark.createDataFrame(rows, "s string, l string, t string, tokens long")
            targets = {name: raking.tempered(table, name) for name in "slt"}
            raked = raking.rake_to_share(table, targets, 0.8)
            found = raked.toPandas()
            assert len(found) == len(rows) and found.ratio.between(0, 1).all()
            assert found.weight.sum() == pytest.approx(0.8 * found.tokens.sum())
            if odd:
                assert found[found.tokens == 10].ratio.item() == pytest.approx(1)
            short = raking.shortfall(raked, "s", targets["s"]).toPandas()
            assert short.goal.sum() == pytest.approx(short.kept.sum())


def test_one_odd_document_changes_little(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = docs.limit(1).withColumns(
        {"doc_id": F.lit(10**9).cast(docs.schema["doc_id"].dataType), "source": F.lit("odd"), "lang": F.lit("odd"), "text": F.lit("one two three four five six seven eight nine ten")}
    )
    shares = []
    for name, rows in (("plain", docs), ("odd", docs.unionByName(odd))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = queries.op4_raking(spark, f"{tmp_path}/{name}").where("doc_id <> 1000000000")
        shares.append(found.agg(F.sum(F.expr("n_tokens * probability")) / F.sum("n_tokens")).first()[0])
    assert abs(shares[0] - 0.8) < 1e-6 and abs(shares[1] - shares[0]) < 0.01


def test_few_exchanges_in_raking(spark):
    cells = spark.range(60).selectExpr("id % 5 AS s", "id % 4 AS l", "id + 1 AS tokens")
    targets = {name: stage(raking.tempered(cells, name)) for name in "sl"}
    staged = []
    raking_stage = raking.stage
    raking.stage = lambda df: staged.append(df) or raking_stage(df)
    try:
        raking.rake(cells, targets)
    finally:
        raking.stage = raking_stage
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in staged]
    assert len(plans) == 4 and sum(plan.count("Window") for plan in plans) >= 12
    assert all("Exchange" not in plan for plan in plans[1:])


def test_mixing_stage_keeps_its_share(spark):
    import corpus_pipeline

    rows = [(k, " ".join(["word"] * (30 + k % 50)), ["en", "fr"][k % 2], "abc"[k % 3], 0) for k in range(1500)]
    rows += [(5000, "ten words " * 5, "xx", "odd", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.mixing(spark, docs, "").count() / len(rows) > 0.75
    assert raking.mixed(docs).count() / len(rows) < 0.7


# --- tokenizing --------------------------------------------------------------


def test_words_and_parts_give_the_tokenizers_ids(rows, tokenizer, encoder):
    import pyarrow as pa

    texts = [r[1] for r in rows]
    found = word_encoder(queries.tokenizer_path("word_bpe_49k.json")).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    found = encoder.encode(pa.array(texts))
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [encoder.encode_whole(t or "") for t in texts]


# --- best fit ----------------------------------------------------------------


def test_words_are_looked_up_by_core_and_marks_only(tokenizer, monkeypatch):
    """Case, marks and repeats cost no look-up of their own."""
    asked, learn = [], encode._Parts.learn
    monkeypatch.setattr(encode._Parts, "learn", lambda self, wanted: (asked.extend(wanted), learn(self, wanted))[1])
    texts = ["Foo foo, FOO. foo!! bar Bar, \tfoo;", None, " bar. foo bar "] * 3
    found = encode.WordEncoder(queries.tokenizer_path("word_bpe_49k.json")).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert set(asked) == {b"foo", b"bar", b"", b",", b".", b"!!", b";"} and len(asked) <= 8


def test_awkward_words_give_the_tokenizers_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(encode, "KEPT_PARTS", 4)
    pieces = ["\u0130,", "\u01c5.", "\u00d7!", "\u00ba,", "a\u0301.", "e\u0301", "\u212b,", "<|EndOfText|>", "<|endoftext|>.", "x<|startoftext|>Y,", "A<|", "\u2003B.", "it's,", "!!!", "7,", "\u00e9.", "\u00c9.", "\u00ff;", "\x1cq,", "\x85r.", "\u4e2d,", "\U0001f600."]
    rng = random.Random(3)
    texts = [None, "", " ", *pieces, *["".join(rng.choice([*pieces, " ", "\n", "w"]) for _ in range(30)) for _ in range(200)]]
    own = encode.WordEncoder(queries.tokenizer_path("word_bpe_49k.json"))
    for part in (pa.array(texts), pa.array(texts).slice(1, 40), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        ids = [np.frombuffer(x, "<u4").tolist() for x in own.encode(part)]
        assert ids == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]


def naive_best_fit(lengths, capacity):
    """Rooms of the bins that best-fit decreasing leaves."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 100])
    lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(0, 300))], np.int64)
    bins, offsets = best_fit.best_fit(lengths, capacity)
    filled = np.bincount(bins, weights=lengths) if len(lengths) else np.zeros(0)
    assert sorted(capacity - filled) == naive_best_fit(lengths.tolist(), capacity)
    for number in set(bins.tolist()):
        own = sorted((o, n) for o, n, b in zip(offsets, lengths, bins) if b == number)
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def gapless(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packed_documents(odd_docs, rows, tokenizer, capacity):
    found = best_fit.pack_documents(odd_docs, queries.tokenizer_path("word_bpe_49k.json"), capacity).collect()
    n = gapless(found, capacity)
    assert n <= -(-sum(r.length for r in found) // capacity) + 2
    copies = {}
    for r in odd_docs.select("doc_id").collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        parts = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
        expected = [(k, k * capacity, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
        own = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in found if r.doc_id == doc_id)
        assert own == sorted(expected * copies[doc_id])


def test_many_shards_are_packed_again(spark):
    pieces = spark.range(3000).select((F.col("id") % 7 + 1).alias("length"), "id", F.lit(5).alias("offset"))
    found = best_fit.pack(pieces, 16, shard_pieces=50).collect()
    assert len(found) == 3000 and gapless(found, 16) <= -(-sum(r.length for r in found) // 16) + 4
    assert best_fit.pack(pieces.limit(0), 16).collect() == []


# --- packed ids --------------------------------------------------------------


@pytest.mark.parametrize("capacity,shard_bytes", [(32, 2000), (2048, 1 << 24)])
def test_round_trip(odd_docs, rows, encoder, capacity, shard_bytes, tmp_path, spark):
    path, pattern = queries.byte_tokenizer()
    packed_ids.write_packed(packed_ids.packed_ids(odd_docs, path, pattern, capacity, shard_bytes), str(tmp_path / "packed"))
    packed = spark.read.parquet(str(tmp_path / "packed"))
    for r in packed.collect():
        assert len(r.ids) == len(r.positions) == 2 * capacity and r.cu_lengths[-1] == r.n_ids <= capacity
        positions = np.frombuffer(r.positions, "<u2")
        for lo, hi in zip(r.cu_lengths, r.cu_lengths[1:]):
            assert positions[lo:hi].tolist() == list(range(hi - lo))
    found = {}
    for r in packed_ids.unpacked(packed).collect():
        found.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
    n_rows = {r["doc_id"]: r["count"] for r in odd_docs.groupBy("doc_id").count().collect()}
    for doc_id, text, *_ in rows:
        ids = np.array([*encoder.encode_whole(text or ""), packed_ids.END_ID], "<u2")
        expected = [(k // capacity, k, ids[k : k + capacity].tobytes()) for k in range(0, len(ids), capacity)]
        assert sorted(found[doc_id]) == sorted(expected * n_rows[doc_id])


def test_empty_table_packs_to_nothing(no_docs):
    assert packed_ids.packed_ids(no_docs, *queries.byte_tokenizer()).count() == 0


# --- edit-aware counts -------------------------------------------------------

PIECES = ["a", "b", "é", "1", "23", " ", "  ", "\n", " \n", "\t", "'s", "'ll", "...", " ", "\x1c", "x y", "日本", " ", "!"]


def test_edited_counts_are_those_of_the_edited_text(encoder, monkeypatch):
    monkeypatch.setattr(segment_counts, "LEAF", 8)
    monkeypatch.setattr(segment_counts, "LARGE_LEAF", 40)
    rng = random.Random(5)

    def some(n):
        return "".join(rng.choice(PIECES) for _ in range(n))

    for _ in range(800):
        text = some(rng.randint(0, 60))
        tree = segment_counts.CountedText.build(text, encoder)
        for _ in range(3):
            at, removed, inserted = rng.randint(-2, len(text) + 3), rng.randint(0, 8), some(rng.choice([0, 1, 2, 5, 30]))
            tree.edit(at, removed, inserted, encoder)
            lo = max(0, min(at, len(text)))
            text = text[:lo] + inserted + text[min(lo + removed, len(text)) :]
            assert "".join(tree.leaves) == text
            assert (tree.tokens.total, tree.chars.total) == (len(encoder.encode_whole(text)), len(text))


def test_edits_of_a_table(odd_docs, no_docs, rows, encoder):
    path, pattern = queries.byte_tokenizer()
    edits = F.expr(
        "IF(doc_id % 2 = 0, array(named_struct('at', 3, 'removed', 2, 'inserted', 'new words'), null, "
        "named_struct('at', cast(null as int), 'removed', 1, 'inserted', 'x')), null)"
    )
    trees = segment_counts.build_trees(odd_docs.withColumn("edits", edits), path, pattern)
    found = segment_counts.apply_edits(trees, path, pattern).withColumn("n", segment_counts.n_tokens())
    texts = {r[0]: r[1] or "" for r in rows}
    seen = found.collect()
    assert len(seen) == odd_docs.count()
    for r in seen:
        if r.doc_id is not None:
            text = texts[r.doc_id]
            if r.doc_id % 2 == 0:
                text = text[:3] + "new words" + text[5:]
            assert r.n == len(encoder.encode_whole(text)) and "".join(r.leaves) == text
            assert (r.n_encoded > 0) == (r.doc_id % 2 == 0) and r.n_words == 7 + 1
    assert segment_counts.build_trees(no_docs, path, pattern).count() == 0


def test_long_texts_are_encoded_in_part_only(encoder):
    text = " ".join(corpus.prose(random.Random(2), 20_000))
    tree = segment_counts.CountedText.build(text, encoder)
    tree.edit(50_000, 10, "something else", encoder)
    assert tree.encoded < 4 * segment_counts.LEAF < len(text)
