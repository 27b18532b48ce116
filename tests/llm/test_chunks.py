"""SentencePiece ids through distinct chunks against the library on whole texts."""

import hashlib
import random

import pyarrow as pa
import pytest

from sessionloom.llm import chunk_table
from sessionloom.llm.queries import tokenizer_path

from . import corpus

PATH = tokenizer_path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "a", "b", "the", "▁", "\n", "\t", "é", "é", "漢", "<s>", "\0", "\U0001f600", "Th", "ing", ".", "　", "\xa0", "0x41"]


@pytest.fixture(scope="module")
def model():
    return chunk_table.chunk_encoder(PATH).model


def whole(model, text):
    ids = [*model.encode(text or ""), model.eos_id()]
    return ids, model.decode(ids)


@pytest.mark.parametrize("seed", range(4))
def test_chunks_give_what_whole_texts_give(model, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 50))) for _ in range(2000)] + [None, "", " " * 5000, "x" * 3000]
    encoder = chunk_table.chunk_encoder(PATH)
    assert encoder.cuts
    rng.shuffle(texts)
    for text, n, ids, decoded in zip(texts, *encoder.encode(pa.array(texts))):
        expected = model.encode(text or "")
        assert ([int(x) for x in ids.split()], n, decoded.decode()) == (expected, len(expected), model.decode(expected))


def test_a_distinct_chunk_is_segmented_once(model, monkeypatch):
    encoder = chunk_table.ChunkEncoder(PATH)
    asked = []

    class Counting:
        def encode(self, texts, **more):
            asked.extend(texts)
            return model.encode(texts, **more)

        def __getattr__(self, name):
            return getattr(model, name)

    encoder.model = Counting()
    encoder.encode(pa.array(["one two one", "two one two ", None, "three  one"]))
    assert sorted(asked) == sorted({"one", "two", "", "three", " one"})


def test_models_with_crossing_pieces_read_whole_texts(model):
    encoder = chunk_table.ChunkEncoder(PATH)
    encoder.cuts = False
    texts = pa.array(["a  b", None, "▁x y"])
    cut = chunk_table.chunk_encoder(PATH).encode(texts)
    assert [list(column) for column in encoder.encode(texts)] == [list(column) for column in cut]


def test_documents(spark, odd_docs, rows, model, monkeypatch):
    expected = {r[0]: whole(model, r[1]) for r in rows}
    full = chunk_table.encoded(odd_docs, PATH)
    found = full.collect()
    assert len(found) == odd_docs.count()
    assert all((r.ids, r.decoded) == expected[r.doc_id] and r.n_tokens == len(r.ids) for r in found if r.doc_id is not None)
    assert sum(r.doc_id is None for r in found) == len(corpus.AWKWARD) - 1
    again = {r.doc_id: r.text for r in chunk_table.decoded(full.where("doc_id is not null"), PATH).collect()}
    assert all(again[i] == text for i, (_, text) in expected.items())
    for r in chunk_table.digests(odd_docs, PATH).collect():
        if r.doc_id is not None:
            ids, text = expected[r.doc_id]
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.n_tokens == len(ids)


def test_no_documents(no_docs):
    assert chunk_table.digests(no_docs, PATH).count() == chunk_table.encoded(no_docs, PATH).count() == 0
