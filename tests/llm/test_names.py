"""Stages of the pipeline on tables whose columns are called what the stages use themselves."""

import pytest
from pyspark.sql import functions as F

from sessionloom.llm import chosen_path, phrase_automata, raking

CLASHING = ["kept_text", "_h", "_cut_h", "_doc_id", "_kept_text", "_tokens", "_source", "_lang", "_topic", "_probability", "_drawn", "_column_2", "column_1", "a b"]


@pytest.fixture(scope="module")
def clashing(docs):
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return own.select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING)).cache()


@pytest.mark.parametrize(
    "stage",
    [phrase_automata.without_repeats, lambda d: raking.mixed(d, share=raking.KEPT_SHARE), raking.mixed, chosen_path.one_of_each],
    ids=["without_repeats", "mixed_share", "mixed", "one_of_each"],
)
def test_other_columns_stay(docs, clashing, stage):
    out = stage(clashing)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHING)
    plain = stage(docs.select("doc_id", "text", "lang", "source", "n_chars")).collect()
    assert sorted((r.doc_id, r.text or "", r.n_chars or 0) for r in rows) == sorted((r.doc_id, r.text or "", r.n_chars or 0) for r in plain)
    assert stage(clashing.limit(0)).collect() == []
