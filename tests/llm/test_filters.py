"""Quality rules, near-duplicates and repeated passages against brute force."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from sessionloom.llm import chosen_path, components, decision_list, phrase_automata

from . import corpus


# --- quality rules -----------------------------------------------------------


def expected_counts(text):
    w = corpus.words(text)
    lines = [x for x in (text or "").split("\n") if corpus.words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        corpus.repeated_words(w),
    )


def test_counts(odd_docs, rows):
    found = decision_list.text_stats(odd_docs).collect()
    assert len(found) == odd_docs.count()
    texts = {r[0]: r[1] for r in rows} | {None: None}
    for r in found:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected_counts(texts[r.doc_id]), r.doc_id


def test_rules_are_learned_and_applied_in_order(spark):
    rng = np.random.default_rng(3)
    x = pd.DataFrame({"a": rng.random(600), "b": rng.random(600), "c": rng.random(600)})
    bad = ((x.a > 0.8) | ((x.b < 0.3) & (x.c < 0.4))).to_numpy()
    rules = decision_list.learn_rules(x, bad)
    hit = np.zeros(len(x), bool)
    for rule in rules:
        hit |= rule.holds(x)
    assert (hit == bad).mean() > 0.97
    numbered = spark.createDataFrame(x).select("a", "b", "c", decision_list.rule_number(rules).alias("r")).toPandas()
    first = [next((k for k, rule in enumerate(rules, 1) if rule.holds(x.iloc[[i]])[0]), 0) for i in range(len(x))]
    assert numbered["r"].tolist() == first


@pytest.mark.parametrize("bad", [[], [True] * 30, [False] * 30])
def test_no_rules_without_two_classes(bad):
    x = pd.DataFrame({"a": np.arange(len(bad), dtype=float)})
    assert decision_list.learn_rules(x, np.array(bad, bool)) == []


def test_quality_of_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[: -len('0.001')]}0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir[: -len('0.001')]}0.01/labels.parquet")
    rules = decision_list.fit_rules(docs, labels.where("doc_id % 3 <> 0"))
    judged = decision_list.judge(docs, rules).where("not base_failed").select("doc_id", "kept")
    held = judged.join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert (held.kept == (held.quality == 1)).mean() > 0.97


def test_passing_keeps_columns(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (None, 0, None), (2, None, 1)], "doc_id long, quality int, toxic int")
    rules = decision_list.fit_rules(odd_docs, labels)
    assert rules == []
    kept = decision_list.passing(odd_docs, rules)
    assert kept.schema == odd_docs.schema
    judged = decision_list.judge(odd_docs, rules)
    assert kept.count() == judged.where("kept").count() > 20
    assert not judged.where("base_failed and kept").count()
    assert decision_list.passing(no_docs, rules).count() == 0


# --- near-duplicates ---------------------------------------------------------


def expected_components(rows, percent):
    sets = {r[0]: corpus.shingles(r[1]) for r in rows}
    links = []
    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            links.append((a, b))
    return sets, corpus.components(sets, links)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(odd_docs, rows, percent):
    sets, expected = expected_components(rows, percent)
    found = chosen_path.near_duplicates(odd_docs, percent).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], expected[r.doc_id] == r.doc_id)


def test_large_nodes_are_split(docs, rows, monkeypatch):
    """Deep trees and the last resort give the same result."""
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 4)
    monkeypatch.setattr(chosen_path, "MAX_DEPTH", 3)
    _, expected = expected_components(rows, 80)
    assert {r.doc_id: r.component_id for r in chosen_path.near_duplicates(docs, 80).collect()} == expected


def test_one_of_each(odd_docs, rows, no_docs):
    _, expected = expected_components(rows, 80)
    kept = chosen_path.one_of_each(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(i for i, c in expected.items() if i == c)
    assert kept.where("doc_id is null").count() == 2
    assert chosen_path.one_of_each(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 120)] + [(119, 200), (5, 5), (300, 299)]
    ids = sorted({x for link in links for x in link})
    found = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = corpus.components(ids, links)
    assert {i: found.get(i, i) for i in ids} == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated passages -------------------------------------------------------


def test_repeats(odd_docs, docs, rows):
    expected = corpus.without_repeats(rows)
    found = phrase_automata.digest(odd_docs).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        kept, removed = expected[r.doc_id]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(kept) + removed, removed, digest), r.doc_id
    assert sum(removed for _, removed in expected.values()) > 500


def test_without_repeats(odd_docs, rows, no_docs):
    expected = corpus.without_repeats(rows)
    texts = {r[0]: r[1] for r in rows}
    out = phrase_automata.without_repeats(odd_docs)
    assert out.schema.names == odd_docs.schema.names
    for r in out.where("doc_id is not null").collect():
        kept, removed = expected[r.doc_id]
        assert r.text == (" ".join(kept) if removed else texts[r.doc_id])
        assert r.n_chars == (len(r.text) if r.text is not None else None)
    gone = {i for i, (kept, removed) in expected.items() if removed and not kept}
    assert {r.doc_id for r in out.collect()} == set(texts) - gone | {None}
    assert phrase_automata.without_repeats(no_docs).count() == 0
    assert phrase_automata.digest(no_docs).count() == 0


def test_small_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(phrase_automata, "SHARD_WORDS", 100)
    expected = corpus.without_repeats(rows)
    assert {r.doc_id: r.n_removed for r in phrase_automata.digest(docs).collect()} == {i: n for i, (_, n) in expected.items()}
