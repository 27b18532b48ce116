"""The pipeline: each stage against what its operator promises, on its own input."""

import re
from itertools import combinations

import corpus_pipeline

from . import corpus


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "substring_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            continue
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after and set(after) <= set(before)
        if name == "quality_rules":
            good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
            failing = {i for i, t in before.items() if len(corpus.words(t)) < 20 or corpus.repeated_words(corpus.words(t)) > 0.3 * len(corpus.words(t))}
            assert not failing & set(after) and len(good - failing - set(after)) <= 1
        if name == "near_dedup":
            sets = {i: corpus.shingles(t) for i, t in before.items()}
            links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
            assert set(after) == {i for i, c in corpus.components(sets, links).items() if i == c}
        if name == "substring_dedup":
            expected = corpus.without_repeats(list(before.items()))
            assert {i: corpus.words(t) for i, t in after.items()} == {i: kept for i, (kept, gone) in expected.items() if kept or not gone}
        if name == "mixing":
            assert all(after[i] == before[i] for i in after) and len(after) < len(before)


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.count() > 50 and re.match("doc_id", found.columns[0])
