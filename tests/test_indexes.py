"""Indexes for inner products and for searches under a predicate, against the exact join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import stage
from sessionloom.operators import ivf
from sessionloom.operators.knn import knn_join
from sessionloom.sources.items import load_items

N, DIM = 900, 8


@pytest.fixture(scope="module")
def items(spark):
    """Vectors of very different lengths; a broken one and a zero one among them."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(N, DIM)) * np.exp(rng.normal(size=(N, 1)) * 1.5)
    vectors[5], vectors[6, 2] = 0, np.nan
    rows = [(k, v.tolist(), int(k % 7), float(k) / 10, "even" if k % 2 == 0 else None) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "id long, embedding array<double>, label int, price double, parity string")
    return stage(load_items(table, dim=DIM))


@pytest.fixture(scope="module")
def queries(spark):
    rng = np.random.default_rng(5)
    rows = [(s, q, (rng.normal(size=DIM) * 10.0 ** (q - 1)).tolist(), 5 + q) for s in range(12) for q in range(3)]
    rows.append((99, 0, [0.0] * DIM, 4))
    return stage(spark.createDataFrame(rows, "session_id long, q_idx int, embedding array<double>, top_k int"))


def found(rows):
    return sorted((r.session_id, r.q_idx, r["rank"], r.id, r.score) for r in rows.collect())


@pytest.fixture(scope="module")
def dot_index(items):
    return ivf.build_index(items, ivf.train_cells(items, 24, "dot_product"), "dot_product", block_floats=DIM * 40, keep=["label", "price", "parity"])


def test_inner_products(items, queries, dot_index):
    assert found(ivf.ivf_join(queries, dot_index)) == found(knn_join(queries, items, "dot_product"))
    assert len(np.unique(dot_index.tops)) == ivf.NORM_BANDS


def test_norms_the_training_did_not_see(spark, items, queries):
    bands = ivf.train_cells(items.where("id < 300"), 12, "dot_product")
    longer = items.withColumn("embedding", F.transform("embedding", lambda x: x * 50))
    index = ivf.build_index(longer, bands, "dot_product")
    assert found(ivf.ivf_join(queries, index)) == found(knn_join(queries, longer, "dot_product"))


@pytest.mark.parametrize(
    "predicate, ranges",
    [
        ("label = 3", None),
        ("label IN (1, 2) AND parity IS NULL", None),
        (None, {"price": (20.0, 26.5)}),
        ("label > 2", {"price": (None, 11.0)}),
        ("label = 77", None),
        (None, {"price": (1000.0, None)}),
    ],
)
def test_predicates(spark, items, queries, dot_index, predicate, ranges, tmp_path):
    some = items if predicate is None else items.where(predicate)
    for column, (low, high) in (ranges or {}).items():
        some = some.where((F.col(column) >= (-1e9 if low is None else low)) & (F.col(column) <= (1e9 if high is None else high)))
    seen = some.where("id % 5 = 0").select((F.col("id") % 12).alias("session_id"), "history_value")
    restricted = ivf.restrict_index(dot_index, None if predicate is None else F.expr(predicate), ranges)
    assert restricted.units.count() <= dot_index.units.count()
    assert found(ivf.ivf_join(queries, restricted, exclude=seen)) == found(knn_join(queries, some, "dot_product", exclude=seen))


def test_stored_index_reads_the_units_left_only(spark, items, queries, tmp_path):
    by_label = items.withColumn("embedding", F.transform("embedding", lambda x: x + 30 * F.col("label")))
    path = str(tmp_path / "index")
    cells = ivf.train_cells(by_label, 14, "euclidean_dist")
    ivf.write_index(ivf.build_index(by_label, cells, "euclidean_dist", keep=["label"]), path)
    stored = ivf.read_index(spark, path)
    some = ivf.restrict_index(stored, F.col("label") == 6)
    assert 0 < some.units.count() < stored.units.count() and some.sizes.sum() == by_label.where("label = 6 AND id <> 6").count()
    rows = ivf.ivf_join(queries, some)
    assert found(rows) == found(knn_join(queries, by_label.where("label = 6"), "euclidean_dist"))
    plan = ivf.ivf_join(queries, some, n_probe=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [unit" in plan or "PartitionFilters: [isnotnull(unit" in plan


def test_probing_goes_on_until_enough_qualify(items, queries, dot_index):
    rare = ivf.restrict_index(dot_index, F.col("label") == 3, {"price": (0.0, 30.0)})
    wide = ivf.ivf_join(queries, rare, n_probe=1).groupBy("session_id", "q_idx").count()
    asked = {(r.session_id, r.q_idx): r.top_k for r in queries.collect()}
    assert rare.sizes.max() < 12
    assert {(r.session_id, r.q_idx): r["count"] for r in wide.collect()} == asked


def test_units_of_many_values_keep_their_extremes(items, monkeypatch):
    monkeypatch.setattr(ivf, "ZONE_VALUES", 3)
    index = ivf.build_index(items, ivf.train_cells(items, 6), keep=["price", "label"])
    assert index.zones.count() < 30 and index.bounds.count() == index.units.count()
    # Without values nothing can be ruled out by a predicate alone.
    assert ivf.restrict_index(index, F.col("label") == 77).units.count() > 0
    assert ivf.restrict_index(index, None, {"price": (500.0, None)}).units.count() == 0


def test_an_index_without_columns_takes_no_predicate(items):
    index = ivf.build_index(items, ivf.train_cells(items, 4))
    with pytest.raises(ValueError):
        ivf.restrict_index(index, F.col("label") == 1)


def test_no_items(items, queries):
    for metric in ("dot_product", "cosine_sim"):
        index = ivf.build_index(items, ivf.train_cells(items, 4, metric), metric, keep=["label"])
        assert found(ivf.ivf_join(queries, ivf.restrict_index(index, F.lit(False)))) == []
        assert found(ivf.ivf_join(queries.limit(0), index)) == []
