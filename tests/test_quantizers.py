import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.operators import quantize
from sessionloom.operators.quantizers import ProductQuantizer, ScalarQuantizer
from sessionloom.plans import sketch


def table(spark, m):
    return local_table(spark, [(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<float>").repartition(5)


def unit(n, d, seed=0):
    m = np.random.default_rng(seed).random((n, d)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def lists(df, column):
    return np.array([r[column] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("shape", ["even", "constant", "outlier", "repeats"])
def test_exact_quantiles(spark, shape):
    m = unit(300, 16)
    if shape == "constant":
        m[:] = 0.25
    if shape == "outlier":
        m[0, 0] = 1e9
    if shape == "repeats":
        m[:200] = 0.0
    cuts = quantize.cut_points(quantize.train_scalar_quantizer(table(spark, m)))
    np.testing.assert_allclose(cuts, np.quantile(m.astype(np.float64), np.arange(256) / 256), rtol=1e-12)


def test_exact_quantiles_with_rough_borders(spark, monkeypatch):
    monkeypatch.setattr(quantize, "SKETCH_K", 20)
    m = unit(400, 8)
    cuts = quantize.cut_points(quantize.train_scalar_quantizer(table(spark, m), levels=64))
    np.testing.assert_allclose(cuts, np.quantile(m.astype(np.float64), np.arange(64) / 64), rtol=1e-12)


@pytest.mark.parametrize("bound", [1, 50])
def test_full_ranges_are_cut_again(spark, monkeypatch, bound):
    monkeypatch.setattr(quantize, "BINS", 5)
    monkeypatch.setattr(quantize, "CUT_BINS", 64)
    monkeypatch.setattr(quantize, "BIN_VALUES", bound)
    m = unit(300, 8)
    # Most values lie in one narrow range, some of them are all the same, and signs differ.
    m[:270] = 0.5 + m[:270] * 1e-5
    m[100:150] = -0.25
    cuts = quantize.cut_points(quantize.train_scalar_quantizer(table(spark, m), levels=64))
    np.testing.assert_allclose(cuts, np.quantile(m.astype(np.float64), np.arange(64) / 64), rtol=1e-12)


def test_passes_over_a_narrow_range(spark, monkeypatch):
    monkeypatch.setattr(quantize, "BINS", 16)
    monkeypatch.setattr(quantize, "BIN_VALUES", 100)
    passes, counted = [], quantize._counted
    monkeypatch.setattr(quantize, "_counted", lambda *a: passes.append(len(a[1])) or counted(*a))
    m = unit(500, 16)
    m[:450] = 0.5 + m[:450] * 1e-4
    cuts = quantize.cut_points(quantize.train_scalar_quantizer(table(spark, m)))
    np.testing.assert_allclose(cuts, np.quantile(m.astype(np.float64), np.arange(256) / 256), rtol=1e-12)
    assert 2 <= len(passes) <= 3 and max(passes) <= quantize.CUT_BINS + quantize.BINS


def test_ranges_hold_equally_many_doubles():
    starts = quantize.cut_range(-1.0, 1.0, 8)
    assert starts[0] == -1.0 and (np.diff(starts) > 0).all() and len(starts) == 8
    assert quantize.cut_range(0.5, np.nextafter(0.5, 1), 100).tolist() == [0.5, np.nextafter(0.5, 1)]


def test_components_that_are_no_numbers(spark):
    rows = [(0, [1.0, float("nan"), 2.0]), (1, [float("inf"), None, 3.0]), (2, None), (3, [])]
    data = local_table(spark, rows, "id long, embedding array<double>")
    for method in quantize.METHODS:
        cuts = quantize.cut_points(quantize.train_scalar_quantizer(data, 2, method))
        assert cuts.tolist() == ([1.0, 2.0])
    with pytest.raises(ValueError):
        quantize.train_scalar_quantizer(data.limit(0))


def test_sketch_is_close(spark):
    m = unit(1000, 16)
    cuts = quantize.cut_points(quantize.train_scalar_quantizer(table(spark, m), method="sketch"))
    ranks = np.searchsorted(np.sort(m.ravel()), cuts) / m.size
    assert np.abs(ranks - np.arange(256) / 256).max() < 0.01


def test_scalar_codes(spark):
    m = unit(200, 8)
    q = ScalarQuantizer(levels=16)
    data = table(spark, m)
    model = q.fit(data)
    cuts = quantize.cut_points(model)
    codes = q.encode(data, model)
    got = lists(codes, "codes")
    expected = [[next((i for i, c in enumerate(cuts) if x < c), 15) for x in row] for row in m.astype(np.float64)]
    np.testing.assert_array_equal(got, expected)
    # A decoded value is the next higher cut point, or the last.
    np.testing.assert_array_equal(lists(q.decode(codes, model), "decoded"), cuts[got])
    order = np.argsort(m.ravel())
    assert (np.diff(got.ravel()[order]) >= 0).all()


def test_product_quantizer(spark):
    m = unit(400, 16)
    data = table(spark, m)
    errors = []
    for n_codes in (4, 32):
        q = ProductQuantizer(cluster_size=n_codes, subquantizer_size=4, rounds=8)
        book = q.fit(data)
        codes = q.encode(data, book)
        assert lists(codes, "codes").max() < n_codes and lists(codes, "residual_codes").shape == (400, 4)
        decoded = lists(q.decode(codes, book), "decoded")
        assert decoded.shape == m.shape
        errors.append(np.abs(decoded - m).sum(1).mean())
    assert errors[1] < errors[0] < np.abs(m - m.mean(0)).sum(1).mean()


def test_product_codes_are_reproducible(spark):
    data = table(spark, unit(100, 8))
    q = ProductQuantizer(cluster_size=8, subquantizer_size=2, rounds=4)
    book = q.fit(data)
    once, again = (lists(q.encode(x, book), "codes") for x in (data, data.repartition(3)))
    np.testing.assert_array_equal(once, again)


def test_width_must_divide(spark):
    with pytest.raises(ValueError):
        ProductQuantizer(subquantizer_size=3).fit(table(spark, unit(50, 8)))


def test_sketch_only_once(spark, tmp_path):
    items = table(spark, unit(60, 8)).selectExpr("id", "embedding", "id AS history_value")
    codes, model = sketch.sketch_collection(items, "c")
    assert codes.count() == 100 and model.count() == 256
    sketch.write_sketch(codes, model, "c", str(tmp_path))
    registry = sketch.sketched_collections(spark, str(tmp_path))
    assert sketch.sketch_collection(items, "c", registry) is None
    codes, model = sketch.sketch_collection(items, "d/2", registry, ScalarQuantizer(8))
    sketch.write_sketch(codes, model, "d/2", str(tmp_path))
    registry = sketch.sketched_collections(spark, str(tmp_path))
    assert sorted(r["collection"] for r in registry.collect()) == ["c", "d/2"]


def test_borders_of_an_ordered_collection(spark):
    """Borders come from all partitions: no bin holds a large share of the values."""
    x = np.arange(40_000, dtype=np.float64)
    ordered = table(spark, x[:, None]).select("embedding").coalesce(1).repartitionByRange(8, F.col("embedding")[0])
    borders = quantize._borders(ordered)
    assert borders[-1] > 0.95 * x[-1] and np.diff(np.searchsorted(x, borders)).max() < 2000


def test_training_probes_are_a_parameter(spark):
    items = table(spark, unit(60, 8)).selectExpr("id", "embedding", "id AS history_value")
    assert sketch.training_sample(items, 50, max_probes=4).count() == 20
