"""Whitening against integers of unbounded size and numpy's own eigenvectors."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sessionloom.llm import bit_scatter

SCHEMA = "vec_id long, embedding array<double>, label int, n long, component int, _id long, _vector string, a int, whitened double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5, 0.5) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """Rows with usable vectors as integers, and the model, by exact arithmetic."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(Fraction(c) * 1024) + 100000 for c in v]) for i, v in kept]
    n, width = len(x), len(x[0][1])
    sums = [sum(v[a] for _, v in x) for a in range(width)]
    covariance = [[Fraction(n * sum(v[a] * v[b] for _, v in x) - sums[a] * sums[b], n * n) for b in range(width)] for a in range(width)]
    return x, n, sums, np.array([[float(c) for c in row] for row in covariance])


def rows_of(seed, n, width, scale=1.0):
    rng = random.Random(seed)
    axes = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(width)]
    out = []
    for k in range(n):
        strength = [rng.gauss(0, 1) * scale / (j + 1) for j in range(width)]
        out.append((k, [sum(s * a[j] for s, a in zip(strength, axes)) for j in range(width)]))
    return out


AWKWARD = [(900, None), (901, []), (902, [None] * 10), (903, [1.0] * 9 + [None]), (904, [math.nan] * 10), (905, [math.inf] * 10), (906, [0.5] * 3)]


@pytest.mark.parametrize("width, scale", [(10, 1.0), (4, 1e9), (1, 0.3)])
def test_whitening(spark, width, scale):
    rows = rows_of(5, 150, width, scale)
    extra = [rows[7], (None, rows[9][1])]  # a repeated row and one without id
    found = bit_scatter.whitened(frame(spark, [*rows, *extra, *AWKWARD])).collect()
    x, n, sums, covariance = brute([*rows, *extra])
    used = min(width, bit_scatter.COMPONENTS)
    assert len(found) == n * used and {r.component for r in found} == set(range(1, used + 1))
    assert {r.n for r in found} == {n}
    deviations = sorted((i if i is not None else -1, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in x)
    own = sorted((-1 if r.vec_id is None else r.vec_id, int(r.deviation_exact)) for r in found if r.component == 1)
    assert own == deviations
    assert all(r.deviation == (int(r.deviation_exact) if r.deviation_exact < 2**63 else None) for r in found)
    values, vectors = np.linalg.eigh(covariance)
    place = {i: k for k, (i, _) in enumerate(x)}
    exact = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for _, v in x])
    for c in range(used):
        e, u = values[-1 - c], vectors[:, -1 - c]
        expected = exact @ u / math.sqrt(e)
        rows_c = [r for r in found if r.component == c + 1 and r.vec_id is not None]
        got = np.array([r.whitened for r in rows_c])
        want = expected[[place[r.vec_id] for r in rows_c]]
        want = want if want @ got > 0 else -want
        assert np.allclose(got, want, rtol=1e-9, atol=1e-7)
        assert all(r.explained == pytest.approx(e / np.trace(covariance), rel=1e-9) for r in rows_c)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-8


def test_bit_planes_give_exact_products(monkeypatch):
    rng = np.random.default_rng(2)
    for high in (2, 1 << 11, 1 << 40, bit_scatter.LARGEST):
        x = rng.integers(-high, high, (131, 5))
        ones = np.concatenate([x, np.ones((131, 1), np.int64)], axis=1).astype(object)
        assert (bit_scatter.block_scatter(x) == ones.T @ ones).all()


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    table = frame(spark, rows_of(3, 90, 6))
    whole = bit_scatter.fit(bit_scatter.usable(table), 6)
    monkeypatch.setattr(bit_scatter, "BLOCK_ROWS", 7)
    cut = bit_scatter.fit(bit_scatter.usable(table.repartition(11)), 6)
    assert whole.sums == cut.sums and (whole.covariance == cut.covariance).all()


def test_components_without_variance(spark):
    rows = [(k, [float(k % 4), 2.0, 0.25]) for k in range(12)]
    found = bit_scatter.whitened(frame(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in found) and len(found) == 36
    assert all(r.identity_error < 1e-9 and r.explained == (1 if r.component == 1 else 0) for r in found)
    single = bit_scatter.whitened(frame(spark, rows[:1])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in single] == [(c, 1, 0, None, 0, None) for c in (1, 2, 3)]


def test_nothing_to_whiten(spark):
    for rows in ([], AWKWARD[:6]):
        found = bit_scatter.whitened(frame(spark, rows))
        assert found.count() == 0 and found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_far_entries_are_kept_in_range(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 2.0])]
    found = bit_scatter.whitened(frame(spark, rows)).collect()
    assert len(found) == 6 and all(r.deviation is None or r.deviation >= 0 for r in found)
