import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.operators import ivf, knn
from sessionloom.sources import items as items_module

DIM = 8


def vectors(n, seed=0):
    return np.random.default_rng(seed).normal(size=(n, DIM)).astype(np.float32)


def item_table(spark, m, history=None):
    rows = [(i, v.tolist(), i % 3 if history is None else history[i]) for i, v in enumerate(m)]
    raw = local_table(spark, rows, "id long, embedding array<float>, kind long")
    return items_module.load_items(raw, dim=DIM, history_field="id" if history is None else "kind")


def query_table(spark, m, top_k):
    rows = [(i // 4, i % 4, v.tolist(), int(top_k[i])) for i, v in enumerate(m)]
    return local_table(spark, rows, "session_id long, q_idx int, embedding array<float>, top_k int")


def scores(q, m, metric):
    q, m = q.astype(np.float64), m.astype(np.float64)
    if metric == "euclidean_dist":
        return np.round(np.sqrt(((q[:, None] - m[None]) ** 2).sum(2)), 9)
    if metric == "cosine_sim":
        q = q / np.linalg.norm(q, axis=1, keepdims=True)
        m = m / np.linalg.norm(m, axis=1, keepdims=True)
    return np.round(q @ m.T, 9)


def expected(q, m, metric, top_k, hidden=lambda session, item: False):
    out = set()
    for i, row in enumerate(scores(q, m, metric)):
        allowed = [j for j in range(len(m)) if not hidden(i // 4, j)]
        order = sorted(allowed, key=lambda j: (row[j] if metric == "euclidean_dist" else -row[j], j))
        out |= {(i // 4, i % 4, r + 1, j) for r, j in enumerate(order[: top_k[i]])}
    return out


def found(df):
    return {tuple(r) for r in df.select("session_id", "q_idx", "rank", "id").collect()}


@pytest.mark.parametrize("metric", knn.METRICS)
@pytest.mark.parametrize("block_floats", [1 << 22, DIM * 7])
def test_knn_join_is_exact(spark, metric, block_floats):
    m, q = vectors(60), vectors(20, 1)
    # Copies tie; the lower id comes first.
    m[10:30] = m[0]
    q[0] = m[0]
    top_k = np.arange(20) % 6 + 1
    got = knn.knn_join(query_table(spark, q, top_k), item_table(spark, m), metric, block_floats=block_floats)
    assert found(got) == expected(q, m, metric, top_k)


@pytest.mark.parametrize("block_floats", [1 << 22, DIM * 7])
def test_exclusion_by_id(spark, block_floats):
    m, q = vectors(50), vectors(12, 1)
    top_k = np.full(12, 5)
    hidden = {(0, j) for j in range(0, 50, 2)} | {(1, 7), (2, 99)}
    exclude = local_table(spark, sorted(hidden), "session_id long, history_value long")
    # Histories may hold text, and other widths of integers.
    texts = exclude.selectExpr("cast(session_id AS int) session_id", "cast(history_value AS string) history_value")
    for seen in (exclude, texts):
        got = knn.knn_join(query_table(spark, q, top_k), item_table(spark, m), exclude=seen, block_floats=block_floats)
        assert found(got) == expected(q, m, "cosine_sim", top_k, lambda s, j: (s, j) in hidden)


@pytest.mark.parametrize("block_floats", [1 << 22, DIM * 7])
def test_exclusion_by_a_value_most_items_share(spark, block_floats):
    m, q = vectors(50), vectors(8, 1)
    kinds = [0 if i < 30 else i for i in range(50)]
    hidden = {(0, 0), (1, 40), (1, 41)}
    exclude = local_table(spark, sorted(hidden), "session_id long, history_value long")
    top_k = np.full(8, 6)
    items = item_table(spark, m, kinds)
    got = knn.knn_join(query_table(spark, q, top_k), items, exclude=exclude, block_floats=block_floats)
    assert found(got) == expected(q, m, "cosine_sim", top_k, lambda s, j: (s, kinds[j]) in hidden)


def test_a_session_with_many_queries(spark):
    m, q = vectors(30), vectors(40, 2)
    rows = [(0, i * 300, v.tolist(), 3) for i, v in enumerate(q)]
    queries = local_table(spark, rows, "session_id long, q_idx int, embedding array<float>, top_k int")
    exclude = local_table(spark, [(0, 3), (0, 4)], "session_id long, history_value long")
    got = knn.knn_join(queries, item_table(spark, m), exclude=exclude, block_floats=DIM * 5)
    best = expected(q, m, "cosine_sim", np.full(40, 3), lambda s, j: j in (3, 4))
    assert found(got) == {(0, (s * 4 + i) * 300, r, j) for s, i, r, j in best}


def test_fewer_items_than_asked_for(spark):
    m, q = vectors(3), vectors(4, 1)
    top_k = np.full(4, 10)
    assert found(knn.knn_join(query_table(spark, q, top_k), item_table(spark, m))) == expected(q, m, "cosine_sim", top_k)


@pytest.mark.parametrize("metric", knn.METRICS)
def test_broken_items_are_never_found(spark, metric):
    m, q = vectors(40), vectors(4, 1)
    m[5, 2], m[6, 0], m[7, 1] = np.nan, np.inf, -np.inf
    top_k = np.array([10, 3, 40, 1])
    got = knn.knn_join(query_table(spark, q, top_k), item_table(spark, m), metric)
    m[5:8] = 1
    assert found(got) == expected(q, m, metric, top_k, lambda s, j: j in (5, 6, 7))


def test_large_blocks(spark):
    """Runs of maxima are used from some hundred items on."""
    m, q = vectors(3000), vectors(40, 1)
    m[1000:2000] = m[1000]
    q[:10] = m[1000]
    top_k = np.arange(40) % 12 + 1
    for metric in knn.METRICS:
        rows, cols, score = knn.block_top_k(q.astype(float), m.astype(float), top_k, metric)
        exact = scores(q, m, metric)
        for i in range(40):
            order = np.lexsort((np.arange(3000), exact[i] if metric == "euclidean_dist" else -exact[i]))[: top_k[i]]
            np.testing.assert_array_equal(cols[rows == i], order)
            np.testing.assert_allclose(score[rows == i], exact[i][order], atol=2e-9)


@pytest.mark.parametrize("metric", knn.METRICS)
def test_scores_of_a_tile_are_held_once(monkeypatch, metric):
    """Neither a second array as large as a tile of scores nor a mask of it is made."""
    monkeypatch.setattr(knn, "TILE_CELLS", 1 << 22)
    # The last run is shorter than others.
    m, q = vectors(8200).astype(float), vectors(1200, 1).astype(float)
    m[8100:] = m[17]
    q[:5] = m[17]
    top_k = np.arange(1200) % 9
    tracemalloc.start()
    rows, cols, _ = knn.block_top_k(q, m, top_k, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * 4 * knn.TILE_CELLS
    exact = scores(q, m, metric)
    for i in range(0, 1200, 7):
        order = np.lexsort((np.arange(8200), exact[i] if metric == "euclidean_dist" else -exact[i]))[: top_k[i]]
        np.testing.assert_array_equal(cols[rows == i], order)


def test_no_queries(spark):
    none = query_table(spark, vectors(4), np.full(4, 2)).where("session_id < 0")
    assert knn.knn_join(none, item_table(spark, vectors(10))).count() == 0


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        knn.knn_join(query_table(spark, vectors(4), np.ones(4)), item_table(spark, vectors(4)), "hamming")


@pytest.mark.parametrize("metric", ivf.INDEXED_METRICS)
def test_pruned_search_is_exact(spark, metric):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, DIM)) * 5
    m = (centres[rng.integers(0, 6, 120)] + rng.normal(size=(120, DIM)) * 0.3).astype(np.float32)
    # One cell holds a third of the items.
    m[:40] = m[0]
    q = (centres[rng.integers(0, 6, 24)] + rng.normal(size=(24, DIM)) * 0.3).astype(np.float32)
    top_k = np.arange(24) % 9 + 1
    items = item_table(spark, m)
    index = ivf.build_index(items, ivf.train_cells(items, 8, metric), metric, block_floats=DIM * 10)
    hidden = {(0, j) for j in range(0, 120, 3)} | {(3, 1)}
    exclude = local_table(spark, sorted(hidden), "session_id long, history_value long")
    queries = query_table(spark, q, top_k)
    assert found(ivf.ivf_join(queries, index)) == expected(q, m, metric, top_k)
    got = ivf.ivf_join(queries, index, exclude=exclude)
    assert found(got) == expected(q, m, metric, top_k, lambda s, j: (s, j) in hidden)


def test_recall_grows_with_probes(spark):
    m, q = vectors(200), vectors(40, 1)
    items, queries = item_table(spark, m), query_table(spark, q, np.full(40, 5))
    index = ivf.build_index(items, ivf.train_cells(items, 10))
    exact = knn.knn_join(queries, items)
    shares = [ivf.recall(ivf.ivf_join(queries, index, n), exact).first()["recall"] for n in (1, 5, 10)]
    assert shares == sorted(shares) and shares[0] > 0 and shares[-1] == 1.0


def test_fetch(spark):
    items = item_table(spark, vectors(10))
    assert items_module.fetch(items, 4).first()["id"] == 4
    with pytest.raises(KeyError):
        items_module.fetch(items, 44)
    ids = local_table(spark, [(1,), (2,), (2,), (50,)], "id long")
    assert sorted(r["id"] for r in items_module.multi_fetch(items, ids).collect()) == [1, 2, 2]
    assert [r["id"] for r in items_module.missing_ids(items, ids).collect()] == [50]


def test_items_of_another_width_are_rejected(spark):
    raw = local_table(spark, [(0, [1.0, 2.0]), (1, [1.0]), (2, None)], "id long, embedding array<float>")
    assert [r["id"] for r in items_module.load_items(raw, dim=2).collect()] == [0]
    assert {(r["id"], r["width"]) for r in items_module.rejected_items(raw, 2).collect()} == {(1, 1), (2, -1)}


def test_search_of_one_vector(spark):
    m, q = vectors(30), vectors(1, 5)
    got = knn.search(item_table(spark, m), q[0].tolist(), 4).collect()
    assert {(0, 0, r["rank"], r["id"]) for r in got} == expected(q, m, "cosine_sim", [4])


def test_projection(spark):
    items = item_table(spark, vectors(10))
    rows = local_table(spark, [(1, 0.5)], "id long, score double")
    assert items_module.project_result(rows, items, False, False).columns == ["id", "score"]
    assert "embedding" in items_module.project_result(rows, items).columns
    assert items_module.project_result(rows, items, False).columns == ["id", "score", "kind"]
    assert items_module.restrict(items, F.col("kind") == 0).count() == 4


BROKEN = {3: np.nan, 17: np.inf, 30: -np.inf}


@pytest.mark.parametrize("metric", ivf.INDEXED_METRICS)
def test_broken_vectors_are_never_found(spark, metric):
    m, q = vectors(200), vectors(20, 1)
    for row, value in BROKEN.items():
        m[row, row % DIM] = value
    q[5, 2], q[6, 0] = np.nan, np.inf
    items, top_k = item_table(spark, m), np.full(20, 5)
    queries = query_table(spark, q, top_k)
    sound = np.nan_to_num(m, posinf=0, neginf=0)
    wanted = {r for r in expected(np.nan_to_num(q), sound, metric, top_k, lambda _, j: j in BROKEN) if (r[0], r[1]) not in ((1, 1), (1, 2))}
    assert found(knn.knn_join(queries, items, metric)) == wanted
    index = ivf.build_index(items, ivf.train_cells(items, 10, metric), metric)
    assert found(ivf.ivf_join(queries, index)) == wanted
    nearest = knn.search(items, q[0].tolist(), 200, metric).collect()
    assert len(nearest) == 197 and not {r["id"] for r in nearest} & set(BROKEN)
    with pytest.raises(ValueError):
        knn.search(items, q[5].tolist(), 3, metric)


def test_cosine_of_broken_vectors_is_zero(spark):
    from sessionloom.functions import vectors as V

    rows = [([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), ([float("nan"), 1.0], [1.0, 1.0]), ([float("inf"), 1.0], [1.0, 1.0])]
    table = local_table(spark, rows, "a array<double>, b array<double>")
    got = [r[0] for r in table.select(V.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1, 0, 0, 0])


@pytest.mark.parametrize("n_probe", [None, 2])
def test_stored_index(spark, tmp_path, n_probe):
    m, q = vectors(120), vectors(20, 1)
    items, queries = item_table(spark, m), query_table(spark, q, np.full(20, 5))
    index = ivf.build_index(items, ivf.train_cells(items, 8), block_floats=DIM * 10)
    ivf.write_index(index, str(tmp_path))
    again = ivf.read_index(spark, str(tmp_path))
    assert found(ivf.ivf_join(queries, again, n_probe)) == found(ivf.ivf_join(queries, index, n_probe)) != set()
    plan = again.items.where(F.col("unit").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [unit" in plan


def test_results_don_t_carry_vectors():
    """What a task holds grows with the results' ids and scores, not with a vector for each."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    q, m = rng.normal(size=(500, 64)), rng.normal(size=(400, 64))
    queries = pa.table({"session_id": np.arange(500), "q_idx": np.zeros(500, np.int32), "embedding": list(q), "top_k": np.full(500, 400), "history_value": pa.nulls(500, pa.int64())})
    items = pa.table({"item_id": np.arange(400), "item_embedding": list(m), "item_value": np.arange(400)})
    usual, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    try:
        rows = knn.block_search(queries, items, "cosine_sim", ["top_k"]).num_rows
    finally:
        pa.set_memory_pool(usual)
    assert rows == 200_000 and pool.max_memory() < 40_000_000


def test_hidden_items_are_told_for_one_session_at_a_time(monkeypatch):
    """A value that half of the items share takes no room for every session that hides it."""
    import pyarrow as pa

    n_items, n_sessions = 4000, 1500
    monkeypatch.setattr(knn, "TILE_CELLS", 1 << 16)
    q, m = vectors(n_sessions, 1), vectors(n_items)
    sessions = list(range(n_sessions))
    hides = [None if s % 5 == 0 else s % 2 for s in sessions]
    asked = pa.table(
        {
            "session_id": sessions + [s for s in sessions if hides[s] is not None],
            "q_idx": pa.array([0] * n_sessions + [None] * (n_sessions * 4 // 5), pa.int32()),
            "embedding": pa.array([v.tolist() for v in q] + [None] * (n_sessions * 4 // 5), pa.list_(pa.float64())),
            "top_k": pa.array([3] * n_sessions + [None] * (n_sessions * 4 // 5), pa.int32()),
            "history_value": pa.array([None] * n_sessions + [h for h in hides if h is not None], pa.int64()),
        }
    )
    held = pa.table({"item_id": range(n_items), "item_embedding": [v.tolist() for v in m], "item_value": [i % 2 for i in range(n_items)]})
    tracemalloc.start()
    found = knn.block_search(asked, held, "dot_product", ["top_k"])
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    all_scores = scores(q, m, "dot_product")
    best = {s: sorted((-all_scores[s, i], i) for i in range(n_items) if i % 2 != hides[s])[:3] for s in sessions[::50]}
    got = {s: [] for s in best}
    for r in found.to_pylist():
        if r["session_id"] in got:
            got[r["session_id"]].append((-r["score"], r["id"]))
    assert {s: sorted(rows) for s, rows in got.items()} == best
    assert found.num_rows == 3 * n_sessions and most < 16 << 20
