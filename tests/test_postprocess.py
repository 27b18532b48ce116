import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.operators import postprocess as P
from sessionloom.operators.mmr import greedy_picks, mmr
from sessionloom.operators.skew import salted_join

CANDIDATES = "session_id long, q_idx int, rank int, id long, score double, top_k int"


def candidates(spark, rows):
    return local_table(spark, rows, CANDIDATES)


def ids(df):
    return sorted((r["session_id"], r["q_idx"], r["id"]) for r in df.collect())


def test_threshold_is_relaxed_to_the_mean(spark):
    rows = [(1, 0, i + 1, i, s, 5) for i, s in enumerate([0.9, 0.5, 0.1])]
    rows += [(1, 1, i + 1, i, s, 5) for i, s in enumerate([0.3, 0.3, 0.3])]
    c = candidates(spark, rows)
    kept = ids(P.apply_threshold(c, threshold=F.lit(0.8)))
    assert kept == [(1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (1, 1, 2)]
    assert ids(P.apply_threshold(c, threshold=F.lit(0.2))) == [(1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (1, 1, 2)]
    assert P.apply_threshold(c, threshold=F.lit(None).cast("double")).count() == 6
    far = ids(P.apply_threshold(c, "euclidean_dist", F.lit(0.2)))
    assert far == [(1, 0, 1), (1, 0, 2), (1, 1, 0), (1, 1, 1), (1, 1, 2)]


def test_threshold_never_empties_a_query(spark):
    rng = np.random.default_rng(0)
    rows = [(s, 0, i + 1, i, float(x), 9) for s in range(30) for i, x in enumerate(rng.normal(size=s % 7 + 1))]
    kept = P.apply_threshold(candidates(spark, rows), threshold=F.lit(5.0))
    assert kept.select("session_id").distinct().count() == 30


def test_duplicates_keep_their_first_query(spark):
    rows = [(1, 1, 1, 7, 0.9, 5), (1, 0, 2, 7, 0.8, 5), (1, 0, 1, 8, 0.85, 5), (2, 1, 1, 7, 0.7, 5)]
    c = candidates(spark, rows)
    assert ids(P.remove_duplicates(c)) == [(1, 0, 7), (1, 0, 8), (2, 1, 7)]
    assert P.remove_duplicates(c.withColumn("remove_duplicates", F.lit(False))).count() == 4
    assert [tuple(r) for r in P.non_unique_ids(c).collect()] == [(7, 3)]


def test_removed_ids(spark):
    c = candidates(spark, [(1, 0, 1, 7, 0.9, 5), (2, 0, 1, 7, 0.8, 5)])
    assert P.remove_ids(c, local_table(spark, [(7,)], "id long")).count() == 0
    assert ids(P.remove_ids(c, local_table(spark, [(1, 7)], "session_id long, id long"))) == [(2, 0, 7)]


def test_ranks_follow_the_metric(spark):
    c = candidates(spark, [(1, 0, i + 1, i, s, 5) for i, s in enumerate([0.2, 0.9, 0.9])])
    near = {r["id"]: r["rank"] for r in P.rank_candidates(c).collect()}
    far = {r["id"]: r["rank"] for r in P.rank_candidates(c, "euclidean_dist").collect()}
    assert near == {1: 1, 2: 2, 0: 3} and far == {0: 1, 1: 2, 2: 3}


def test_shuffle_depends_on_the_seed_only(spark):
    c = candidates(spark, [(1, 0, i, i, 0.5, 50) for i in range(30)])
    one = P.shuffle_pool(c, 1).orderBy("position").select("id").collect()
    again = P.shuffle_pool(c.repartition(5), 1).orderBy("position").select("id").collect()
    other = P.shuffle_pool(c, 2).orderBy("position").select("id").collect()
    assert one == again != other
    assert P.take_batch(P.shuffle_pool(c, 1), 10).count() == 10


def test_results_are_appended_with_new_numbers(spark):
    a = candidates(spark, [(1, 0, 1, 5, 0.5, 2), (1, 2, 1, 6, 0.5, 2)])
    b = candidates(spark, [(1, 0, 1, 5, 0.4, 2), (2, 0, 1, 9, 0.4, 2)])
    assert ids(P.concat_results(a, b)) == [(1, 0, 5), (1, 2, 6), (1, 3, 5), (2, 0, 9)]


def test_query_batches_of_unequal_size(spark):
    q = local_table(spark, [(1, 0, 10)], "session_id long, q_idx int, batch_size int")
    assert P.concat_queries(q, q).count() == 2
    with pytest.raises(ValueError):
        P.concat_queries(q, q.withColumn("batch_size", F.lit(5)))


def naive_mmr(q, m, k, lam=0.5):
    """One candidate at a time, seeded with the least similar."""

    def cos(a, b):
        return round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9)

    sims = [cos(q, v) for v in m]
    chosen = [min(range(len(m)), key=lambda i: (sims[i], i))]
    while len(chosen) < min(k, len(m)):
        rest = [i for i in range(len(m)) if i not in chosen]
        worth = {i: round(lam * sims[i] - (1 - lam) * max(cos(m[i], m[j]) for j in chosen), 9) for i in rest}
        chosen.append(max(rest, key=lambda i: (worth[i], -i)))
    return sims, chosen


def test_mmr_picks(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(40, 6))
    m[3] = m[4]
    items = local_table(spark, [(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<double>")
    rows, expected = [], set()
    for s in range(12):
        q, n, k = rng.normal(size=6), s + 1, [0, 3, 5, 50][s % 4]
        pool = rng.choice(40, n, replace=False)
        sims, chosen = naive_mmr(q, m[pool], k)
        rows += [(s, 0, i + 1, int(pool[i]), sims[i], n, k) for i in range(n)]
        chosen = list(range(n)) if k == 0 else chosen
        expected |= {(s, r + 1, int(pool[i])) for r, i in enumerate(chosen)}
    c = local_table(spark, rows, CANDIDATES + ", top_k_mmr int")
    got = {(r["session_id"], r["rank"], r["id"]) for r in mmr(c, items).collect()}
    assert got == expected


def test_mmr_of_other_metrics_takes_the_query_vector(spark):
    items = local_table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "id long, embedding array<double>")
    rows = [(1, 0, i + 1, i, d, 3, 1, [1.0, 0.1]) for i, d in enumerate([0.1, 1.3, 0.9])]
    c = local_table(spark, rows, CANDIDATES + ", top_k_mmr int, query_embedding array<double>")
    assert [r["id"] for r in mmr(c, items, "euclidean_dist").collect()] == [1]
    assert [r["id"] for r in mmr(c, items, "euclidean_dist", seed="most_similar").collect()] == [0]


def test_greedy_picks_ignore_padding():
    block = np.zeros((1, 3, 2))
    block[0, :2] = [[1, 0], [0, 1]]
    sim = np.array([[-0.5, 0.2, -np.inf]])
    assert greedy_picks(block, sim, np.array([2]), 0.5, "least_similar").tolist() == [[0, 1]]


def test_salted_join_equals_join(spark):
    facts = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), "id")
    dims = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = facts.join(dims, "k", how).select("k", "id", "v")
        salted = salted_join(facts, dims, "k", ["id"], how).select("k", "id", "v")
        assert salted.count() == plain.count()
        assert salted.exceptAll(plain).isEmpty()
