from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.functions.permutations import permuted, pivots
from sessionloom.operators import profiles


@pytest.mark.parametrize("n", [1, 2, 7, 64, 101])
def test_every_place_comes_once(spark, n):
    prefix = F.concat(F.lit("k"), F.col("key").cast("string"))
    rows = spark.range(3).select(F.col("id").alias("key")).select("key", pivots(prefix, n).alias("p"))
    rows = rows.select("key", "p", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("x"))
    found = rows.select("key", permuted(F.col("x"), F.col("p"), prefix, n).alias("y")).collect()
    for key in range(3):
        assert sorted(r["y"] for r in found if r["key"] == key) == list(range(n))


def topics(spark, n):
    return local_table(spark, [(i, [float(i)]) for i in range(n)], "topic int, embedding array<double>")


def test_draws_are_even_and_without_repeats(spark):
    asked = spark.range(2000).select(F.col("id").alias("session_id"), F.lit(3).alias("n_topics"))
    found = profiles.sampled_profile(asked, topics(spark, 10)).collect()
    first, drawn = Counter(), {}
    for r in found:
        drawn.setdefault(r["session_id"], []).append(r["embedding"][0])
        first[r["q_idx"], r["embedding"][0]] += 1
    assert len(drawn) == 2000 and all(len(set(x)) == 3 for x in drawn.values())
    # 200 expected, with a standard deviation of 13.
    assert len(first) == 30 and all(135 < n < 265 for n in first.values())
    pairs = Counter(frozenset(x[:2]) for x in drawn.values())
    # Of 45 pairs, 44 expected each, with a standard deviation of 7.
    assert len(pairs) == 45 and all(10 < n < 80 for n in pairs.values())


def test_odd_requests(spark):
    rows = [(1, 0), (2, None), (3, 9), (4, -1)]
    asked = local_table(spark, rows, "session_id long, n_topics int")
    found = profiles.sampled_profile(asked, topics(spark, 4)).collect()
    assert sorted((r["session_id"], r["q_idx"]) for r in found) == [(3, i) for i in range(4)]
    assert sorted(r["embedding"][0] for r in found) == [0.0, 1.0, 2.0, 3.0]
    assert profiles.sampled_profile(asked, topics(spark, 0)).isEmpty()
    plan = profiles.sampled_profile(asked, topics(spark, 4))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan
