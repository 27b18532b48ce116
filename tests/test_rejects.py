from pyspark.sql import functions as F

from sessionloom.config import local_table
from sessionloom.operators import profiles, states
from sessionloom.plans import workload as w
from sessionloom.sources import rejects

ACTIONS = "session_id long, ts timestamp, seq long, action string, known boolean, is_batch boolean, item_id long"


def test_every_reason_and_no_crash(spark):
    nodes, edges = w.builtin(spark)
    blueprint = nodes.first()["blueprint"]
    start = nodes.where((F.col("blueprint") == blueprint) & (F.col("node_ord") == 1)).first()["name"]
    sessions = local_table(
        spark,
        [(1, blueprint, "0"), (2, None, "0"), (3, "no such", "0"), (4, blueprint, "nowhere"), (5, blueprint, None), (6, blueprint, start)],
        "session_id long, blueprint string, state string",
    )
    rows = [(s, None, s, "BATCH", True, True, None) for s in (1, 2, 3, 4, 5, 6, 7)]
    rows += [(1, None, 20, "CLICK_LINK", True, False, 0), (1, None, 21, "CLICK_LINK", True, False, 999), (1, None, 22, "CLICK_LINK", True, False, None)]
    rows += [(1, None, 23, "ERROR", False, False, 0), (1, None, 24, "BATCH", True, True, 999)]
    actions = local_table(spark, rows, ACTIONS).withColumn("ts", F.timestamp_seconds("seq"))
    items = local_table(spark, [(0,), (1,)], "id long")
    accepted, rejected = rejects.split_actions(actions, sessions, nodes, items)
    reasons = {r["seq"]: r["reason"] for r in rejected.collect()}
    assert reasons == {
        2: rejects.NO_BLUEPRINT, 3: rejects.NO_BLUEPRINT, 4: rejects.UNKNOWN_STATE, 5: rejects.UNKNOWN_STATE,
        7: rejects.UNKNOWN_SESSION, 21: rejects.UNKNOWN_ITEM, 22: rejects.UNKNOWN_ITEM, 23: rejects.UNKNOWN_ACTION,
    }
    assert sorted(r["seq"] for r in accepted.collect()) == [1, 6, 20, 24]
    # The trace itself does not fail on what should have been set aside.
    trace = states.session_state_trace(actions.where("known"), sessions, nodes, edges)
    assert {r["session_id"] for r in trace.collect()} == {1, 6}


def test_profiles_as_deep_as_nodes_ask(spark):
    items = local_table(spark, [(i, [float(i), 1.0]) for i in range(90)], "id long, embedding array<double>")
    log = items.select(F.lit(1).cast("long").alias("session_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), F.col("id").alias("item_id"), F.lit(1.0).alias("weight"))
    nodes = spark.sql("SELECT named_struct('last_n', 80) AS params UNION ALL SELECT named_struct('last_n', 0)")
    profile = profiles.user_embeddings(log, items, profiles.profile_depth(nodes))
    asked = nodes.where("params.last_n = 80").select(F.lit(1).cast("long").alias("session_id"), "params")
    assert profiles.personalized_profile(profile, asked).count() == 80
    assert profiles.profile_depth(nodes.limit(0)) == 50
