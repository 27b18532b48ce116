import pytest
from pyspark.sql import functions as F

from sessionloom.config import local_table, stage
from sessionloom.operators import budgets, profiles
from sessionloom.plans import batches, catalog, workload as w
from sessionloom.sources import history, sessions
from sessionloom.sources.blueprints import SIMPLE_BLUEPRINT
from sessionloom.streaming import events, fold, serving


def weights(spark, *sessions_):
    rows = [(s, i, float(x)) for s, ws in enumerate(sessions_) for i, x in enumerate(ws)]
    return local_table(spark, rows, "session_id long, q_idx int, weight double")


def test_budgets(spark):
    q = weights(spark, [6, 20], [3, 3, 4], [0.2, 0.4], [10], [5.5, 5.5])
    found = budgets.adjust_weights(q, 10).orderBy("session_id", "q_idx").collect()
    got = {}
    for r in found:
        got.setdefault(r["session_id"], []).append(r["budget"])
    # Scaled up to the batch; within the slack; lifted, then scaled; exact; truncated.
    assert got == {0: [3, 8], 1: [3, 3, 4], 2: [5, 6], 3: [10], 4: [5, 5]}


def test_top_k(spark):
    q = weights(spark, [2, 8]).withColumn("budget", F.col("weight").cast("int"))
    plain = [tuple(r) for r in budgets.set_top_k(q, F.lit(False)).select("top_k", "top_k_mmr").orderBy("q_idx").collect()]
    wide = [tuple(r) for r in budgets.set_top_k(q, F.lit(True)).select("top_k", "top_k_mmr").orderBy("q_idx").collect()]
    assert plain == [(5, 1), (8, 1)] and wide == [(10, 5), (16, 8)]


def test_batches_hold_no_history_and_no_repeats(spark, sf_dir):
    items = w.items(spark, sf_dir)
    seen = w.history(spark, sf_dir)
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Dedicated")
    found = stage(batches.personalized_batch(asked, w.profile(spark, sf_dir), items, seen, batches.Options(batch_size=7)))
    assert found.join(seen.select("session_id", F.col("history_value").alias("id")), ["session_id", "id"]).isEmpty()
    per_session = found.groupBy("session_id").agg(F.count("id").alias("n"), F.count_distinct("id").alias("d"))
    assert per_session.where("n <> d or n > 7").isEmpty() and per_session.count() > 0


def test_cold_sessions_get_a_random_batch(spark, sf_dir):
    items = w.items(spark, sf_dir)
    asked = w.requests_in(spark, sf_dir, SIMPLE_BLUEPRINT, "Curated")
    nobody = w.profile(spark, sf_dir).where("false")
    cold = batches.personalized_batch(asked, nobody, items)
    chance = batches.random_batch(asked, items)
    assert sorted(cold.collect()) == sorted(chance.collect()) != []


def test_other_metrics(spark, sf_dir):
    """Items are unit vectors: all metrics rank alike, so MMR picks the same."""
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Dedicated")
    asked = asked.withColumn("params", F.col("params").withField("threshold", F.lit(None).cast("double")))
    profile, items = w.profile(spark, sf_dir), w.items(spark, sf_dir)
    served = [
        {(r["session_id"], r["id"]) for r in batches.personalized_batch(asked, profile, items, options=o).collect()}
        for o in (batches.Options(), batches.Options(metric="euclidean_dist"))
    ]
    assert served[0] == served[1] != set()


def test_batch_size_of_each_request(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Dedicated")
    asked = asked.withColumn("batch_size", F.when(F.col("session_id") % 2 == 0, 3).otherwise(12))
    items, profile = w.items(spark, sf_dir), w.profile(spark, sf_dir)
    found = stage(batches.personalized_batch(asked, profile, items))
    for size, rest in ((3, 0), (12, 1)):
        mine = F.col("session_id") % 2 == rest
        alone = batches.personalized_batch(asked.where(mine).drop("batch_size"), profile, items, options=batches.Options(size))
        assert sorted(found.where(mine).collect()) == sorted(alone.collect()) != []
    chance = batches.random_batch(asked, items).groupBy("session_id").count()
    assert {(r["session_id"] % 2, r["count"]) for r in chance.collect()} == {(0, 3), (1, 12)}


def test_late_actions_are_set_aside(spark, sf_dir, tmp_path):
    items = w.items(spark, sf_dir)
    nodes, edges = w.builtin(spark)
    routed = stage(sessions.route_algorithm(w.sessions(spark, sf_dir)))
    tables = serving.Tables(str(tmp_path)).create(spark)
    server = serving.Server(
        tables, routed, items, nodes, edges, w.topics(items), w.bias(routed, items), lateness="1 DAY"
    )
    log = w.valid_actions(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.dayofmonth("ts") < 5
    server(log.where(F.dayofmonth("ts") == 10), 0)
    server(log.where((F.dayofmonth("ts") == 11) | late), 1)
    assert tables.read(spark, "rejects").where("reason = 'late'").count() == log.where(late).count() > 0
    assert tables.read(spark, "signals").where("dayofmonth(ts) < 5").isEmpty()


def test_biased_requests_without_bias_are_rejected(spark, sf_dir):
    asked = w.requests_in(spark, sf_dir, "UNIQUE_JOURNEYS", "Welcome")
    bias = w.bias(asked, w.items(spark, sf_dir)).where("session_id <> 3")
    assert [r["session_id"] for r in profiles.missing_bias(asked, bias).collect()] == [3]
    found = batches.biased_batch(asked, w.profile(spark, sf_dir), bias, w.items(spark, sf_dir))
    assert 3 not in {r["session_id"] for r in found.collect()}


@pytest.mark.parametrize("name", ["next_batch", "session_state_trace", "apply_params"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, name):
    once = sorted(map(tuple, catalog.QUERIES[name](spark, sf_dir).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = sorted(map(tuple, catalog.QUERIES[name](spark, sf_dir).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert once == again


def test_profile_keeps_few_rows_per_session_before_the_shuffle(spark, sf_dir):
    latest = profiles.latest_signals(w.signals_log(spark, sf_dir))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_history_is_appended_once_per_batch(spark, tmp_path):
    rows = local_table(spark, [(1, 5), (1, 6)], "session_id long, history_value long")
    for batch_id in (0, 0, 1):
        history.append_history(rows, str(tmp_path), batch_id)
    assert history.read_history(spark, str(tmp_path)).count() == 4
    assert history.read_history(spark, str(tmp_path), before_batch=1).count() == 2
    assert history.read_history(spark, str(tmp_path), enabled=False).count() == 0


@pytest.fixture(scope="module")
def split_events(spark, sf_dir, tmp_path_factory):
    """The events in three files, in order of time."""
    path = tmp_path_factory.mktemp("events")
    log = w.table(spark, sf_dir, "events")
    for i, day in enumerate((10, 20, 31)):
        part = log.where(F.dayofmonth("ts").between([1, 11, 21][i], day))
        part.coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def action_stream(spark, sf_dir, path):
    schema = w.table(spark, sf_dir, "events").schema
    stream = events.read_stream(spark, path, schema, maxFilesPerTrigger=1)
    return catalog.signals.parse_actions(w.events_as_actions(stream), catalog.signals.vocabulary(spark)).where("known")


def test_stream_fold_equals_batch_trace(spark, sf_dir, split_events, tmp_path):
    nodes, edges = w.builtin(spark)
    routed = sessions.route_algorithm(w.sessions(spark, sf_dir))
    tables = fold.signal_stream(action_stream(spark, sf_dir, split_events), stage(routed), w.items(spark, sf_dir), nodes, edges, str(tmp_path))
    columns = ["session_id", "seq", "state", "next_state"]
    stored = tables.read(spark, "steps")
    assert stored.select("batch_id").distinct().count() == 3
    assert sorted(stored.select(columns).collect()) == sorted(w.trace(spark, sf_dir).select(columns).collect())


def test_serving_stream(spark, sf_dir, split_events, tmp_path):
    items = w.items(spark, sf_dir)
    nodes, edges = w.builtin(spark)
    routed = stage(sessions.route_algorithm(w.sessions(spark, sf_dir)))
    tables = serving.Tables(str(tmp_path)).create(spark)
    server = serving.Server(tables, routed, items, nodes, edges, w.topics(items), w.bias(routed, items), batches.Options(batch_size=4), snapshot_every=2)

    def twice(batch, batch_id):
        server(batch, batch_id)
        server(batch, batch_id)

    events.run_available(action_stream(spark, sf_dir, split_events), twice, "serving")
    # After the second of three micro-batches, only its snapshot and the third are read.
    states = serving.states_before(spark, tables, 3)
    assert sorted(states.collect()) == sorted(serving.latest_states(tables.read(spark, "states")).collect())
    assert [r["batch_id"] for r in tables.read(spark, "snapshots").select("batch_id").distinct().collect()] == [1]
    assert "PartitionFilters: [isnotnull(batch_id" in states._jdf.queryExecution().executedPlan().toString()
    expected = w.current_sessions(spark, sf_dir).select("session_id", "state", "has_embeddings")
    assert sorted(states.select(expected.columns).collect()) == sorted(expected.collect())
    assert tables.read(spark, "signals").count() == w.signals_log(spark, sf_dir).count()
    served = tables.read(spark, "served")
    assert served.select("batch_id").distinct().count() == 3
    assert served.groupBy("session_id", "seq").count().where("count > 4").isEmpty()
    # Every request has an answer, whatever micro-batch it came with.
    asked = w.valid_actions(spark, sf_dir).where("action = 'BATCH'").select("session_id", "seq")
    answered = tables.read(spark, "requests")
    assert sorted(answered.select("session_id", "seq").collect()) == sorted(asked.collect())
    sizes = {(r["session_id"], r["seq"]): r["n_served"] for r in answered.collect()}
    assert {(r["session_id"], r["seq"]): r["count"] for r in served.groupBy("session_id", "seq").count().collect()} == {
        k: n for k, n in sizes.items() if n
    }

    compact = serving.Tables(str(tmp_path / "compact")).create(spark)
    serving.compact_states(spark, tables, 2, compact)
    assert sorted(serving.latest_states(compact.read(spark, "states")).collect()) == sorted(states.collect())


def test_text_ids(spark, sf_dir, tmp_path):
    """Ids of sessions and items may be texts."""
    items = w.items(spark, sf_dir)
    named = items.withColumn("id", F.concat(F.lit("i"), "id")).withColumn("history_value", F.col("id"))
    nodes, edges = w.builtin(spark)
    asked = w.sessions(spark, sf_dir).withColumn("session_id", F.concat(F.lit("s"), "session_id"))
    routed = stage(sessions.route_algorithm(asked))
    log = w.valid_actions(spark, sf_dir).withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "session_id": F.concat(F.lit("s"), "session_id"),
            "item_id": F.concat(F.lit("i"), "item_id"),
        }
    )
    path = str(tmp_path / "log")
    log.write.parquet(path)
    tables = serving.Tables(str(tmp_path / "tables"), "string", "string").create(spark)
    # Topics and bias vectors are ids-free copies of the numbered items' ones.
    bias = w.bias(w.sessions(spark, sf_dir), items).withColumn("session_id", F.concat(F.lit("s"), "session_id"))
    server = serving.Server(tables, routed, named, nodes, edges, w.topics(items), bias)
    server(spark.read.parquet(path), 0)
    served = tables.read(spark, "served")
    assert served.count() > 0 and served.where("id NOT LIKE 'i%' OR session_id NOT LIKE 's%'").isEmpty()

    stream = events.read_stream(spark, path, log.schema)
    folded = fold.signal_stream(stream, routed, named, nodes, edges, str(tmp_path / "out"))
    assert folded.read(spark, "steps").count() == log.count()
