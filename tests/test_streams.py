"""Streams: whatever way they are cut, nothing is lost and answers are the same."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionloom.config import release, shared_dir, stage
from sessionloom.operators.running import running_sums
from sessionloom.operators.states import session_state_trace
from sessionloom.plans import batches
from sessionloom.plans import workload as w
from sessionloom.sources import sessions
from sessionloom.streaming import events, lists, serving, turns


@pytest.fixture(scope="module")
def world(spark, sf_dir):
    items = w.items(spark, sf_dir)
    routed = stage(sessions.route_algorithm(w.sessions(spark, sf_dir)))
    log = stage(w.valid_actions(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).where("session_id < 6"))
    return items, routed, log, w.topics(items), w.bias(routed, items), *w.builtin(spark)


def served(spark, world, path, cuts, options=batches.Options(), log=None):
    """What a stream serves that is cut before the actions of these numbers in time."""
    items, routed, whole, topics, bias, nodes, edges = world
    tables = serving.Tables(str(path)).create(spark)
    server = serving.Server(tables, routed, items, nodes, edges, topics, bias, options)
    log = whole if log is None else log
    number = F.col("_n")
    log = stage(running_sums(log.withColumn("_one", F.lit(1)), ["_one"], ["ts", "seq"], {"_n": F.lit(1)}).drop("_one"))
    for k, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, None])):
        part = log.where(number >= lo) if hi is None else log.where((number >= lo) & (number < hi))
        server(part.drop("_n"), k)
    rows = tables.read(spark, "served").select("session_id", "seq", "position", "id", F.round("score", 9)).collect()
    return sorted(tuple(r) for r in rows), tables


@pytest.fixture(scope="module")
def at_once(spark, world, tmp_path_factory):
    return served(spark, world, tmp_path_factory.mktemp("once"), [])


def test_micro_batches_do_not_matter(spark, world, at_once, tmp_path):
    assert served(spark, world, tmp_path, [60, 150, 190])[0] == at_once[0]


def test_lists_that_run_out_wait(spark, world, at_once, tmp_path, monkeypatch):
    """Without spare candidates, and few requests at a time, the answers are the same."""
    asked, few = [], world[2].where("session_id = 1")
    search = serving.answer_in_turn

    def counted(*args):
        asked.append(1)
        return search(*args)

    monkeypatch.setattr(serving, "answer_in_turn", counted)
    monkeypatch.setattr(turns, "SPARE", 0)
    monkeypatch.setattr(serving, "TURNS", 4)
    found = served(spark, world, tmp_path, [], log=few)[0]
    given = {r[:2] for r in found}
    assert found == [r for r in at_once[0] if r[:2] in given] and len({seq for _, seq in given}) > 4
    assert len(asked) > 1


def test_a_session_is_not_shown_an_item_twice(world, at_once):
    rows, _ = at_once
    first = {}
    for r in world[2].where("action <> 'BATCH'").collect():
        first[r.session_id] = min(first.get(r.session_id, (r.ts, r.seq)), (r.ts, r.seq))
    asked = {(r.session_id, r.seq): (r.ts, r.seq) for r in world[2].where("action = 'BATCH'").collect()}
    # Before its first signal a session gets random batches, which take no notice of history.
    minding = [(s, i) for s, seq, _, i, _ in rows if asked[s, seq] > first[s]]
    assert max(Counter(minding).values()) == 1 and len(minding) > 200


def test_first_answers_are_those_of_single_requests(spark, world, at_once):
    """The first request of every session, against the bulk job's chain."""
    items, routed, log, topics, bias, nodes, edges = world
    trace = session_state_trace(log, routed, nodes, edges).where("action = 'BATCH'")
    first = trace.groupBy("session_id").agg(F.min(F.struct("ts", "seq")).alias("at"))
    asked = stage(trace.join(first, "session_id").where(F.struct("ts", "seq") == F.col("at")))
    keyed = asked.select(serving.request_key().alias("session_id"), "batch_type", "params", F.col("session_id").alias("own"), "seq", "at")
    signals = log.where("action <> 'BATCH'").withColumnsRenamed({"session_id": "own", "seq": "n"})
    earlier = keyed.join(signals, "own").where(F.struct("ts", "n") < F.col("at"))
    earlier = stage(earlier.select("session_id", "ts", F.col("n").alias("seq"), "weight", "item_id"))
    profile = stage(batches.profiles.user_embeddings(earlier, items))
    warm = profile.select("session_id").distinct().withColumn("has_embeddings", F.lit(True))
    requests = stage(keyed.join(warm, "session_id", "left").fillna(False, ["has_embeddings"]))
    own_bias = bias.withColumnRenamed("session_id", "own").join(keyed.select("own", "session_id"), "own").drop("own")
    history = earlier.select("session_id", F.col("item_id").alias("history_value"))
    found = batches.serve_requests(requests, profile, items, topics, own_bias, history)
    expected = found.join(requests.select("session_id", "own", "seq"), "session_id")
    expected = sorted(tuple(r) for r in expected.select("own", "seq", "position", "id", F.round("score", 9)).collect())
    firsts = {(r.own, r.seq) for r in requests.collect()}
    assert expected == [r for r in at_once[0] if r[:2] in firsts] and len(firsts) > 4


def test_other_metrics_and_sizes(spark, world, tmp_path):
    options = batches.Options(metric="euclidean_dist", batch_size=6)
    few = world[2].where("session_id < 2 AND dayofmonth(ts) < 20").withColumn("batch_size", F.when(F.col("seq") % 2 == 0, 3))
    first, tables = served(spark, world, tmp_path / "a", [], options, few)
    assert first == served(spark, world, tmp_path / "b", [20], options, few)[0]
    sizes = Counter((s, seq) for s, seq, *_ in first)
    assert {3, 6} <= set(sizes.values()) and all(n <= (3 if seq % 2 == 0 else 6) for (_, seq), n in sizes.items())


def test_bias_that_is_missing(spark, world, tmp_path):
    items, routed, log, topics, bias, nodes, edges = world
    welcome = stage(routed.withColumn("state", F.when(F.col("blueprint") == "UNIQUE_JOURNEYS", "Welcome").otherwise(F.col("state"))))
    only = (items, welcome, log.where("session_id = 1 AND action = 'BATCH'"), topics, bias.limit(0), nodes, edges)
    requests = served(spark, only, tmp_path, [])[1].read(spark, "requests").collect()
    assert {(r.problem == "no bias", r.n_served == 0) for r in requests if r.batch_type == "biased"} == {(True, True)}
    assert all(r.problem is None for r in requests if r.batch_type != "biased")


def test_a_session_with_half_of_the_stream(spark, world, sf_dir, tmp_path):
    """One session's actions fill several partitions; states and counts are those of the whole log."""
    items, routed, _, _, _, nodes, edges = world
    log = w.valid_actions(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    log = stage(log.withColumn("session_id", F.when(F.col("seq") % 2 == 0, 3).otherwise(F.col("session_id"))))
    tables = serving.Tables(str(tmp_path)).create(spark)
    fold = serving.Fold(tables, routed, items, nodes, edges)
    for k in range(3):
        fold(log.where(F.floor((F.dayofmonth("ts") - 1) / 11) == k), k)
    found = {(r.session_id, r.seq): r for r in tables.read(spark, "steps").collect()}
    expected = session_state_trace(log, routed, nodes, edges).collect()
    assert len(found) == len(expected) and max(Counter(s for s, _ in found).values()) * 2 > len(found)
    seen = Counter()
    for r in sorted(expected, key=lambda r: (r.ts, r.seq)):
        own = found[r.session_id, r.seq]
        assert (own.state, own.next_state, own.has_embeddings) == (r.state, r.next_state, seen[r.session_id] > 0)
        seen[r.session_id] += r.action != "BATCH"
        assert own.profile_size == min(seen[r.session_id], 50)


def test_accepted_and_rejected_are_the_input(spark, world, sf_dir, tmp_path):
    items, routed, _, _, _, nodes, edges = world
    log = stage(w.parsed_actions(spark, sf_dir).withColumn("item_id", F.col("item_id") * 7).withColumn("ts", F.col("ts").cast("timestamp")))
    tables = serving.Tables(str(tmp_path)).create(spark)
    fold = serving.Fold(tables, routed.where("session_id <> 4"), items, nodes, edges, lateness="1 DAY")
    fold(log.where("dayofmonth(ts) > 15"), 0)
    fold(log.where("dayofmonth(ts) <= 15 or ts is null"), 1)
    steps, rejects = tables.read(spark, "steps"), tables.read(spark, "rejects")
    assert steps.count() + rejects.count() == log.count()
    reasons = {r.reason for r in rejects.select("reason").distinct().collect()}
    assert reasons == {"late", "unknown action", "unknown session", "unknown item"}
    # No rejected signal has moved a count.
    states = serving.latest_states(tables.read(spark, "states"))
    assert states.agg(F.sum("n_signals")).first()[0] == steps.where("action <> 'BATCH'").count()


def test_arrivals(spark, tmp_path):
    schema = "key string, ts timestamp, label string, _id long, _time string, reason2 string"

    def rows(*parts):
        return spark.createDataFrame([(k, None, str(n), 1, "x", "y") for n, (k, _) in enumerate(parts)], schema).withColumn(
            "ts", F.element_at(F.array(*[F.lit(t).cast("timestamp") for _, t in parts]), F.col("label").cast("int") + 1)
        )

    day = "2024-01-{:02d} 00:00:00".format
    first = [("a", day(1)), ("a", day(1)), ("b", day(5)), (None, day(4)), (None, day(4)), ("z", None)]
    second = [("b", day(5)), ("c", day(4)), ("d", day(2)), ("a", day(1)), ("e", day(9)), ("e", day(8))]
    third = [("e", day(9)), ("c", day(4)), ("f", day(8))]
    handed_on = []
    arrivals = events.Arrivals(str(tmp_path), "key", lateness="2 DAYS", then=lambda rows, k: handed_on.append(rows.count()))
    for k, part in enumerate((first, second, third)):
        for _ in range(2):  # a micro-batch that is repeated changes nothing
            arrivals(rows(*part), k)
    accepted, rejects = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("accepted", "rejects"))
    got = sorted((r.batch_id, r.key or "", r.ts.day) for r in accepted.collect())
    assert got == [(0, "", 4), (0, "", 4), (0, "a", 1), (0, "b", 5), (1, "c", 4), (1, "e", 8), (2, "f", 8)]
    assert handed_on == [4, 4, 2, 2, 1, 1]
    reasons = sorted((r.batch_id, r.key, r.reason) for r in rejects.collect())
    assert reasons == [
        (0, "a", "repeated"), (0, "z", "late"), (1, "a", "late"), (1, "b", "repeated"), (1, "d", "late"),
        (1, "e", "repeated"), (2, "c", "late"), (2, "e", "repeated"),
    ]
    assert accepted.columns[:6] == schema_names(schema)


def schema_names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def test_running_sums_of_a_key_in_many_partitions(spark):
    rows = spark.range(1000).select(F.lit(7).alias("k"), (999 - F.col("id")).alias("at"), (F.col("id") % 3).alias("v")).repartition(9)
    found = running_sums(rows, ["k"], ["at"], {"n": F.lit(1), "sum": F.col("v")}).orderBy("at").collect()
    total = 0
    for n, r in enumerate(found):
        assert (r.at, r.n, r["sum"]) == (n, n, total)
        total += r.v
    assert running_sums(rows.limit(0), ["k"], ["at"], {"n": F.lit(1)}).count() == 0


def test_states_without_answers(spark, sf_dir, monkeypatch):
    """The states after the stream are worked out without its answers."""
    from sessionloom.plans import catalog

    def refused(*args):
        raise AssertionError("an answer was asked for")

    monkeypatch.setattr(serving.Server, "answer", refused)
    found = {(r.session_id, r.state, r.has_embeddings) for r in catalog.QUERIES["update_state"](spark, sf_dir).collect()}
    states = w.current_sessions(spark, sf_dir).select("session_id", "state", "has_embeddings").collect()
    assert found and found <= {tuple(r) for r in states}


def test_profiles_are_as_deep_as_their_nodes_look(spark, world, tmp_path, monkeypatch):
    depths, queries = [], serving.request_queries

    def seen(requests, profile, *rest):
        held = profile.groupBy("session_id").count().join(requests, "session_id")
        depths.extend((r["count"], r.batch_type, r.n) for r in held.select("count", "batch_type", F.col("params.last_n").alias("n")).collect())
        return queries(requests, profile, *rest)

    monkeypatch.setattr(serving, "request_queries", seen)
    served(spark, world, tmp_path, [], log=world[2].where("session_id < 3"))
    assert depths and all(kind in ("personalized", "biased") and count <= (n or 50) for count, kind, n in depths)


def test_answers_come_from_lists_that_sessions_share(spark, world, at_once, tmp_path, monkeypatch):
    """No request is searched by itself, and no candidate moves, while the lists last."""

    def refused(*args):
        raise AssertionError("a request was searched by itself")

    monkeypatch.setattr(serving, "answer_in_turn", refused)
    monkeypatch.setattr(turns, "SPARE", 500)
    assert served(spark, world, tmp_path, [])[0] == at_once[0]


def test_slices_and_single_searches(spark, world, at_once, tmp_path, monkeypatch):
    """Answers are the same where vectors are too many to be shared, and slice by slice."""
    freed = []
    monkeypatch.setattr(lists, "LIST_ENTRIES", 0)
    monkeypatch.setattr(serving, "OWN_REQUESTS", 20)
    monkeypatch.setattr(serving, "CHANCE_FLOATS", 64 * 10)
    monkeypatch.setattr(serving, "release", lambda session: freed.append(session))
    assert served(spark, world, tmp_path, [])[0] == at_once[0]
    assert len(freed) > 3


def test_a_list_that_runs_out_stops_its_session_only(spark, world, at_once, tmp_path, monkeypatch):
    alone, search = [], serving.answer_in_turn

    def seen(requests, *args):
        alone.extend(r.request for r in requests.select("request").collect())
        return search(requests, *args)

    monkeypatch.setattr(serving, "answer_in_turn", seen)
    monkeypatch.setattr(turns, "SPARE", 12)
    assert served(spark, world, tmp_path, [70])[0] == at_once[0]
    asked = world[2].where("action = 'BATCH'").count()
    assert 0 < len(set(alone)) < asked


def test_what_a_slice_has_staged_is_given_back(spark):
    base = shared_dir(spark).removeprefix("file://")

    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(base) for f in names if f.startswith("part-"))

    release(spark)
    time.sleep(1)
    before = size()
    rows = stage(spark.range(300_000).select(F.rand(1).alias("x")))
    assert size() > before + 1_000_000
    del rows
    until = time.time() + 30
    while size() > before + 100_000 and time.time() < until:
        release(spark)
        time.sleep(0.5)
    assert size() <= before + 100_000
