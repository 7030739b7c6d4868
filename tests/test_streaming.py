import json
import os
import random
from types import SimpleNamespace as Bag

import pytest
from pyspark.sql import Row, functions as F

from conftest import rows
from shelfwise import constants as K
from shelfwise.operators import recommend as R
from shelfwise.sources import readers, sinks
from shelfwise.streaming import events as E, monitor as M, replay as S, state

PRODUCTS = [{"id": i, "name": f"p{i}", "category": "AB"[i % 2], "price": float(i),
             "description": "quick fox" if i % 3 else "lazy dog"} for i in range(8)]
PROFILE = {"preferred_categories": ["A"], "preferred_features": ["FOX"]}


def event(i, kind, user, product, profile=PROFILE, **more):
    return {"event_id": i, "event_type": kind, "timestamp": 1000.0 + i, "user_id": user,
            "product_id": product, "product": PRODUCTS[product], "user_profile": profile, **more}


EVENTS = [
    event(0, K.VIEW_EVENT, 1, 0), event(1, K.PURCHASE_EVENT, 1, 2),
    event(2, K.PURCHASE_EVENT, 2, 3), event(3, K.VIEW_EVENT, None, 1, None), "{broken",
    event(4, "wave", 1, 1), event(5, K.VIEW_EVENT, 2, 5), event(6, K.PURCHASE_EVENT, 2, 6),
    event(7, K.VIEW_EVENT, 1, 4, {**PROFILE, "purchase_history": [2]}),
    event(8, K.PURCHASE_EVENT, 1, 7), event(9, K.VIEW_EVENT, 0, 3), "null", "[]",
    event(10, K.VIEW_EVENT, 3, 3, None), event(11, K.PURCHASE_EVENT, 3, 3, None)]


def land(folder, name, messages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")


def catalog(spark):
    return spark.createDataFrame(
        [(p["id"], p["name"], p["category"], p["price"], p["description"], p["id"])
         for p in PRODUCTS],
        "id bigint, name string, category string, price double, description string, pos bigint")


def run(spark, source, base, files=1):
    S.Recommender(catalog(spark), f"{base}/out", 3, F.col("pos")).start(
        readers.stream_text_files(spark, source, files), f"{base}/checkpoint",
        available_now=True).awaitTermination()


@pytest.fixture
def landed(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(0, len(EVENTS), 5):
        land(source, f"part-{n:02d}.txt", EVENTS[n:n + 5])
        os.utime(os.path.join(source, f"part-{n:02d}.txt"), (1e9 + n, 1e9 + n))
    return source


def test_stream_equals_batch_and_restarts_without_repeats(spark, landed, tmp_path):
    run(spark, landed, tmp_path)
    out = tmp_path / "out"
    recs = spark.read.parquet(f"{out}/recommendations")
    assert recs.select("batch_id").distinct().count() > 1

    accepted = E.accepted(E.parse(spark.read.text(landed)))
    views = E.views(accepted)
    shelf = catalog(spark)
    preferences = R.Preferences.of(views, shelf)
    batch = R.recommend(views, shelf, 3, F.col("pos"), preferences)
    ids = F.transform("recommendations", lambda r: r["id"]).alias("ids")
    assert rows(recs.select("event_id", ids, "has_user_profile")) == rows(
        batch.select("event_id", ids, "has_user_profile"))
    counters = R.event_counters(batch, R.relevant_totals(preferences, shelf))
    final = S.cumulative_metrics(spark.read.parquet(f"{out}/metrics")).first()
    overall = R.global_metrics(counters).first()
    for name in (*R.COUNTERS, "precision", "recall", "f1"):
        assert final[name] == overall[name]
    assert (final["events_processed"], final["active_user_sessions"]) == (12, 3)
    assert rows(spark.read.parquet(f"{out}/rejects").select("rejected")) == [
        ("[]",), ("null",), ("{broken",)]
    assert spark.read.parquet(f"{out}/purchases").count() == 5

    before = rows(recs.drop("recommendations"))
    run(spark, landed, tmp_path)
    assert rows(spark.read.parquet(f"{out}/recommendations").drop("recommendations")) == before
    land(landed, "part-99.txt", [event(20, K.VIEW_EVENT, 1, 0)])
    run(spark, landed, tmp_path)
    assert spark.read.parquet(f"{out}/recommendations").count() == len(before) + 1


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    batch = spark.createDataFrame([(json.dumps(EVENTS[0]),)], "value string")
    engine = S.Recommender(catalog(spark), str(tmp_path / "out"), 3, F.col("pos"))
    for _ in range(2):
        engine.process(batch, 0)
    assert spark.read.parquet(str(tmp_path / "out/recommendations")).count() == 1
    assert S.cumulative_metrics(
        spark.read.parquet(str(tmp_path / "out/metrics"))).first()["events_processed"] == 1


def test_published_messages(spark, tmp_path):
    batch = spark.createDataFrame([(json.dumps(e),) for e in EVENTS[:3]], "value string")
    sent = []

    def publish(messages, topic):
        sent.extend((topic, json.loads(r["value"])) for r in messages.collect())
    S.Recommender(catalog(spark), str(tmp_path / "out"), 3, F.col("pos"), publish).process(batch, 0)
    kinds = [(topic, m["event_type"]) for topic, m in sent]
    assert sorted(kinds) == [
        (K.TOPIC_METRICS, K.METRICS_MESSAGE), (K.TOPIC_RECOMMENDATIONS, K.PURCHASE_MESSAGE),
        (K.TOPIC_RECOMMENDATIONS, K.PURCHASE_MESSAGE),
        (K.TOPIC_RECOMMENDATIONS, K.RECOMMENDATION_MESSAGE)]
    assert sent[-1][1]["metrics"]["events_processed"] == 3
    metrics = S.cumulative_metrics(spark.read.parquet(str(tmp_path / "out/metrics")))
    closing = E.metrics_messages(S.with_runtime(metrics, 1.5)).first()["metrics"]
    assert (closing["events_per_second"], closing["runtime_seconds"]) == (2.0, 1.5)
    assert S.with_runtime(metrics, 0).first()["events_per_second"] == 0.0


def test_anonymous_and_user_zero(spark, landed):
    views = {r["event_id"]: r["has_user_profile"] for r in
             E.views(E.accepted(E.parse(spark.read.text(landed)))).collect()}
    assert views == {0: True, 3: False, 5: True, 7: True, 9: True, 10: False}


def test_sessions_replace_and_keep_later_purchases(spark, landed, tmp_path):
    run(spark, landed, tmp_path)
    out = str(tmp_path / "out")
    state = {r["user_id"]: r for r in S.stored_sessions(spark, out).collect()}
    assert {u: r["event_id"] for u, r in state.items()} == {0: 9, 1: 7, 2: 5}
    assert state[1]["profile"]["purchase_history"] == [2]
    assert state[2]["profile"]["price_sensitivity"] == 0.5
    assert state[2]["profile"]["viewing_history"] == []
    # The purchases 1 and 2 came before the last view of their users; user 3 has no session.
    assert rows(S.stored_session_purchases(spark, out), "user_id", "event_id") == [(1, 8), (2, 6)]


def sequence(seed, n):
    """Events of few users in no order of time, some repeated views, some users without a profile or id."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = rng.choice([0, 1, 1, 1, 2, 3, None])
        profile = None if user in (3, None) else {**PROFILE, "purchase_history": [i]}
        out.append(event(i, rng.choice([K.VIEW_EVENT, K.PURCHASE_EVENT, "wave"]), user, rng.randrange(8), profile))
    rng.shuffle(out)
    return out


def test_state_over_twenty_batches_and_a_restart(spark, tmp_path):
    """Late events, and users in many batches: the state gives what the whole table gives."""
    source, events = str(tmp_path / "in"), sequence(3, 120)

    def deliver(first, last):
        for n in range(first, last):
            land(source, f"part-{n:02d}.txt", events[6 * n:6 * n + 6])
            os.utime(os.path.join(source, f"part-{n:02d}.txt"), (1e9 + n, 1e9 + n))
        engine = S.Recommender(catalog(spark), f"{tmp_path}/out", 3, F.col("pos"), every=10)
        engine.start(readers.stream_text_files(spark, source, 1), f"{tmp_path}/checkpoint", available_now=True).awaitTermination()

    deliver(0, 8)
    deliver(8, 20)
    out = str(tmp_path / "out")
    assert spark.read.parquet(f"{out}/timings").count() == 20
    views = [e for e in events if e["event_type"] == K.VIEW_EVENT and e["user_profile"] and e["user_id"] is not None]
    last = {u: max(e["event_id"] for e in views if e["user_id"] == u) for u in (0, 1, 2)}
    assert {(r["user_id"], r["event_id"], tuple(r["profile"]["purchase_history"])) for r in S.stored_sessions(spark, out).collect()} == {
        (u, i, (i,)) for u, i in last.items()}
    assert rows(S.stored_session_purchases(spark, out), "user_id", "event_id") == sorted(
        ((e["user_id"], e["event_id"]) for e in events
         if e["event_type"] == K.PURCHASE_EVENT and e["user_id"] in last and e["event_id"] > last[e["user_id"]]), key=repr)
    totals = spark.read.parquet(f"{out}/totals").orderBy(F.col("batch_id").desc()).first()
    whole = S.cumulative_metrics(spark.read.parquet(f"{out}/metrics")).first()
    assert all(totals[c] == whole[c] for c in S.METRIC_COLUMNS)
    assert (totals["events_processed"], totals["active_user_sessions"]) == (120, 3) and totals["runtime_seconds"] > 0
    # positions go on over batches: within each batch by time
    order = [e for n in range(20) for e in sorted(events[6 * n:6 * n + 6], key=lambda e: e["event_id"])]
    due = [(e["event_id"], n) for n, e in enumerate(order) if n % 10 == 0 and e["event_type"] == K.VIEW_EVENT]
    updates = spark.read.parquet(f"{out}/updates")
    assert rows(updates, "event_id", "events_processed") == sorted(due, key=repr)
    seen = {e["event_id"]: len({x["user_id"] for x in order[:n + 1] if x in views}) for n, e in enumerate(order)}
    assert all(r["active_user_sessions"] == seen[r["event_id"]] and r["runtime_seconds"] > 0 for r in updates.collect())
    closing = spark.read.parquet(f"{out}/closing").first()
    assert closing["metrics"]["events_processed"] == 120 and closing["metrics"]["events_per_second"] > 0


def test_a_batch_that_is_scored_again_counts_once(spark, tmp_path):
    """The first query may repeat its last batch after a failure, when the second has already read it."""
    engine = S.Recommender(catalog(spark), str(tmp_path / "out"), 3, F.col("pos"))
    texts = [spark.createDataFrame([(json.dumps(e),) for e in part], "value string") for part in (EVENTS[:4], EVENTS[5:9])]
    for n in (0, 1, 1):
        engine.process(texts[n], n)
    totals = spark.read.parquet(str(tmp_path / "out/totals")).orderBy(F.col("batch_id").desc()).first()
    assert (totals["events_processed"], totals["active_user_sessions"]) == (8, 2)


def tables(spark):
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "shelfwise")
    return os.listdir(folder) if os.path.isdir(folder) else []


def test_work_per_batch_stays_flat(spark, tmp_path):
    """Jobs of a batch do not grow with the batches before it."""
    engine = S.Recommender(catalog(spark), str(tmp_path / "out"), 3, F.col("pos"))
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in range(5):
        part = [event(10 * n + i, K.VIEW_EVENT if i % 2 else K.PURCHASE_EVENT, 10 * n + i, i) for i in range(6)]
        spark.sparkContext.setJobGroup(f"score-{n}", "score")
        engine.score(spark.createDataFrame([(json.dumps(e),) for e in part], "value string"), n)
        jobs.append(len(tracker.getJobIdsForGroup(f"score-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(set(jobs[1:])) == 1
    kept = len(tables(spark))
    engine.score(spark.createDataFrame([(json.dumps(event(99, K.VIEW_EVENT, 1, 1)),)], "value string"), 5)
    assert len(tables(spark)) == kept  # a batch leaves no intermediate table
    engine.score(spark.createDataFrame([], "value string"), 6)
    engine.account_for_all()
    first = spark.read.parquet(str(tmp_path / "out/totals/batch_id=0")).first()
    assert first["events_processed"] == 31 and first["active_user_sessions"] == 15


def test_a_stream_that_is_stopped_sends_a_closing_message(spark, landed, tmp_path, monkeypatch):
    """Both queries run side by side, between stand-ins for the topics."""
    asked, sent = [], []

    def topics(session, options):
        asked.append(options)
        return readers.stream_text_files(session, landed, 1)

    monkeypatch.setattr(readers, "stream_topics", topics)
    monkeypatch.setattr(sinks, "write_topic", lambda messages, servers, topic: sent.extend(
        (servers, topic, json.loads(r["value"])) for r in messages.collect()))
    engine = S.Recommender(catalog(spark), str(tmp_path / "out"), 3, F.col("pos"), every=10)
    running = S.run_on_topics(engine, "host:1", str(tmp_path / "c"), "1 second", 500)
    running.scoring.processAllAvailable()
    assert running.accounts.isActive
    running.stop()
    assert not running.scoring.isActive and running.accounts is None
    assert asked[0]["subscribe"] == K.TOPIC_EVENTS and asked[0]["maxOffsetsPerTrigger"] == "500"
    assert {s for s, _, _ in sent} == {"host:1"}
    kinds = [(t, m["event_type"]) for _, t, m in sent]
    assert kinds.count((K.TOPIC_RECOMMENDATIONS, K.PURCHASE_MESSAGE)) == 5
    times = [m["processing_time_ms"] for _, _, m in sent if m["event_type"] == K.RECOMMENDATION_MESSAGE]
    assert len(times) == 6 and min(times) > 0
    metrics = [m["metrics"] for _, t, m in sent if t == K.TOPIC_METRICS]
    assert [m["events_processed"] for m in metrics] in ([0, 12], [0, 10, 12]) and metrics[-1]["events_per_second"] > 0
    assert sum(r["messages"] for r in running.progress_rows().collect()) == len(EVENTS)


def test_recommendations_go_stale_by_other_users_events(spark, tmp_path):
    folder = str(tmp_path / "recs")
    schema = "event_id bigint, timestamp double, user_id bigint, recommendations array<struct<id: bigint>>"

    def add(*messages):
        spark.createDataFrame([(i, 60.0 * at, u, [(i,)]) for i, at, u in messages], schema).coalesce(1).write.mode("append").parquet(folder)

    def state():
        S.start_newest(spark.readStream.schema(schema).parquet(folder), str(tmp_path / "out"), str(tmp_path / "c"),
                       available_now=True).awaitTermination()
        return rows(S.newest_of(spark.read.parquet(str(tmp_path / "out"))), "user_id", "event_id", "is_stale")

    add((1, 10, 7), (2, 11, 8), (3, 9, 7), (4, 11, None))
    assert state() == [(7, 1, False), (8, 2, False)]
    add((5, 15.5, 9))
    assert state() == [(7, 1, True), (8, 2, False), (9, 5, False)]
    add((6, 40, 7), (7, 12, 8))
    assert state() == [(7, 6, False), (8, 2, True), (9, 5, True)]


def test_every_tenth_counts_before_the_event(spark):
    events = spark.createDataFrame(
        [(i, i, 1, K.VIEW_EVENT if i in (0, 10, 13) else "wave", True) for i in range(21)],
        "event_id bigint, ts bigint, user_id bigint, event_type string, has_user_profile boolean")
    counters = spark.createDataFrame(
        [(i, 1, i, 5, 4, 4, 9) for i in (0, 10, 13)],
        "event_id bigint, user_id bigint, ts bigint, n_recs bigint, n_relevant bigint, "
        "n_relevant_products bigint, relevant_products bigint")
    out = S.every_tenth(events, counters)
    assert rows(out, "event_id", "events_processed", "total_recommendations",
                "total_relevant_products", "active_user_sessions") == [
        (0, 0, 5, 9, 1), (10, 10, 10, 9, 1)]


def test_monitor_defaults(spark):
    texts = spark.createDataFrame([(json.dumps(m),) for m in (
        {"event_type": K.RECOMMENDATION_MESSAGE, "timestamp": 0.0,
         "recommendations": [{"name": "a"}, {"price": 2.0}]},
        {"event_type": K.PURCHASE_MESSAGE, "timestamp": 3661.0, "user_id": 5},
        {"event_type": K.METRICS_MESSAGE, "timestamp": 0.0, "metrics": {"precision": 0.5}})],
        "value string")
    out = M.output_messages(texts)
    assert rows(M.flatten_recommendations(out), "user", "rank", "name", "price", "category") == [
        ("Unknown", 1, "a", 0.0, "Unknown"), ("Unknown", 2, "Unknown", 2.0, "Unknown")]
    assert rows(M.flatten_purchases(out), "time", "user", "product_name") == [
        ("01:01:01", "5", "Unknown")]
    assert M.flatten_metrics(out).first()["f1"] == 0.0
    assert rows(M.message_rates(out, 2), "messages", "per_second") == [(1, 0.5)] * 3


def test_variants_split_users_evenly(spark):
    users = S.with_variant(spark.range(2000).withColumnRenamed("id", "user_id"), "s")
    share = users.filter("variant = 'A'").count() / 2000
    assert 0.45 < share < 0.55
    assert rows(users) == rows(S.with_variant(users.select("user_id"), "s"))


class _Store:
    """A value or list of the state store, which counts the calls it gets."""

    def __init__(self, calls, many):
        self.calls, self.many, self.held = calls, many, [] if many else None

    def get(self):
        self.calls.append("get")
        return iter(self.held) if self.many else self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    put = update

    def appendList(self, values):
        self.calls.append("append")
        self.held = self.held + values

    def clear(self):
        self.calls.append("clear")
        self.held = []


class _Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def getValueState(self, *_, **__):
        return _Store(self.calls, False)

    def getListState(self, *_, **__):
        return _Store(self.calls, True)

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)


def test_state_of_a_user_costs_few_calls():
    numbers = dict.fromkeys(("n_events", "n_recs", "n_relevant", "n_relevant_products", "total_event", "total"), 0)
    view = {**numbers, "kind": "sums", "has_view": True, "has_total": False, "first_event": 1, "last_ts": 10, "last_event": 1}
    bought = [{"kind": "purchase", "batch_id": 0, "ts": 11 + n, "event_id": 100 + n, "product_id": n} for n in range(500)]
    users, handle = state.user_state(), _Handle()
    users.init(handle)
    out = list(users.handleInputRows((True, 7), iter([{**view, "batch_id": 0}, *bought]), None))
    assert [r.kind for r in out] == ["sums", "session", *["purchase"] * 500] and len(handle.calls) == 3
    handle.calls.clear()
    out = list(users.handleInputRows((True, 7), iter([{**view, "batch_id": 1, "last_ts": 509, "last_event": 2}]), None))
    assert [(r.kind, r.ts) for r in out[1:]] == [("session", 509), ("purchase", 509), ("purchase", 510)]
    assert len(handle.calls) == 4

    newest, handle = state.newest_state(1), _Handle()
    newest.init(handle)
    now = Bag(getCurrentWatermarkInMs=lambda: 0)
    for at in (5_000, 9_000):
        handle.calls.clear()
        rows = [Row(at=at, event_id=e, ids=str(e)) for e in range(300)]
        assert [(r.at, r.event_id, r.is_stale) for r in newest.handleInputRows((7,), iter(rows), now)] == [(at, 299, False)]
        assert len(handle.calls) == 3
    gone = [[r.is_stale for r in newest.handleExpiredTimer((7,), now, Bag(getExpiryTimeInMs=lambda due=due: due))]
            for due in sorted(handle.timers)]
    assert gone == [[], [True]]


def test_purchases_behind_no_session_reach_no_state(spark):
    view, buy = K.VIEW_EVENT, K.PURCHASE_EVENT
    events = spark.createDataFrame([
        (n, user, kind, at, ({"id": n},), ("x",) if profile else None) for n, user, kind, at, profile in [
            (1, 1, buy, 10, False), (2, 1, view, 20, True), (3, 1, buy, 20, False), (4, 1, buy, 30, False),
            (5, 2, buy, 5, False), (6, 2, view, 9, False), (0, 1, buy, 20, False), (7, None, buy, 40, False)]],
        "event_id bigint, user_id bigint, event_type string, at bigint, product struct<id: struct<id: bigint>>, "
        "user_profile struct<c: string>").withColumn("product", F.col("product.id")).withColumn(
        "ts", F.timestamp_micros("at"))
    out = S.activity(events, spark.createDataFrame([], S.COUNTERS)).collect()
    assert sorted(r.event_id for r in out if r.kind == "purchase") == [3, 4, 5]
    assert sorted((r.user_id or 0, r.n_events, r.last_event) for r in out if r.kind == "sums") == [
        (0, 1, None), (1, 5, 2), (2, 2, None)]


def test_state_rows_cross_as_few_arrays():
    names = ["kind", "has_view", "has_total", "batch_id", "n_events", "n_recs", "n_relevant", "n_relevant_products",
             "first_event", "last_ts", "last_event", "total_event", "total", "ts", "event_id", "product_id"]
    told = [Row(told=[0, 1, 0, 0, 2_501, 0, 0, 0, 1, 10, 1, 0, 0, 0, 0, 0])] + [
        Row(told=[2, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 11 + n, 100 + n, n]) for n in range(2_500)]
    users = state.in_arrays(state.user_state(), names)
    users.init(_Handle())
    out = [r.changes for r in users.handleInputRows((True, 7), iter(told), None)]
    assert [len(some) for some in out] == [1_000, 1_000, 502]
    changes = [dict(zip([c.split()[0] for c in state.CHANGES.split(", ")], c, strict=True)) for some in out for c in some]
    assert [c["kind"] for c in changes] == [0, 1, *[2] * 2_500]
    assert changes[0]["session_start"] == 1 and {c["user_id"] for c in changes} == {7}
    assert [c["product_id"] for c in changes[2:]] == list(range(2_500))
